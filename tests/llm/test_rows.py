"""Exact dedup, BPE, mixing and token files against brute force."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basalt.llm import bpe, exact_dedup, mixing, token_output
from basalt.llm.common import components
from basalt.session import scratch_dir


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def test_exact_dedup_matches_grouping(odd):
    ids = defaultdict(list)
    for i, t in texts_of(odd):
        ids[t].append(i)
    rows = exact_dedup.exact_dedup(odd, capacity=2, max_depth=6).collect()
    assert len(rows) == odd.count()
    want = {hashlib.sha256(t.encode()).hexdigest(): (max((i for i in v if i is not None), default=None), len(v))
            for t, v in ids.items()}
    for r in rows:
        keep, n = want[r["text_sha256"]]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (keep, n, r["doc_id"] == keep)


def test_exact_dedup_chains_texts_that_share_a_key(spark, monkeypatch):
    """Only the comparison of bytes tells texts with one key apart, within a slice and across slices."""
    monkeypatch.setattr(exact_dedup, "text_key", lambda t: F.xxhash64(F.length(t) % 3))
    rows = [(i, ("x" * (i % 5)) + "ab"[i % 2]) for i in range(300)] + [(900, "alone" * 7), (901, None), (902, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_dedup(df, capacity=4).collect()}
    assert got == {i: (max(groups[t or ""]), len(groups[t or ""]), i == max(groups[t or ""])) for i, t in rows}
    whole = exact_dedup.chain_links
    monkeypatch.setattr(exact_dedup, "chain_links", lambda held, where, order: whole(held, where, order).withColumn("link", F.lit(1)))
    assert {r["group_size"] for r in exact_dedup.exact_dedup(df, capacity=4).collect()} != {n for _, n, _ in got.values()}


def test_exact_index_buckets_hold_their_capacity_and_only_repeated_keys(spark):
    rows = [(i, f"text {i % 400}") for i in range(800)] + [(1000 + i, "hot") for i in range(2500)] + [(5000 + i, f"u{i}") for i in range(500)]
    docs = (spark.createDataFrame(rows, "doc_id long, t string").withColumn("key", exact_dedup.text_key(F.col("t"))))
    repeated = docs.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    index = exact_dedup.chained_entries(docs, repeated, capacity=150, max_depth=10)
    plan = index._jdf.queryExecution().toString()
    assert "rangepartitioning(bucket" in plan and "Python" not in plan and "Arrow" not in plan
    kept = index.collect()
    assert len(kept) == 3300 and sum(r["t"] is not None for r in kept) == 400 + 25  # a text per link; the hot one per slice
    held = Counter((r["bucket"], r["slice"]) for r in kept)
    assert max(held.values()) <= 2 * 150 and len({b for b, _ in held}) > 4  # slices of a hot key differ a little by chance
    assert len({r["key"] for r in kept}) == 401


def test_exact_dedup_on_the_given_documents(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    groups = defaultdict(list)
    for i, t in texts_of(df):
        groups[t].append(i)
    want = sorted((i, max(v), len(v), i == max(v), hashlib.sha256(t.encode()).hexdigest()) for t, v in groups.items() for i in v)
    assert sorted(tuple(r) for r in exact_dedup.exact_dedup(df).collect()) == want


def test_keep_exact_drops_copies_and_repeated_rows(odd):
    out = exact_dedup.keep_exact(odd)
    assert out.columns == odd.columns
    rows = texts_of(out)
    assert len({t for _, t in rows}) == len({t for _, t in texts_of(odd)})
    assert max(Counter(t for _, t in rows).values()) == 1


def test_directory_doubles_only_overfull_buckets():
    counts = {0: 9, 1: 9, 2: 1, 12: 1}  # slots of 4 bits
    leaves = exact_dedup.grow_directory(counts, capacity=10, max_depth=4)
    assert leaves == [(1, 1), (2, 1), (3, 1), (4, 0), (4, 1)]
    assert exact_dedup.grow_directory({0: 100}, capacity=10, max_depth=4)[-1] == (4, 1)  # chained beyond the depth


@pytest.mark.parametrize("op", [
    exact_dedup.exact_dedup, exact_dedup.keep_exact, mixing.mix, mixing.apply_mix,
    lambda df: bpe.encode_documents(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)])
def test_empty_table(empty, op):
    assert op(empty).collect() == []


def reference_encoding():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    keys = [b"k%d" % i for i in range(5000)]
    table = bpe.PerfectHash(keys, list(range(5000)))
    assert sorted(table.slots) == list(range(5000))
    assert all(table.get(k) == i for i, k in enumerate(keys)) and table.get(b"other") == -1


def test_words_join_to_the_whole_encoding():
    rng, want = random.Random(1), reference_encoding()
    own = bpe.Bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
    parts = [" ", "  ", "\n", "\t", "a", "the", "'s", "'ll", "é", "12", "!", " ", "日本", "\x1c", "\x85", "​", "😀", " the", "\r\n", "A"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert "".join(bpe.words(t)) == t
        assert own.encode(t) == want.encode_ordinary(t)
    long_run = "a" * 5000
    assert own.encode(long_run) == want.encode_ordinary(long_run)


def test_memo_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 3)
    own, want = bpe.Bpe(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), reference_encoding()
    for t in ["one two three four five", "two three", "six seven eight nine", "one two nine"]:
        assert own.encode(t) == want.encode_ordinary(t)
    assert len(own.memo.old) <= 8


def test_encode_documents_matches_the_library(odd):
    want = reference_encoding()
    rows = bpe.encode_documents(odd, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_bytes=True).collect()
    expected = Counter()
    for i, t in texts_of(odd):
        ids = want.encode_ordinary(t)
        expected[i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                 hashlib.sha256(t.encode()).hexdigest(), tuple(ids), t.encode()] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], tuple(r["ids"]), bytes(r["decoded"]))
                   for r in rows) == expected


def test_water_fill_reshares_the_excess():
    targets = mixing.water_fill([10, 100, 1000], [1, 1, 1], 3)
    assert targets == [30.0, 300.0, 780.0]
    assert sum(mixing.water_fill([5, 5, 90, 0], [1, 2, 3, 1], 3)) == pytest.approx(100)


def test_mix_takes_the_targets(odd):
    rows = mixing.mix(odd).collect()
    assert len(rows) == odd.count()
    sizes = Counter((i, len(re.findall(r"[^\x20\x09-\x0D]+", t))) for i, t in texts_of(odd))
    assert Counter((r["doc_id"], r["size"]) for r in rows) == sizes
    per = defaultdict(list)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and 0 <= r["copies"] <= 3
        per[r["source_size"], r["target"]].append(r)
    for (size, target), own in per.items():
        assert sum(r["size"] for r in own) == size and sum(r["taken"] for r in own) == int(target)
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mix(odd.repartition(5)).collect()))


def test_apply_mix_repeats_whole_rows(odd):
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(odd).collect()}
    out = mixing.apply_mix(odd)
    assert out.columns == odd.columns
    got = Counter(i for i, _ in texts_of(out))
    assert set(got) == {i for i, n in copies.items() if n}


def test_token_files_hold_the_library_ids(spark, odd):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    out = scratch_dir(spark, "tokens-test")
    token_output.write_tokens(odd, out, P.path("byte_bpe_50k.json"))
    docs = sorted(texts_of(odd), key=lambda x: (x[0] is not None, x[0] or 0))
    ids = {(i, s): t.encode(s, add_special_tokens=False).ids + [2] for i, s in docs}
    rows = token_output.read_tokens(spark, out).collect()
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in rows) == Counter((i, tuple(ids[i, s])) for i, s in docs)
    digests = sorted(token_output.token_digests(spark, out).collect(), key=lambda r: r["start"])
    at = 0
    order = []
    for r in digests:
        assert r["start"] == at
        at += r["n_tokens"]
        order.append(r["doc_id"])
    assert order == [i for i, _ in docs]
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in digests) == Counter(
        (i, zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[i, s]))) for i, s in docs)
    assert {r["doc_id"] for r in token_output.read_tokens(spark, out, [9, 100]).collect()} == {9, 100}


def test_token_files_of_an_empty_table(spark, empty):
    out = scratch_dir(spark, "tokens-empty")
    token_output.write_tokens(empty, out, P.path("byte_bpe_50k.json"))
    assert token_output.token_digests(spark, out).collect() == []


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(100, x) for x in range(101, 140)] + [(300, 301), (301, 302), (302, 300)]
    random.Random(3).shuffle(edges)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 140), 100), **dict.fromkeys(range(300, 303), 300)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_word_encoder_joins_to_the_whole_encoding():
    import pyarrow as pa

    rng, own = random.Random(7), token_output.WordEncoder(P.path("byte_bpe_50k.json"))
    parts = [" ", "  ", "\n", "\t", "a", "the", "'s", "'ll", "é", "12", "!", "\xa0", "日本", "\x1c", "\x85", "​", "😀", " the",
             "\r\n", "A", "<|endoftext|>", "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for i in range(0, len(texts), 500):
        got = own.encode_batch(pa.array(texts[i:i + 500]), 2).to_pylist()
        assert got == [own.tokenizer.encode(t, add_special_tokens=False).ids + [2] for t in texts[i:i + 500]]
