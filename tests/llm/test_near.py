"""Suffix-array, MinHash and embedding dedup against brute force."""

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest

from basalt.llm import embedding_dedup, minhash_dedup, suffix_dedup
from basalt.llm.common import table


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def shingles(text, k):
    w = re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower())
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1 if w else 0))}


def smallest_reachable(ids, links):
    low = {i: i for i in ids}
    while True:
        before = dict(low)
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
        if before == low:
            return low


def check_near(docs, rows, k):
    sets = {i: shingles(t, k) for i, t in docs if i is not None}
    links = [(a, b) for a, b in combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    low = smallest_reachable(sets, links)
    for r in rows:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"]) == (low[r["doc_id"]], len(sets[r["doc_id"]]))
            assert r["kept"] == (r["doc_id"] == low[r["doc_id"]])


@pytest.mark.parametrize("k", [2, 5])
def test_minhash_on_odd_rows(odd, k):
    rows = minhash_dedup.near_dedup(odd, shingle_words=k).collect()
    assert len(rows) == odd.count()
    check_near(texts_of(odd), rows, k)


def test_minhash_on_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check_near(texts_of(docs), minhash_dedup.near_dedup(docs, shingle_words=2).collect(), 2)


def test_minhash_links_chains_and_large_groups(spark):
    rng = random.Random(2)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows, words = [], list(base)
    for i in range(60):  # a chain: each text changes the one before a little, so its ends are not alike
        rows.append((i, " ".join(words)))
        words = list(words)
        words[rng.randrange(len(words))] = f"n{i}"
    for i in range(100, 160):  # a group around one text
        words = list(base[::-1])
        for _ in range(3):
            words[rng.randrange(len(words))] = f"g{rng.random()}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(rows, minhash_dedup.near_dedup(df, shingle_words=2).collect(), 2)
    assert {r["doc_id"] for r in minhash_dedup.keep_one(df, shingle_words=2).collect()} == {0, 100}


def test_odd_sketch_separates(spark):
    rng = random.Random(4)
    sign = minhash_dedup._signer(2)
    base = [f"w{i}" for i in range(400)]

    def flips(share):
        words = list(base)
        for i in rng.sample(range(400), int(400 * share)):
            words[i] = f"x{rng.random()}"
        a, b = (np.array(sign(" ".join(w))[4], np.int64).view(np.uint64) for w in (base, words))
        return sum(bin(int(x)).count("1") for x in a ^ b)
    assert max(flips(0.05) for _ in range(20)) <= minhash_dedup.MAX_FLIPS < min(flips(0.6) for _ in range(20))


def test_minhash_empty(empty):
    assert minhash_dedup.near_dedup(empty).collect() == [] and minhash_dedup.keep_one(empty).collect() == []


def removed_by_force(texts, length, keep):
    """Masks of bytes covered by repeated strings; keep="first" spares the first start."""
    starts = {}
    for n, raw in enumerate(texts):
        for s in range(len(raw) - length + 1):
            starts.setdefault(raw[s:s + length], []).append((n, s))
    masks = [np.zeros(len(raw), bool) for raw in texts]
    for where in starts.values():
        for n, s in (where if keep == "none" else where[1:]) if len(where) > 1 else ():
            masks[n][s:s + length] = True
    return masks


def suffix_rows():
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    a, b, c = text(700), text(90), text(300)
    return [(1, a), (2, text(100) + a[:400] + text(80)), (3, text(50) + a[350:]), (4, b), (5, text(60) + b), (6, None), (7, ""),
            (8, "ab" * 300), (9, c + text(40) + c), (10, a), (11, text(1500)), (12, c[100:250] + text(5) + c[:200]), (13, "x")]


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("limit", [1024, 1])
def test_suffix_dedup_matches_brute_force(spark, keep, limit, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_LIMIT", limit)  # 1: every shared key counts as crowded
    rows = suffix_rows()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, rid string, kept string").repartition(3)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, length=60, gram=12, keep=keep).collect()}
    raws = [(t or "").encode() for _, t in rows]
    for (i, _), raw, mask in zip(rows, raws, removed_by_force(raws, 60, keep), strict=True):
        left = bytes(np.frombuffer(raw, np.uint8)[~mask])
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        r = got[i]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) == (len(raw), int(mask.sum()), spans, left)
        assert r["kept_sha256"] == hashlib.sha256(left).hexdigest() and len(r["spans"]) == spans


def test_suffix_dedup_on_odd_rows(odd):
    rows = suffix_dedup.remove_repeats(odd, keep="none").collect()
    docs = texts_of(odd)
    raws = [t.encode() for _, t in docs]
    want = sorted((i is not None, i or 0, len(raw), int(m.sum())) for (i, _), raw, m in
                  zip(docs, raws, removed_by_force(raws, 400, "none"), strict=True))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"]) for r in rows) == want


def test_suffix_dedup_cuts_long_texts_in_chunks(monkeypatch):
    whole = list(suffix_dedup.Anchors(60, 12).slices(b"abcdefgh" * 200))
    monkeypatch.setattr(suffix_dedup, "CHUNK", 100)
    parts = list(suffix_dedup.Anchors(60, 12).slices(b"abcdefgh" * 200))
    starts = lambda rows: sorted((s, kind, p) for kind, a, b, p in rows for s in range(a, b + 1))
    assert starts(whole) == starts(parts)


def test_suffix_dedup_empty(empty):
    assert suffix_dedup.remove_repeats(empty).collect() == []


def test_suffix_order_and_previous_factors():
    rng = random.Random(1)
    for length in (8, 12, 21):
        contexts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(length, 60))) for _ in range(6)]
        joined, at = b"".join(contexts), 0
        starts = []
        for c in contexts:
            starts += range(at, at + len(c) - length + 1)
            at += len(c)
        order, lcp = suffix_dedup.suffix_order(contexts, length)
        assert sorted(order.tolist()) == starts
        whole = [joined[s:] + bytes(99) for s in order]
        assert [w[:length] for w in whole] == sorted(w[:length] for w in whole)
        for one, two, n in zip(whole[:-1], whole[1:], lcp[1:], strict=True):
            assert n >= length and one[:length] == two[:length] or one[:n] == two[:n] and one[n] != two[n]
        lpf, source = suffix_dedup.previous_factors(order, lcp, length)
        first, count = {}, {}
        for s in starts:
            first.setdefault(joined[s:s + length], s)
            count[joined[s:s + length]] = count.get(joined[s:s + length], 0) + 1
        again = {s for s in starts if first[joined[s:s + length]] != s}
        assert {int(s) for s, n in zip(order, lpf, strict=True) if n >= length} == again
        assert {int(s) for s, n, is_source in zip(order, lpf, source, strict=True) if n >= length or is_source} == {
            s for s in starts if count[joined[s:s + length]] > 1}


def test_smaller_positions_decide_what_is_removed(spark, monkeypatch):
    """Equal windows stand in the order of what follows them, so neither the neighbour in suffix order
    nor one of the two passes alone finds the earlier match."""
    word = bytes(range(97, 117)) * 3
    contexts = [word + tail for tail in (b"mm", b"zz", b"aa", b"pp", b"cc")]
    order, lcp = suffix_dedup.suffix_order(contexts, 60)
    want = {62 * n for n in range(1, 5)}
    found = lambda: {int(s) for s, n in zip(order, suffix_dedup.previous_factors(order, lcp, 60)[0], strict=True) if n >= 60}
    neighbour = {int(b) for a, b, n in zip(order[:-1], order[1:], lcp[1:], strict=True) if n >= 60 and a < b}
    assert found() == want != neighbour
    real = suffix_dedup.nearest_smaller
    for broken in (0, 1):
        calls = iter(range(2))

        def one_pass(start, shared, least):
            place, common = real(start, shared, least)
            return (place, common) if next(calls) != broken else (np.full(len(start), -1), np.zeros(len(start), np.int64))
        monkeypatch.setattr(suffix_dedup, "nearest_smaller", one_pass)
        assert found() < want
    monkeypatch.setattr(suffix_dedup, "nearest_smaller", real)


def test_nearest_smaller_matches_a_plain_walk():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 40)
        order = np.array(rng.sample(range(100), n))
        lcp = np.array([0] + [rng.choice((0, 3, 5, 9)) for _ in range(n - 1)])
        place, common = suffix_dedup.nearest_smaller(order, lcp, 3)
        for i in range(n):
            j = next((j for j in range(i - 1, -1, -1) if order[j] < order[i]), -1)
            low = int(lcp[j + 1:i + 1].min()) if j >= 0 else 0
            assert (place[i], common[i]) == ((j, low) if low >= 3 else (-1, 0))


def test_suffix_dedup_on_the_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()))
    raws = [t.encode() for _, t in rows]
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, keep="none", with_text=False).collect()}
    assert len(got) == len(rows) and any(r["n_removed"] for r in got.values())
    for (i, _), raw, mask in zip(rows, raws, removed_by_force(raws, 400, "none"), strict=True):
        left = bytes(np.frombuffer(raw, np.uint8)[~mask])
        spans = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"], got[i]["kept_sha256"]) == (
            len(raw), int(mask.sum()), spans, hashlib.sha256(left).hexdigest())


def test_previous_factors_without_ties():
    text = b"abaababaabaab"
    order = sorted(range(len(text)), key=lambda s: text[s:])

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n
    lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
    lpf, _ = suffix_dedup.previous_factors(np.array(order), np.array(lcp))
    assert {s: int(n) for s, n in zip(order, lpf, strict=True)} == {
        s: max((common(s, j) for j in range(s)), default=0) for s in range(len(text))}


def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((8, 16))
    rows = [centres[i % 8] + 0.08 * rng.standard_normal(16) for i in range(300)] + list(rng.standard_normal((200, 16)))
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


ODD_VECTORS = [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [None] + [1.0] * 15), (1004, [float("nan")] * 16),
               (1005, [float("inf")] + [0.0] * 15), (1006, [1.0, 2.0]), (1007, [2.0, 4.0]), (None, [1.0] * 16), (1008, [1.0] * 16),
               (1009, [1.0] * 16), (1010, [1e-300] * 16)]


@pytest.mark.parametrize("block", [1024, 16])
def test_embedding_links_match_brute_force(spark, block):
    rows = vectors() + ODD_VECTORS + [(2000, vectors()[0][1]), (2001, vectors()[0][1])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, n_links string")
    got = embedding_dedup.near_dedup(df, block=block).collect()
    assert len(got) == len(rows)
    usable = {i: np.array(v) / np.linalg.norm(v) if np.linalg.norm(v) > 1e-200 else np.array(v) / (4 * 1e-300) for i, v in rows
              if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a, b in combinations(usable, 2) if len(usable[a]) == len(usable[b]) and usable[a] @ usable[b] >= 0.95]
    degree = dict.fromkeys([i for i, _ in rows], 0)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    low = smallest_reachable([i for i, _ in rows if i is not None], links)
    found = sum(r["n_links"] for r in got)
    assert 0.9 * sum(degree.values()) <= found <= sum(degree.values())
    assert all(r["n_links"] <= degree[r["vec_id"]] for r in got)
    if block == 1024:
        assert all((r["n_links"], r["component_id"]) == (degree[r["vec_id"]], low.get(r["vec_id"])) for r in got)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)


def test_embedding_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.near_dedup(df).collect() == []


def sparse_pairs(n, hot):
    """Unit vectors of which the share ``hot`` is one topic (cosine 0.5 in it), and 400 of
    them with a partner at cosine 0.951, as rows 0-399 and 400-799."""
    rng = np.random.default_rng(8)
    x = rng.standard_normal((n, 64))
    x[rng.random(n) < hot] += rng.standard_normal(64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * x[:400]).sum(axis=1, keepdims=True) * x[:400]
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x[400:800] = 0.951 * x[:400] + np.sqrt(1 - 0.951 ** 2) * side
    return x


@pytest.mark.parametrize("hot", [0, 1 / 3])
@pytest.mark.parametrize("n, block", [(30_000, 64), (30_000, 8)])
def test_embedding_passes_follow_the_rows(n, block, hot):
    x = sparse_pairs(n, hot)
    forest = embedding_dedup.forest_for(x[np.random.default_rng(1).permutation(n)[:8000]], n, block, 0.95, 0.002, 5)
    assert len(forest.planes) > 8
    met = np.zeros(400, bool)
    for one in zip(*forest[1:], strict=True):
        place = np.empty(n, int)
        place[np.argsort(embedding_dedup._key(x, *one), kind="stable")] = np.arange(n)
        met |= np.abs(place[:400] // block - place[400:800] // block) <= 1
    assert met.mean() >= 0.99


def test_embedding_sparse_pairs_beside_a_hot_topic(spark):
    x = sparse_pairs(6000, 1 / 3)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    for block, exact, least in ((16, False, 396), (1024, False, 396), (1024, True, 400)):
        got = {r["vec_id"]: r["component_id"] for r in embedding_dedup.near_dedup(df, block=block, exact=exact).collect()}
        assert sum(got[i + 400] == got[i] for i in range(400)) >= least


def test_embedding_passes_on_the_given_vectors(spark, sf_dir):
    """The given table with a turned copy of every third vector (cosine 0.955), by the passes."""
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r["embedding"] for r in given], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = np.random.default_rng(6).standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    x = np.concatenate([x, (0.955 * x + np.sqrt(1 - 0.955 ** 2) * side)[::3]])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_dedup(df, block=16).collect()}
    assert all(got[i] <= n for i, n in enumerate(want)) and sum(got.values()) >= 0.9 * want.sum() > 0
