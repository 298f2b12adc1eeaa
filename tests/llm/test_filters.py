"""URL filters, license scans, the quality classifier and the pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from basalt.llm import license_scan, mixing, quality, queries, url_filter
from basalt.llm.common import table

ENTRIES = [
    ("host", "a.example.com", 100, "block", "spam", 1), ("host", "a.example.com", 200, "allow", "ok", 2),
    ("host", "a.example.com", 200, "block", "tie", 3), ("host", "a.example.com", 300, "allow", "ok", 4),
    ("domain", "example.com", 50, "block", "dom", 5), ("prefix", "a.example.com/x", 120, "allow", "pre", 6),
    ("domain", "b.example.com", 50, "allow", "sub", 7), ("host", None, 10, "block", "bad", 8), ("host", "c.com", None, "block", "bad", 9),
]
CAPTURES = [
    (1, "http://a.example.com/y", 40), (2, "http://a.example.com/y", 60), (3, "http://a.example.com/y", 100),
    (4, "http://A.Example.com:80/y?q", 250), (5, "http://a.example.com/y", 350), (6, "http://u@a.example.com/x/z", 250),
    (7, "http://w.b.example.com/", 99), (8, None, 99), (9, "not a url", 99), (10, "http://c.com/", 99), (11, "http://a.example.com/y", None),
    (None, "http://w.example.com./", 51), (2, "http://a.example.com/y", 60), (12, "", 5),
]


@pytest.mark.parametrize("bucket", [7, 10 ** 6])
def test_url_filter_uses_the_entries_of_the_time(spark, bucket):
    entries = spark.createDataFrame(ENTRIES, "kind string, key string, listed_at long, action string, category string, entry_id long")
    captures = spark.createDataFrame([(*c, "x", "y") for c in CAPTURES],
                                     "page_id long, url string, fetched_at long, key string, host string")
    rows = url_filter.filter_urls(captures, entries, bucket_seconds=bucket).collect()
    assert len(rows) == len(set(CAPTURES))
    got = {r["page_id"]: (r["allowed"], r["category"]) for r in rows}
    assert got == {1: (True, None), 2: (False, "dom"), 3: (False, "spam"), 4: (False, "tie"), 5: (True, "ok"), 6: (True, "pre"),
                   7: (True, "sub"), 8: (True, None), 9: (True, None), 10: (True, None), 11: (True, None), None: (False, "dom"),
                   12: (True, None)}


def test_url_filter_prefixes_of_every_depth(spark):
    entries = [("prefix", "h.com/a", 0, "block", "one", 1), ("prefix", "h.com/a/b", 0, "allow", "two", 2),
               ("prefix", "h.com/a/b/c", 0, "block", "three", 3), ("prefix", "h.com/d/e/", 0, "block", "below", 4),
               ("prefix", "h.com/", 0, "block", "empty", 5), ("host", "h.com", 0, "allow", "host", 6)]
    entries = spark.createDataFrame(entries, "kind string, key string, listed_at long, action string, category string, entry_id long")
    wanted = {"/a": "one", "/a/x": "one", "/a/b": "two", "/a/b/": "two", "/a/b/x?y/z": "two", "/a/b/c": "three",
              "/a/b/c/d/e/f#g": "three", "/a/bc": "one", "/d/e": "host", "/d/e/": "below", "/d/e/f/g": "below", "/d/ef/g": "host",
              "": "empty", "/": "empty", "?q": "empty", "//a/b": "empty", "/ab": "host"}
    captures = spark.createDataFrame([(i, f"http://H.com{path}", 9) for i, path in enumerate(wanted)],
                                     "page_id long, url string, fetched_at long")
    rows = url_filter.filter_urls(captures, entries).collect()
    assert {r["url"].removeprefix("http://H.com"): r["category"] for r in rows} == wanted
    assert all(r["allowed"] == (r["category"] in ("two", "host")) for r in rows)


def test_url_filter_of_empty_tables(spark):
    entries = spark.createDataFrame([], "kind string, key string, listed_at long, action string, category string, entry_id long")
    none = spark.createDataFrame([], "page_id long, url string, fetched_at long")
    some = spark.createDataFrame(CAPTURES, "page_id long, url string, fetched_at long")
    assert url_filter.filter_urls(none, entries).collect() == []
    assert all(r["allowed"] for r in url_filter.filter_urls(some, entries).collect())


def test_license_scan_finds_notices(spark, odd):
    mit, gpl = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["gpl-3.0"]
    grant = license_scan.TEMPLATES["mit-grant"]
    filler = "some words that are no notice at all " * 40
    rows = [(1, f"{filler}{mit}{filler}"), (2, f"{filler} {gpl.upper()}"), (3, filler), (4, None), (5, ""),
            (6, grant.replace("publish", "print")), (7, "released under the"), (8, f"{mit} {mit} {gpl}"), (None, mit), (8, f"{mit} {mit} {gpl}"),
            (9, filler * 300 + grant + filler)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan_licenses(df).collect()}
    assert set(got) == {(1, "mit"), (2, "gpl-3.0"), (6, "mit-grant"), (8, "mit"), (8, "gpl-3.0"), (None, "mit"), (9, "mit-grant")}
    assert got[1, "mit"] == 1.0 and 0.8 <= got[6, "mit-grant"] < 1.0
    assert license_scan.scan_licenses(odd).collect() == []


def test_license_scan_limits(spark, empty):
    assert license_scan.scan_licenses(empty).collect() == []
    with pytest.raises(ValueError):
        license_scan.scan_licenses(empty, templates={"short": "too short"})


def test_license_scan_of_whole_licenses(spark):
    body = {n: " ".join(f"{'clause' if i % 3 else 'term'}{i * 7919 % 9973}" for i in range(n)) for n in (129, 600, 1500)}
    filler = "some words that are no notice at all " * 40
    rows = [(n, f"{filler}{text}. {filler}") for n, text in body.items()]
    rows += [(7, body[1500].replace("term", "Term", 40)), (8, " ".join(body[1500].split()[:1000])), (9, filler)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    templates = {str(n): text for n, text in body.items()} | {"mit": license_scan.TEMPLATES["mit"]}
    got = {(r["doc_id"], r["license"]): r["containment"] for r in license_scan.scan_licenses(df, templates=templates).collect()}
    assert license_scan.classes_for(1500) == (8, 16, 128, 256, 512, 1024, 2048)
    # the words of a shorter body start the longer ones
    assert got == dict.fromkeys([(129, "129"), (600, "129"), (600, "600"), (1500, "129"), (1500, "600"), (1500, "1500"),
                                 (7, "129"), (7, "600"), (7, "1500"), (8, "129"), (8, "600")], 1.0)


def test_license_bodies_equal_the_exact_scan(spark, tmp_path):
    """Whole licenses, cut, edited and buried in text: the bands lose no window that the exact SQL finds."""
    rng = random.Random(3)
    filler = "some words that are no notice at all " * 60
    rows = [(None, license_scan.BODIES["mit-text"]), (0, None), (1, "")]
    for body in license_scan.BODIES.values():
        words = body.split()
        for share in (1.0, 0.85, 0.81, 0.79, 0.6):
            rows.append((len(rows), filler[:rng.randrange(2000)] + " ".join(words[:int(share * len(words))]) + filler))
        for every in (20, 30, 60):
            edited = ["edited" if rng.randrange(every) == 0 else w for w in words]
            rows.append((len(rows), f"{filler} {' '.join(edited).upper()} {filler}"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    got = license_scan.scan_licenses(df)
    wanted = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE['op2_license_scan']})").fetchall()
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in got.collect())
    assert {r[1] for r in wanted} >= set(license_scan.BODIES)
    assert max(len(license_scan.template_words(t)) for t in license_scan.BODIES.values()) > 5000


def test_license_bands_at_the_threshold(spark):
    """Made templates of every length, copies with just the share that counts: all of them are found."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    templates, rows, wanted = {}, [], set()
    for n in (*range(5, 30), 60, 100, 129, 200, 300, 500):
        templates[f"t{n}"] = " ".join(rng.choices(vocabulary, k=n))
    for name, text in templates.items():
        words, least = text.split(), license_scan.shared_least(text)
        for _ in range(12):
            # the first shingles only, in text that fills the windows around them
            before, after = (rng.choices(vocabulary, k=rng.randrange(600)) for _ in range(2))
            wanted.add((len(rows), name))
            rows.append((len(rows), " ".join([*before, *words[:least + 4], *after])))
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), templates=templates)
    found = {(r["doc_id"], r["license"]) for r in got.collect()}
    assert wanted <= found


def test_license_bands_bound_the_misses():
    for size, text in ((8, license_scan.TEMPLATES["mit"]), (16, license_scan.TEMPLATES["gpl-3.0"]), (8192, license_scan.BODIES["gpl-3.0-text"])):
        bands = license_scan.bands_for(size, [text])
        shared = license_scan.shared_least(text)
        either = 2 * size - 4 + len(license_scan.template_shingles(text)) - shared
        assert math.comb(either - shared, bands) / math.comb(either, bands) <= license_scan.MISS
        assert math.comb(either - shared, bands - 1) / math.comb(either, bands - 1) > license_scan.MISS


def test_license_scan_without_templates(spark, odd):
    found = license_scan.scan_licenses(odd, templates={})
    assert found.columns == ["doc_id", "license", "containment", "first_word", "n_windows"] and found.collect() == []


def test_tree_rules_are_the_paths_of_the_tree():
    text = ("DecisionTreeClassificationModel: uid=x, depth=2\n  If (feature 0 <= 1.5)\n   If (feature 1 <= 2.0)\n    Predict: 0.0\n"
            "   Else (feature 1 > 2.0)\n    Predict: 1.0\n  Else (feature 0 > 1.5)\n   Predict: 1.0\n")
    a, b = ("x", "<=", 1.5), ("y", "<=", 2.0)
    assert quality.tree_rules(text, ["x", "y"]) == [(a,), (a, b), (a, ("y", ">", 2.0)), (("x", ">", 1.5),)]


def test_quality_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
               and r["predicted"] == int(r["score"] >= 0.3) for i, r in rows.items())
    held = [(rows[r["doc_id"]]["score"], r["quality"]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    good, bad = [s for s, y in held if y == 1], [s for s, y in held if y == 0]
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.97 and sum((s >= 0.3) == (y == 1) for s, y in held) / len(held) > 0.95


def test_quality_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(30)], "doc_id long, quality int")
    rows = quality.score_quality(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = labels.where("1 = 0")
    assert {r["score"] for r in quality.score_quality(odd, none).collect()} == {0.5}
    assert quality.score_quality(empty, labels).collect() == []
    assert quality.keep_good(odd, none).columns == odd.columns


def test_stages(spark, sf_dir):
    """The pipeline's rows are what the stages' decisions, recomputed row by row, leave."""
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "bpe"]
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality.score_quality(docs, labels).collect() if r["predicted"] == 1}
    last = {}
    for i in good:
        last[text[i]] = max(i, last.get(text[i], i))
    unique = sorted(last.values())

    def shingles(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1 if w else 0))}
    sets, root = {i: shingles(text[i]) for i in unique}, {i: i for i in unique}
    changed = True
    pairs = [(a, b) for n, a in enumerate(unique) for b in unique[n + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= (root[a], root[b]) != (low, low)
            root[a] = root[b] = low
    kept = [i for i in unique if root[i] == i]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs.where(docs["doc_id"].isin(kept))).collect()}
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, sf_dir).collect())
    assert got == {i: n for i, n in copies.items() if n}


def test_stages_keep_the_columns(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns


def test_compiled_rules_equal_their_plain_reading(spark, sf_dir):
    """Every document's score, from its statistics and the fitted rules read one by one in Python."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    stats = quality.statistics(F.col("text"))
    rows = docs.select("doc_id", *[c.alias(n) for n, c in stats.items()])
    train = (rows.join(labels, "doc_id").where(~quality.is_held_out(F.col("doc_id"))).where("quality in (0, 1)")
             .select(F.col("quality").alias("label"), *stats))
    intercept, rules = quality.fit_rules(train, list(stats))
    assert rules and any(len(r) > 1 for r, _ in rules)
    scored = rows.select("*", quality.score_expression(intercept, rules).alias("score")).collect()
    assert len(scored) == docs.count()
    for r in scored:
        total = intercept + sum(w for rule, w in rules
                                if all(r[n] <= v if op == "<=" else r[n] > v for n, op, v in rule))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-total)), rel_tol=1e-9)


def test_statistics_equal_their_plain_reading(spark, odd):
    """The counts behind the rules, for odd texts too, in plain Python."""
    stats = quality.statistics(quality.text_of("text"))
    for r in odd.select("text", *[c.alias("s_" + n) for n, c in stats.items()]).collect():
        t = r["text"] or ""
        words = max(len(re.findall(r"[^ \t\n\x0b\f\r]+", t)), 1)
        assert r["s_words"] == words and r["s_word_length"] == len(t) / words
        assert r["s_digits"] == len(re.findall("[0-9]", t)) / max(len(t), 1)
        assert (r["s_bangs"], r["s_bars"], r["s_stops"], r["s_commas"], r["s_lines"]) == tuple(t.count(c) / words for c in "!|.,\n")


def plain_ids(texts):
    ranks = {base64.b64decode(a): int(b) for a, b in
             (line.split() for line in open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read().splitlines() if line)}
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return {t: encoding.encode_ordinary(t) for t in texts}


def test_last_stage_holds_the_ids_of_the_kept_texts(spark, sf_dir):
    text = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ids = plain_ids({text[r["doc_id"]] for r in rows})
    assert rows
    for r in rows:
        own = ids[text[r["doc_id"]]]
        assert r["n_tokens"] == len(own)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, own)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_pipeline_on_odd_and_empty_tables(spark, odd, empty, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing columns through all stages."""
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", odd), ("empty", empty)):
        docs.write.parquet(str(tmp_path / name / "documents.parquet"))
        labels.write.parquet(str(tmp_path / name / "labels.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, str(tmp_path / "odd")).columns == odd.columns
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).collect() == []
    given = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest()) for r in odd.select("doc_id", "text").collect()}
    got = Counter((r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.run(spark, str(tmp_path / "odd")).collect())
    assert got and set(got) <= given
    # of equal texts one stays, as often as the mix says
    assert len({digest for _, digest in got}) == len(got)
    assert max(got.values()) <= mixing.MAX_EPOCHS


def test_native_plans_hold_no_python(spark, sf_dir):
    for name in ("op1_url_filter", "op2_license_scan", "op4_exact_dedup"):
        plan = queries.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin")), name


def test_queries_cover_the_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
