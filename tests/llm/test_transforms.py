"""Fill-in-the-middle, conversation repair and WARC archives against brute force, round trips and edge cases."""

import base64
import gzip
import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.errors import PythonException

from basalt.llm import conversation_repair as cr
from basalt.llm import fill_middle, queries, warc
from basalt.llm.common import table
from basalt.session import scratch_dir

# fill in the middle


def fim(doc_id, text, seed=1):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows(df):
    made = fill_middle.fill_in_middle(df)
    return made.withColumn("restored", fill_middle.restore()).collect()


def test_fill_middle_matches_regex_cuts(odd):
    rows = fim_rows(odd)
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in rows), key=str)
    want = sorted(((r["doc_id"], *fim(r["doc_id"], r["text"])) for r in odd.select("doc_id", "text").collect()), key=str)
    assert got == want
    assert sorted(r["restored"] for r in rows) == sorted(r["text"] or "" for r in odd.select("text").collect())


def test_fill_middle_all_forms_on_given_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = {r["doc_id"]: r for r in fim_rows(docs)}
    for r in docs.select("doc_id", "text").collect():
        got = rows[r["doc_id"]]
        assert (got["n"], got["form"], got["prefix_chars"], got["middle_chars"], got["output"]) == fim(r["doc_id"], r["text"])
        assert got["restored"] == (r["text"] or "")
    assert {r["form"] for r in rows.values()} == {"plain", "psm", "spm"}


def test_fill_middle_sentinels_make_plain(spark):
    texts = ["a <P> b", "<S>", "x<M>", "<", "<P", "P>", "<<P", "<S<S", "line\nline \r\n", "\x00\x1f\x7f", "é😀" * 50]
    df = spark.createDataFrame([(i * 17 + k, t) for i, t in enumerate(texts) for k in range(8)], "doc_id long, text string")
    for r in fim_rows(df):
        t = texts[r["doc_id"] // 17]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == fim(r["doc_id"], t)
        assert r["restored"] == t


def test_fill_middle_empty_table_and_long_text(spark, empty):
    assert fill_middle.fill_in_middle(empty).collect() == []
    long_ = "word, " * 700_000  # over the slice size: a slice of its own
    rows = fim_rows(spark.createDataFrame([(1, "a b"), (2, long_), (3, "c d")], "doc_id long, text string"))
    assert {r["doc_id"]: (r["n"], r["restored"]) for r in rows} == {1: (3, "a b"), 2: (2_100_000, long_), 3: (3, "c d")}


def test_slices_cover_all_rows_within_the_bound():
    texts = pa.array(["x" * n for n in (10, fill_middle.SLICE_BYTES, 1, 1, fill_middle.SLICE_BYTES + 5, 0)])
    assert list(fill_middle._slices(texts)) == [(0, 1), (1, 2), (2, 4), (4, 5), (5, 6)]
    assert list(fill_middle._slices(texts.slice(0, 0))) == []


# conversation repair


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = {1: "", 2: re.sub("[.!?]", "", x)}.get(d, x)
        out += [(c, t, "user" if d == 4 else r, x)] * {0: 0, 3: 2}.get(d, 1)
    return out


def reach(roles, initial):
    """A prefix of (s?(ua)+)? extended by an initial, shortened to what decides; None if that cannot be."""
    new = roles + initial
    if not initial or not re.fullmatch("s|s?(ua)*u|s?(ua)+", new):
        return None
    return "s" if new == "s" else "u" if new[-1] == "u" else "ua"


def cheapest(rows):
    """Dijkstra by (cost, audit) over (rows read, roles written)."""
    def order(row):
        return (row[0] is not None, row[0] or 0, hashlib.md5(f"{len(row[1])}:{row[1]}{row[2]}".encode()).digest())

    rows = sorted(rows, key=order)
    faults, seen = [], set()
    for _, r, x in rows:
        solid = re.sub(r"[\x20\x09-\x0d]", "", x)
        faults.append("blank" if not solid else "duplicate" if (r, x) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((r, x))
    initials = [r[:1] for _, r, _ in rows]
    turns = [t for t, _, _ in rows if t is not None]
    counts = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *map(faults.count, ("blank", "duplicate", "truncated")),
              sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)))
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, lines = heapq.heappop(heap)
        if (i, roles) in done:
            continue
        done.add((i, roles))
        if i == len(rows) and roles in ("", "ua"):
            text = []
            while lines:
                lines, line = lines
                text.append(line)
            return *counts, cost, audit, hashlib.sha256("\n".join(reversed(text)).encode()).hexdigest()
        steps = [(3, "I", 0, role, "") for role in ("user", "assistant")]
        if i < len(rows):
            extra = 3 if faults[i] == "truncated" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, roles, lines))
            if faults[i] not in ("blank", "duplicate"):
                steps += [(extra, "K", 1, rows[i][1], rows[i][2])]
                steps += [(3 + extra, "R", 1, role, rows[i][2]) for role in ("user", "assistant")]
        for price, letter, ahead, role, text in steps:
            if (new := reach(roles, role[:1])) is not None:
                heapq.heappush(heap, (cost + price, audit + letter, i + ahead, new, (lines, f"{role}:{text}")))


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def brute(rows, harm=damage):
    by = defaultdict(list)
    for c, *_ in rows:
        by[c]  # noqa: B018 - every conversation is listed
    for c, *rest in harm(rows):
        by[c].append(tuple(rest))
    return {c: cheapest(v) if v else NOTHING for c, v in by.items()}


CONV = "conv_id long, turn long, role string, text string"


def repaired(spark, rows):
    df = cr.turns_of(spark.createDataFrame(rows, CONV))
    return {r[0]: tuple(r[1:]) for r in cr.repair_digests(df, df).collect()}


def as_read(rows):
    return [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]


def test_repair_query_matches_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r[1:]) for r in queries.op12_conversation_repair(spark, sf_dir).collect()}
    assert got == brute(rows)
    audits = "".join(v[6] for v in got.values())
    assert set(audits) == set("DIKR")


def test_damage_draws_and_nulls(spark):
    rows = [(c, t, r, x) for c in (None, 1, 2) for t in (None, *range(40)) for r, x in ((None, "a. b"), ("system", None))]
    got = sorted((tuple(r) for r in queries.damaged(spark.createDataFrame(rows, CONV)).collect()), key=str)
    assert got == sorted(damage(rows), key=str)


def test_repair_random_conversations(spark):
    rng = random.Random(12)
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 14)):
            turn = None if rng.random() < 0.1 else rng.choice([t, t, t, t - 1, t + 3])
            rows.append((c if c else None, turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]),
                         rng.choice(["Yes.", "Yes.", "no", "", " \t\n", None, f"Text {rng.randint(0, 5)}!", "end .  ", "é?\r\n"])))
    assert repaired(spark, rows) == brute(as_read(rows), harm=list)


def test_repair_long_conversation_and_hot_repeat(spark):
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Same text.", f"Own text {t}.", f"cut {t}", ""]))
            for t in range(1500)]
    rows += [(2, 0, "user", "again")] * 400 + [(3, None, None, None)]
    assert repaired(spark, rows) == brute(as_read(rows), harm=list)


def test_repair_rows_of_the_cheapest_edits(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "Hello."), (1, 4, "assistant", "Yes"), (2, 0, "tool", "x.")]
    df = cr.turns_of(spark.createDataFrame(rows, CONV))
    found, fixed = cr.repair(df)
    got = {r["conv_id"]: (r["gaps"], r["cost"], r["audit"]) for r in found.collect()}
    assert got == {1: (1, 6, "KKIKK"), 2: (0, 4, "D")}  # an insert costs less than a deletion; the cut answer adds 3
    assert [(r["seq"], r["edit"], r["role"], r["text"]) for r in fixed.where("conv_id = 1").orderBy("seq").collect()] == [
        (i, e, role, text) for i, (e, role, text) in enumerate(expected(rows[:4], got[1][2]))]


def expected(rows, audit):
    out, i, last = [], 0, ""
    for letter in audit:
        role, text = (rows[i][2], rows[i][3]) if letter != "I" else (None, "")
        if letter in "IR":
            role = "assistant" if last == "user" else "user"
        if letter != "D":
            out.append((letter, role, text))
            last = role
        i += letter != "I"
    return out


def test_repair_empty_table(spark):
    df = spark.createDataFrame([], CONV + ", g long, seq long, digest string")
    found, fixed = cr.repair(cr.turns_of(df))
    assert found.collect() == [] and fixed.collect() == []
    assert repaired(spark, []) == {}


def test_block_matrices_and_checkpoints_agree_with_one_pass():
    rng = random.Random(3)
    letters = sorted(cr._CLASSES)
    for _ in range(300):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 40)))
        whole = cr._walks(text, cr.AT_END, True)[0][0]
        for width in (1, 3, 7, 50):
            blocks = [text[i:i + width] for i in range(0, len(text), width)]
            ends, v = [], cr.AT_END
            for b in reversed(blocks):
                ends.append(v)
                m = cr.block_matrix(b)
                v = tuple(min(m[4 * q + j] + v[j] for j in range(4)) for q in range(4))
            audit, q = "", 0
            for i, (b, end) in enumerate(zip(blocks, reversed(ends), strict=True), 1):
                walk, q = cr.block_walks(b, end, i == len(blocks))[q]
                audit += walk
            assert audit == whole


# WARC


def digest(text):
    return base64.b32encode(hashlib.sha1(text.encode()).digest()).decode()


def archived(spark, df, **options):
    out = scratch_dir(spark, "warc-test")
    warc.write_warc(df, out, **options)
    return out


def of_pages(pages, least=0):
    ids = defaultdict(list)
    for i, html in pages:
        ids[html or ""].append(i)
    out = []
    for i, html in pages:
        top = max((x for x in ids[html or ""] if x is not None), default=None)
        refers = top if i != top and len((html or "").encode()) >= least else None
        out.append((i, len((html or "").encode()), digest(html or ""), "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


VERSIONS = "a\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\nContent-Length: 5\r\n\r\nWARC/1.1\r\n" * 3
ODD_PAGES = [(1, "http://a b/\r\nX: y", VERSIONS), (2, None, None), (3, "x", ""), (None, None, "zz"), (5, "u", "zz"), (5, "u", "zz"),
             (6, "u", "é" * 20_000), (7, "u", "é" * 20_000), (8, "é" * 5000, "WARC/1.1\r\n" * 9), (-4, "n", "zz"), (9, "v", "zzz"),
             (None, "only null", "null id"), (10, "w", "\r\n\r\n"), (10, "w", "other text, same id")]


@pytest.mark.parametrize("chunk_bytes", [1 << 14, 7, 10])
def test_warc_round_trip(spark, chunk_bytes):
    rows = ODD_PAGES if chunk_bytes > 100 else [(i, u, (h or "")[:3000] if h else h) for i, u, h in ODD_PAGES]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    out = archived(spark, df, chunk_bytes=chunk_bytes)
    got = sorted((tuple(r) for r in warc.record_report(spark, out).collect()), key=str)
    assert got == of_pages([(i, h) for i, _, h in rows])


def test_warc_chunks_carry_the_payload(spark):
    rows = [(i, f"u{i}", h) for i, h in enumerate(["x" * 50 + "é", "", VERSIONS])]
    out = archived(spark, spark.createDataFrame(rows, "page_id long, url string, html string"), chunk_bytes=8)
    bodies, most = defaultdict(bytes), 0
    for r in warc.read_chunks(spark, out).collect():
        bodies[r["record_id"]] += r["body"]
        most = max(most, len(r["body"]))
    assert {k: v.decode() for k, v in bodies.items()} == {f"<urn:page:{i}>": h for i, _, h in rows}
    assert most <= 18  # a chunk, or a version line inside a payload with the chunk after it


def test_warc_files_follow_the_format(spark):
    df = spark.createDataFrame([(1, "http://x/?a b", "abcdefghij"), (2, "http://y/", "abcdefghij")], "page_id long, url string, html string")
    out = archived(spark, df.coalesce(1), chunk_bytes=6)
    raw = b"".join(gzip.open(p).read() for p in sorted(Path(out.removeprefix("file:")).glob("*.gz")))
    kinds = []
    while raw:  # records are length-delimited and end with two line ends
        head, _, raw = raw.partition(b"\r\n\r\n")
        lines = head.decode().split("\r\n")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        assert lines[0] == "WARC/1.1" and {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(fields)
        n = int(fields["Content-Length"])
        assert raw[n:n + 4] == b"\r\n\r\n"
        kinds.append((fields["WARC-Type"], fields.get("WARC-Segment-Number"), fields.get("WARC-Refers-To")))
        raw = raw[n + 4:]
    assert sorted(kinds, key=str) == sorted([("response", "1", None), ("continuation", "2", None), ("revisit", None, "<urn:page:2>")], key=str)


def test_warc_small_payloads_are_all_responses(spark):
    pages = [(1, "ab"), (2, "ab"), (3, "abcd"), (4, "abcd"), (5, "")]
    out = archived(spark, spark.createDataFrame([(i, "u", h) for i, h in pages], "page_id long, url string, html string"), min_revisit_bytes=3)
    assert sorted((tuple(r) for r in warc.record_report(spark, out).collect()), key=str) == of_pages(pages, least=3)


def test_warc_empty_table(spark):
    out = archived(spark, spark.createDataFrame([], "page_id long, url string, html string, body string"))
    assert warc.record_report(spark, out).collect() == [] and warc.read_chunks(spark, out).collect() == []


def test_warc_query_on_given_pages(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "html").collect()
    assert sorted((tuple(r) for r in queries.op13_warc(spark, sf_dir).collect()), key=str) == of_pages([tuple(r) for r in rows])


def test_warc_reads_foreign_records(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\npayload"
    records = [b"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:a>\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\nk: v\r\n\r\n",
               b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:b>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "
               + str(len(block)).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))  # a gzip member per record
    got = {r["record_id"]: (r["warc_type"], r["stored_bytes"], r["stored_digest"]) for r in warc.read_records(spark, str(tmp_path)).collect()}
    assert got == {"<urn:a>": ("warcinfo", 4, digest("k: v")), "<urn:b>": ("response", 7, digest("payload"))}


@pytest.mark.parametrize("cut", ["head", "body", "segment"])
def test_warc_damaged_archives_raise(spark, tmp_path, cut):
    one = b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:a>\r\nWARC-Segment-Number: 1\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n"
    two = b"WARC/1.1\r\nWARC-Type: continuation\r\nWARC-Segment-Origin-ID: <urn:a>\r\nWARC-Segment-Number: 3\r\nContent-Length: 1\r\n\r\nx\r\n\r\n"
    raw = {"head": one[:40], "body": one[:-7], "segment": one + two}[cut]
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(raw))
    with pytest.raises(PythonException):
        warc.read_records(spark, str(tmp_path)).collect()
