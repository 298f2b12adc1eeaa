"""Removal of long repeated byte strings with suffix arrays over candidate contexts.

A global suffix array would put all bytes in one order, though few of them
repeat.  The work is cut down without losing a match, then the suffix arrays
are built per candidate group:

1. Anchors (winnowing).  The window of ``length`` bytes at each start owns the
   position of its smallest k-gram hash.  Equal windows have equal anchors at
   the same offset, so only windows whose anchor repeats can repeat.  The starts
   that share an anchor are cut into slices by offset; all windows of a slice
   have more than half their bytes in common, and a hash of those bytes is the
   slice's key.  A slice is shipped as (key, digest of its whole context).
2. One shuffle by key.  Equal contexts (copies of any number) are settled by
   their digests; tasks combine the copies they see before the shuffle.  Keys
   with one context are done.
3. For keys with several different contexts, one representative of each is cut
   from its text.  Tasks join the contexts of whole groups in document order,
   build their suffix array and LCP values by prefix doubling, and take each
   start's longest previous factor from the previous and the next smaller
   position in suffix order: ``length`` bytes or more repeat.
4. A key with more than ``GROUP_LIMIT`` contexts is not collected: its windows
   are shipped one by one as digests and compared as neighbours in sort order.
5. The repeated starts of a document are united and its bytes removed.

Offsets are byte offsets in UTF-8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.llm.common import materialize, prepare, text_of

LENGTH, GRAM = 400, 64
#: Window starts hashed at once (bounds a task's memory on very long texts).
CHUNK = 1 << 19
#: Contexts of a key that are suffix-sorted together, and bytes of a suffix array.
GROUP_LIMIT, SORT_BYTES = 1024, 1 << 20
_BASE = 0x9E3779B97F4A7C15


def _inverse(a: int) -> int:
    x = 1
    for _ in range(7):
        x = x * (2 - a * x) % (1 << 64)
    return x


class Anchors:
    """Slices of window starts that share an anchor and an offset class."""

    def __init__(self, length: int, gram: int) -> None:
        import numpy as np

        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.slice = -(-self.width // 2)
        n = CHUNK + length + gram
        with np.errstate(over="ignore"):
            self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_BASE))]))
            self.back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(_inverse(_BASE)))]))

    def _owner(self, raw):
        """The anchor of each window of ``raw``: leftmost smallest k-gram."""
        import numpy as np

        w, n = self.width, len(raw)
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.power[:n])])
            h = (total[self.gram:] - total[:-self.gram]) * self.back[:n - self.gram + 1]
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        bits = np.uint64((CHUNK + self.length).bit_length())
        key = ((h >> bits) << bits) | np.arange(len(h), dtype=np.uint64)
        rows = -(-len(key) // w)
        padded = np.full(rows * w, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(key)] = key
        grid = padded.reshape(rows, w)
        head = np.minimum.accumulate(grid, axis=1).ravel()
        tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        starts = n - self.length + 1
        low = np.minimum(tail[:starts], head[w - 1:w - 1 + starts])
        return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)

    def slices(self, text: bytes) -> Iterator[tuple[int, int, int, int]]:
        """(offset class, first start, last start, anchor) over all windows of a text."""
        import numpy as np

        for base in range(0, len(text) - self.length + 1, CHUNK):
            raw = np.frombuffer(text, np.uint8, min(len(text) - base, CHUNK + self.length - 1), base)
            owner = self._owner(raw)
            cut = np.flatnonzero(np.diff(owner)) + 1
            first = np.concatenate([[0], cut])
            last = np.concatenate([cut, [len(owner)]]) - 1
            for a, b, p in zip((first + base).tolist(), (last + base).tolist(), (owner[first] + base).tolist(), strict=True):
                far = p - self.slice  # last start of the class whose windows begin far before the anchor
                if a <= far:
                    yield 1, a, min(b, far), p
                if b > far:
                    yield 0, max(a, far + 1), b, p

    def key_bytes(self, text: bytes, kind: int, anchor: int) -> bytes:
        """What all windows of an anchor's offset class have in common."""
        if kind:
            return text[anchor - self.slice:anchor + self.gram]
        return text[anchor:anchor - self.slice + 1 + self.length]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _occurrences(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Slices of all documents; copies that a task sees together are combined:
    state 0 one slice, 1 the first of several equal ones, 2 a further one."""
    schema = pa.schema([("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("doc_id", pa.int64()),
                        ("rid", pa.int64()), ("s0", pa.int32()), ("s1", pa.int32()), ("state", pa.int8())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest as h64
        from xxhash import xxh3_128_intdigest as h128

        anchors = Anchors(length, gram)
        for batch in batches:
            rows: list[list] = []
            seen: dict[int, int] = {}
            texts = batch.column(2).cast(pa.binary())
            ids, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, rids[i]))
            for i in order:
                text = texts[i].as_py()
                if len(text) < length:
                    continue
                for kind, a, b, p in anchors.slices(text):
                    digest = h128(text[a:b + length], kind)
                    first = seen.setdefault(digest, len(rows))
                    if first < len(rows):
                        rows[first][7] = 1
                        key = h64(b"%d/%d" % (rids[i], a))
                        rows.append([_signed(key), 0, 0, ids[i], rids[i], a, b, 2])
                    else:
                        rows.append([_signed(h64(anchors.key_bytes(text, kind, p), kind)), _signed(digest >> 64),
                                     _signed(digest & (1 << 64) - 1), ids[i], rids[i], a, b, 0])
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    return docs.mapInArrow(run, "h long, c1 long, c2 long, doc_id long, rid long, s0 int, s1 int, state byte")


def _classified(occurrences: DataFrame) -> DataFrame:
    """Slices with an equal context elsewhere (``repeated``; ``later`` if one comes
    before) and the first slice of each context whose key is not alone (``first``)."""
    w = Window.partitionBy("h").orderBy("c1", "c2", "doc_id", "rid", "s0")
    here = F.struct("c1", "c2")
    before, after = F.lag(here).over(w), F.lead(here).over(w)
    place = F.struct("rid", "s0")
    marked = occurrences.withColumns({
        "as_before": F.coalesce(before == here, F.lit(False)), "as_after": F.coalesce(after == here, F.lit(False)),
        "company": before.isNotNull() | after.isNotNull(),
        "same_row": F.coalesce(F.lag(place).over(w) == place, F.lit(False)),
    })
    return marked.select(
        "h", "doc_id", "rid", "s0", "s1", (F.expr("state > 0") | F.col("as_before") | F.col("as_after")).alias("repeated"),
        (F.expr("state = 2") | (F.col("as_before") & ~F.col("same_row"))).alias("later"),
        (F.expr("state < 2") & ~F.col("as_before") & F.col("company")).alias("first")).where("repeated or first")


def _contexts(docs: DataFrame, edges: DataFrame, length: int) -> DataFrame:
    """Cut the representatives' contexts from their texts: (key, kind, c2, doc_id, rid, s0,
    settled, context); kind 1 is one window of a crowded key, by digest."""
    wanted = edges.groupBy(F.col("doc_id").alias("d"), F.col("rid").alias("r")).agg(
        F.collect_list(F.struct("h", (F.col("n") > GROUP_LIMIT).alias("crowded"), "s0", "s1", "repeated")).alias("cuts"))
    schema = pa.schema([("key", pa.int64()), ("kind", pa.int8()), ("c2", pa.int64()), ("doc_id", pa.int64()),
                        ("rid", pa.int64()), ("s0", pa.int32()), ("settled", pa.bool_()), ("context", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_intdigest as h128

        def flush(rows: list) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            rows: list[tuple] = []
            size = 0
            texts = batch.column(2).cast(pa.binary())
            for i, (doc_id, rid, cuts) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                                        batch.column(3).to_pylist(), strict=True)):
                text = texts[i].as_py()
                for c in cuts:
                    if c["crowded"]:
                        for s in range(c["s0"], c["s1"] + 1):
                            d = h128(text[s:s + length])
                            rows.append((_signed(d >> 64), 1, _signed(d & (1 << 64) - 1), doc_id, rid, s, c["repeated"], None))
                    else:
                        rows.append((c["h"], 0, 0, doc_id, rid, c["s0"], c["repeated"], text[c["s0"]:c["s1"] + length]))
                        size += len(rows[-1][7])
                    if size > SORT_BYTES or len(rows) > 50_000:
                        yield flush(rows)
                        rows, size = [], 0
            yield flush(rows)

    joined = docs.join(wanted, same_row(docs, wanted)).select("doc_id", "rid", "t", "cuts")
    return joined.mapInArrow(run, "key long, kind byte, c2 long, doc_id long, rid long, s0 int, settled boolean, context binary")


def suffix_order(contexts: list[bytes], length: int) -> tuple:
    """Suffix array of the joined contexts and the LCP of each suffix with the one before.

    Prefix doubling: ranks of 8, 16, ... bytes until ``length`` is reached, so
    suffixes are ordered by at least ``length`` bytes and equal windows by what
    follows them.  The LCP comes from the same ranks, largest size first, then
    byte by byte.  Only starts with ``length`` bytes left in their context are
    listed; an LCP of ``length`` or more lies inside both contexts.
    """
    import numpy as np

    text = np.frombuffer(b"".join(contexts) + bytes(4 * length + 16), np.uint8)
    u = text.astype(np.uint64)
    for step in (1, 2, 4):
        u = (u[:-step] << np.uint64(8 * step)) | u[step:]
    ranks = {8: np.unique(u, return_inverse=True)[1].astype(np.int32)}
    top = 8
    while top < length:
        r = ranks[top].astype(np.int64)
        ranks[2 * top] = np.unique(r[:-top] * len(r) + r[top:], return_inverse=True)[1].astype(np.int32)
        top *= 2
    ends = np.cumsum([len(c) for c in contexts])
    starts = np.concatenate([np.arange(e - len(c), e - length + 1) for c, e in zip(contexts, ends, strict=True)])
    order = starts[np.argsort(ranks[top][starts], kind="stable")]
    one, two = order[:-1], order[1:]
    common = np.zeros(len(one), np.int64)
    for size in sorted(ranks, reverse=True):
        common += size * (ranks[size][one + common] == ranks[size][two + common])
    same = common < top
    for _ in range(7):
        same = same & (text[one + common] == text[two + common])
        common += same
    return order, np.concatenate([[0], np.minimum(common, top)]).astype(np.int64)


def nearest_smaller(order, lcp, least: int) -> tuple:
    """For each place of the suffix array the nearest earlier place with a smaller
    start, and the LCP with it; (-1, 0) where none has ``least`` bytes in common.

    Minima of 1, 2, 4, ... neighbours let every place skip its larger
    neighbours in blocks, largest block first.
    """
    import numpy as np

    n = len(order)
    cuts = np.flatnonzero(np.concatenate([lcp < least, [True]]))
    widest = int(np.diff(cuts).max()) if len(cuts) > 1 else 0  # places in a row that share ``least`` bytes
    lows, shared = [order], [lcp]
    while 1 << len(lows) < widest:
        half = 1 << len(lows) - 1
        lows.append(np.minimum(lows[-1][:-half], lows[-1][half:]))
        shared.append(np.minimum(shared[-1][:-half], shared[-1][half:]))
    place, common = np.arange(n), np.full(n, np.iinfo(np.int64).max)
    for k in reversed(range(len(lows))):
        back = place - (1 << k)
        at = np.maximum(back, 0)
        block = shared[k][np.minimum(at + 1, len(shared[k]) - 1)]
        skip = (back >= 0) & (lows[k][np.minimum(at, len(lows[k]) - 1)] > order) & (block >= least)
        common = np.where(skip, np.minimum(common, block), common)
        place = np.where(skip, back, place)
    common = np.minimum(common, lcp[place])
    found = (place > 0) & (common >= least)
    return np.where(found, place - 1, -1), np.where(found, common, 0)


def previous_factors(order, lcp, least: int = 1) -> tuple:
    """Longest previous factor of each start in suffix order, and who is its source.

    The longest earlier match of a start is with the nearest smaller start
    before or after it in suffix order.  Returns (LPF by place in the order, 0
    below ``least``; places that are such a nearest smaller start).
    """
    import numpy as np

    n = len(order)
    lpf, source = np.zeros(n, np.int64), np.zeros(n, bool)
    near = np.concatenate([lcp[1:] >= least, [False]]) if n else source
    places = np.flatnonzero(near | (lcp >= least))  # a suffix that shares less with both neighbours has no match
    if not len(places):
        return lpf, source
    start, shared = order[places], np.where(lcp >= least, lcp, 0)[places]
    prev, with_prev = nearest_smaller(start, shared, least)
    back, with_next = nearest_smaller(start[::-1], np.concatenate([[0], shared[:0:-1]]), least)
    after, with_next = len(places) - 1 - back[::-1], with_next[::-1]
    lpf[places] = np.maximum(with_prev, with_next)
    source[places[prev[with_prev > 0]]] = True
    source[places[after[with_next > 0]]] = True
    return lpf, source


def _sorted_groups(contexts: DataFrame, length: int, keep: str) -> DataFrame:
    """Repeated starts (rid, s0, s1) among the contexts that share a key."""
    ordered = contexts.repartition("key").sortWithinPartitions("key", "kind", "c2", "doc_id", "rid", "s0")
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("s0", pa.int32()), ("s1", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        def sort(group: list[dict]) -> list[tuple]:
            texts = [g["context"] for g in group]
            order, lcp = suffix_order(texts, length)
            lpf, source = previous_factors(order, lcp, length)
            hit = lpf >= length
            if keep == "none":
                hit = hit | source
            at = np.sort(order[hit])
            ends = np.cumsum([len(t) for t in texts])
            owner = np.searchsorted(ends, at, side="right")
            out = []
            for run_ in np.split(np.arange(len(at)), np.flatnonzero((np.diff(at) != 1) | (np.diff(owner) != 0)) + 1):
                if len(run_):
                    g = group[owner[run_[0]]]
                    if keep == "none" and g["settled"]:
                        continue
                    shift = g["s0"] - (ends[owner[run_[0]]] - len(g["context"]))
                    out.append((g["doc_id"], g["rid"], int(at[run_[0]] + shift), int(at[run_[-1]] + shift)))
            return out

        def batch_of(rows: Iterable[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        group: list[dict] = []
        size, last = 0, None
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    same = last is not None and last["kind"] == 1 and (last["key"], last["c2"]) == (row["key"], row["c2"])
                    if same:
                        out.append((row["doc_id"], row["rid"], row["s0"], row["s0"]))
                        if keep == "none" and not last["marked"]:
                            out.append((last["doc_id"], last["rid"], last["s0"], last["s0"]))
                    last = {**row, "marked": same}
                    continue
                if size > SORT_BYTES and row["key"] != group[-1]["key"]:
                    out += sort(group)
                    group, size = [], 0
                group.append(row)
                size += len(row["context"])
                last = row
            if out:
                yield batch_of(out)
        if group:
            yield batch_of(sort(group))

    return ordered.mapInArrow(run, "doc_id long, rid long, s0 int, s1 int")


def row_key(text: Column) -> Column:
    """Internal key of a row beside its id: rows that agree in id and text behave alike."""
    return F.xxhash64("doc_id", text)


def same_row(docs: DataFrame, found: DataFrame) -> Column:
    """Rows are named by id and row key, so that equal keys of other documents do no harm."""
    return (docs["rid"] == found["r"]) & docs["doc_id"].eqNullSafe(found["d"])


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep: str = "none") -> DataFrame:
    """(doc_id, rid, s0, s1): every window of ``length`` bytes that starts in s0..s1 repeats.

    ``docs`` has doc_id, rid, t.  keep="first" spares the first occurrence in
    order of (id, row key, offset); keep="none" reports all of them.
    """
    marked = materialize(_classified(_occurrences(docs, length, gram)), "suffix-slices")
    candidates = marked.where("first")
    crowds = candidates.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    contexts = _contexts(docs, candidates.join(crowds, "h"), length)
    found = materialize(_sorted_groups(contexts, length, keep), "suffix-ranges")
    return marked.where("repeated" if keep == "none" else "later").select("doc_id", "rid", "s0", "s1").unionByName(found)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, keep: str = "first", with_text: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if
    ``with_text``, spans (array of struct(start, stop), in bytes) and kept (binary).

    Every byte covered by a ``length``-byte string that also starts elsewhere is
    removed; with keep="first" the first occurrence stays.  Matches lie inside
    one document, may overlap and are judged on the input.  Null texts are
    empty; texts shorter than ``length`` bytes are kept whole.  Rows that repeat
    an id and its text are copies of each other for keep="none" and one document
    for keep="first".  Empty table: empty result.
    """
    prepare(df.sparkSession)
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    docs = docs.select("doc_id", row_key(F.col("t")).alias("rid"), "t")
    ranges = (repeated_ranges(docs, length, gram, keep).groupBy(F.col("doc_id").alias("d"), F.col("rid").alias("r"))
              .agg(F.collect_set(F.struct("s0", "s1")).alias("cuts")))
    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
              ("kept_sha256", pa.string())]
    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        fields += [("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.binary())]
        ddl += ", spans array<struct<start:int,stop:int>>, kept binary"
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column(1).cast(pa.binary())
            for i, (doc_id, cuts) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                text = texts[i].as_py()
                spans: list[dict] = []
                for a, b in sorted((c["s0"], c["s1"] + length) for c in cuts or ()):
                    if spans and a <= spans[-1]["stop"]:
                        spans[-1]["stop"] = max(spans[-1]["stop"], b)
                    else:
                        spans.append({"start": a, "stop": b})
                edges = [0, *(x for s in spans for x in (s["start"], s["stop"])), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                row = (doc_id, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                rows.append((*row, spans, kept) if with_text else row)
            cols = list(zip(*rows, strict=True)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

    joined = docs.join(ranges, same_row(docs, ranges), "left").select("doc_id", "t", "cuts")
    return joined.mapInArrow(run, ddl)
