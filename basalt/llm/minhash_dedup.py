"""MinHash near-duplicate detection with odd sketches.

1. A task turns each text into its set of hashed word shingles, ``BANDS * ROWS``
   MinHash samples, one key per band, and an odd sketch: the samples are folded
   into a parity bitmap, so that the population count of two sketches' XOR
   estimates how many samples differ, most sharply at high similarity.
2. Documents with equal sets form one class, named by its smallest id; only
   classes go on, so exact copies are never compared.
3. Per band bucket, every class is paired with one representative (a star, not
   all pairs); each band picks another.  The representative is found by a
   min-aggregate with a map-side part.
4. A sketch filter drops pairs far below the threshold (its margin is six
   standard deviations); the rest is confirmed on the full sets.
5. Links are contracted to components.  A bucket may still hold strays: members
   outside its representative's component.  A second pass tests them, so the star
   loses no link that a bucket holds: per component, its strays are compared with
   its members and with each other, in bounded blocks inside the tasks, which emit
   links and never pairs.

With 30 bands of 5 rows a pair at similarity 0.8 meets in no bucket with a
probability below 7e-6, at 0.85 below 3e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import components, materialize, prepare, text_of

BANDS, ROWS, SKETCH_BITS = 30, 5, 512
#: XOR population count up to which a pair is confirmed on the full sets.  At the
#: threshold of 0.8 it is 54 on average; six deviations of samples and sketch stay below 104.
MAX_FLIPS = 104
#: Sets of one side of a block comparison.
BLOCK = 512
#: Shingles hashed at once, which bounds a task's memory on very long texts.
CHUNK = 4096


def _mix(x):
    import numpy as np

    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str, k: int):
    """Sorted distinct 64-bit hashes of the text's k-word shingles.

    A-Z is lower-cased, words are runs of anything but ASCII white space.  With
    fewer than k words the whole sequence is one shingle; without words the set
    is empty.
    """
    import numpy as np
    from xxhash import xxh3_64_intdigest

    found = text.encode().lower().split()  # bytes: ASCII case and ASCII white space only
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(k, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i:len(h) - width + 1 + i])
    return np.unique(out)


def _signer(k: int) -> Callable:
    import numpy as np
    from xxhash import xxh3_128_intdigest

    n = BANDS * ROWS
    rng = np.random.default_rng(20_240_601)
    flip = rng.integers(0, 1 << 64, n, np.uint64)[:, None]
    odd = (rng.integers(0, 1 << 64, n, np.uint64) | np.uint64(1))[:, None]
    salt = rng.integers(0, 1 << 64, n, np.uint64)
    band = rng.integers(0, 1 << 64, BANDS, np.uint64)

    def sign(text: str) -> tuple:
        s = shingle_set(text, k)
        if not len(s):
            return 0, 0, 0, [], []
        low = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
        for i in range(0, len(s), CHUNK):
            low = np.minimum(low, ((s[i:i + CHUNK] ^ flip) * odd).min(axis=1))
        low = _mix(low ^ salt)
        keys = band
        for r in range(ROWS):
            keys = _mix(keys ^ low.reshape(BANDS, ROWS)[:, r])
        parity = (np.bincount((low % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
        sketch = np.packbits(parity).view(np.int64)
        digest = xxh3_128_intdigest(s.tobytes())
        return (len(s), *np.array([digest >> 64, digest & (1 << 64) - 1], np.uint64).view(np.int64).tolist(),
                keys.view(np.int64).tolist(), sketch.tolist())
    return sign


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, t) -> doc_id, n_shingles, d1, d2 (digest of the set), keys, sketch."""
    prepare(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()),
                        ("keys", pa.list_(pa.int64())), ("sketch", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = _signer(k)
        for batch in batches:
            rows = [sign(t) for t in batch.column(1).to_pylist()]
            cols = [list(c) for c in zip(*rows, strict=True)] or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)] + [pa.array(c, f.type) for c, f in zip(cols, list(schema)[1:], strict=True)], schema=schema)

    return docs.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, sketch array<long>")


def _sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(cid, shingles as sorted 64-bit little-endian bytes) of the documents in ``ids``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [shingle_set(t, k).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], names=["cid", "shingles"])

    # the same join at every size: a broadcast of the ids would grow with the data
    wanted = docs.join(ids.hint("merge"), docs["doc_id"] == ids["cid"], "left_semi").dropDuplicates(["doc_id"])
    return wanted.mapInArrow(run, "cid long, shingles binary")


def _similar(x, y, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    import numpy as np

    if len(x) > len(y):
        x, y = y, x
    if 100 * len(x) < percent * len(y):
        return False
    both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            keep = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = (pairs.join(sets.select(F.col("cid").alias("a"), F.col("shingles").alias("x")), "a")
              .join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("y")), "b").select("a", "b", "x", "y"))
    return joined.mapInArrow(run, "a long, b long")


def _flips(x: str, y: str) -> Column:
    """Population count of the XOR of two sketches."""
    words = [F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i])) for i in range(SKETCH_BITS // 64)]
    return reduce(Column.__add__, words)


def _likely(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs whose odd sketches differ in at most MAX_FLIPS bits."""
    sketches = reps.select("cid", "sketch")
    return (pairs.join(sketches.select(F.col("cid").alias("a"), F.col("sketch").alias("sa")), "a")
            .join(sketches.select(F.col("cid").alias("b"), F.col("sketch").alias("sb")), "b")
            .where(_flips("sa", "sb") <= MAX_FLIPS).select("a", "b"))


def _near_component(strays: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of strays (component, cid, own) with the members (component, cid) of their
    component and with its other strays, where their own components differ.

    Both sides are dealt to blocks of about BLOCK sets by a hash; a task compares one
    block of strays with one of the others, the most similar sketches first, and emits
    one link for each stray and component it joins.
    """
    others = (members.join(strays.select("component").distinct(), "component", "left_semi")
              .select("component", "cid", F.col("component").alias("own")).unionByName(strays))
    counts = (strays.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nx"))
              .join(others.groupBy("component").agg(F.count("*").alias("m")).where("m > 1"), "component")
              .select("component", "nx", F.ceil(F.col("m") / BLOCK).cast("int").alias("nm")))

    def dealt(df: DataFrame, side: int, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        return (df.join(counts, "component")
                .select("component", "cid", "own", F.lit(side).alias("side"), F.pmod(F.xxhash64("cid"), own).cast("int").alias(names[0]),
                        F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(names[1])))

    both = dealt(strays, 0, "nx", "nm", ("bx", "bm")).unionByName(dealt(others, 1, "nm", "nx", ("bm", "bx")))

    def run(t: pa.Table) -> pa.Table:
        import numpy as np

        side, cid, own = (t.column(c).to_numpy() for c in ("side", "cid", "own"))
        sketch = np.array(t.column("sketch").to_pylist(), np.int64).view(np.uint64).reshape(len(cid), -1)
        held = [np.frombuffer(x, np.uint64) for x in t.column("shingles").to_pylist()]
        there = np.flatnonzero(side == 1)
        found = []
        for i in np.flatnonzero(side == 0):
            flips = np.bitwise_count(sketch[there] ^ sketch[i]).sum(axis=1)
            joined = {own[i]}
            for k in np.argsort(flips, kind="stable"):
                j = there[k]
                if flips[k] > MAX_FLIPS:
                    break
                if own[j] not in joined and _similar(held[i], held[j], percent):
                    joined.add(own[j])
                    found.append((cid[i], cid[j]))
        return pa.table({"a": pa.array([min(x) for x in found], pa.int64()), "b": pa.array([max(x) for x in found], pa.int64())})

    return (both.join(sets, "cid").select("component", "bx", "bm", "side", "cid", "own", "sketch", "shingles")
            .groupBy("component", "bx", "bm").applyInArrow(run, "a long, b long"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
               percent: int = 80) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * intersection >= percent * union of their
    sets of ``shingle_words``-word shingles; component_id is the smallest id
    reachable by links, kept is ``doc_id = component_id``.  Documents without
    words (null and blank texts) have an empty set and are linked with nothing.
    Rows without an id are linked with nothing and kept (component_id null).
    Rows that repeat an id are the same document.  Empty table: empty result.
    """
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("t"))
    signed = materialize(signatures(docs, shingle_words), "near-signed")
    linkable = signed.where("n_shingles > 0 and doc_id is not null")
    classes = linkable.groupBy("d1", "d2").agg(F.min("doc_id").alias("cid"))
    known = materialize(
        linkable.join(classes, ["d1", "d2"])
        .select("doc_id", "cid", *[F.when(F.col("doc_id") == F.col("cid"), F.col(c)).alias(c) for c in ("keys", "sketch")]),
        "near-classes")
    reps = known.where("doc_id = cid")
    bands = reps.select("cid", F.explode("keys").alias("key"))
    # the representative of a bucket: smallest id under a mask drawn from the key
    buckets = (bands.groupBy("key").agg(F.min(F.col("cid").bitwiseXOR(F.xxhash64("key"))).alias("low"),
                                        F.count("*").alias("m")).where("m > 1")
               .select("key", F.col("low").bitwiseXOR(F.xxhash64("key")).alias("rep")))
    shared = materialize(bands.join(buckets, "key").select("key", "cid", "rep"), "near-buckets")
    stars = shared.where("cid <> rep").select(F.least("cid", "rep").alias("a"), F.greatest("cid", "rep").alias("b")).distinct()
    first = materialize(_likely(stars, reps), "near-pairs")
    plain = _sets(docs, shared.select("cid").distinct(), shingle_words)
    sets = materialize(plain.join(reps.select("cid", "sketch"), "cid"), "near-sets")
    links = materialize(_confirm(first, sets, percent), "near-links")
    grouped = materialize(components(links), "near-components")

    # second pass: members of a bucket that are not in its representative's component
    label = grouped.select(F.col("id").alias("cid"), F.col("component").alias("own"))
    rep_label = grouped.select(F.col("id").alias("rep"), F.col("component").alias("of_rep"))
    strays = materialize(
        shared.where("cid <> rep").join(label, "cid", "left").join(rep_label, "rep", "left")
        .select(F.coalesce("of_rep", "rep").alias("component"), "cid", F.coalesce("own", "cid").alias("own"))
        .where("own <> component").distinct(), "near-strays")
    members = grouped.select("component", F.col("id").alias("cid")).distinct()
    late = materialize(_near_component(strays, members, sets, percent), "near-links")
    if not late.isEmpty():
        grouped = components(late.unionByName(grouped.select(F.col("id").alias("a"), F.col("component").alias("b"))))
    final = known.join(grouped.select(F.col("id").alias("cid"), "component"), "cid", "left") \
        .select("doc_id", F.coalesce("component", "cid").alias("component")).distinct()
    return (signed.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(df: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``df`` whose document stands for its group, with all their columns."""
    kept = near_dedup(df, id_col=id_col, **kw).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return df.join(kept, F.col(id_col).eqNullSafe(F.col("__kept")), "left_semi")
