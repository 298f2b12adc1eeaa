"""Near-duplicate vectors by sorted projection passes.

Each pass orders the vectors lexicographically by a key of random projections
and compares every vector with the rows near it in that order: its block and the
next one.  Blocks have a fixed number of rows, so a comparison is one bounded
matrix product.  Where two blocks still hold a link at the window's end, the
window moves on block by block until it finds none, so groups larger than a
window are compared in full.  Links of all passes are united; cosines are
computed in double precision.

The leading bits of a key cut a sample of the vectors at its medians, node by
node, and the other bits are centred on the sample's leaf; so a topic that holds
a large share of the rows is cut as finely as the rest.  The number of passes
follows from the rows: sampled vectors and partners at just the threshold are
sent through passes over the real number of blocks until at most ``MISS`` of
these pairs have met in none.  This is so at every size; ``exact=True`` compares
all pairs of blocks instead, whose work grows with the square of the rows.

Equal vectors are collapsed first (a map-side combine) and count with their
multiplicity, so a vector that a third of all rows share is one row here.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basalt.llm.common import components, materialize, prepare

#: Share of the pairs at the threshold that the passes may miss.
MISS, BLOCK, KEY_BITS, SEED = 0.002, 1024, 40, 97
#: Sampled vectors of a length, those of a leaf, and pairs that the number of passes is found with.
SAMPLE, LEAF, PROBES = 16_384, 16, 4096


class Forest(NamedTuple):
    """Passes over the vectors of a length: numbers, projections, cuts by node, centres by leaf."""

    first: int
    planes: list
    cuts: list
    centres: list


def _unit(m):
    import numpy as np

    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _tree(sample, planes):
    """Cuts of the nodes (a heap from 1 on) at the sample's medians, centres of the leaves for the other bits."""
    import numpy as np

    projected = sample @ planes
    depth = max(0, min(KEY_BITS, int(np.log2(max(1, len(sample) / LEAF)))))
    cuts, node = np.zeros(1 << depth), np.ones(len(sample), np.int64)
    for level in range(depth):
        order = np.lexsort((projected[:, level], node))
        nodes = np.arange(1 << level, 2 << level)
        low, high = (np.searchsorted(node[order], nodes, side=s) for s in ("left", "right"))
        value = projected[order, level]
        middle = np.clip((low + high) // 2, 0, len(sample) - 1)
        cuts[nodes] = np.where(high > low, (value[np.maximum(middle - 1, 0)] + value[middle]) / 2, 0)
        node = 2 * node + (projected[:, level] > cuts[node])
    leaf = node - (1 << depth)
    size = np.maximum(np.bincount(leaf, minlength=1 << depth), 1)
    centres = [np.bincount(leaf, projected[:, k], 1 << depth) / size for k in range(depth, KEY_BITS)]
    return cuts, np.stack(centres, axis=1).astype(np.float32) if centres else np.zeros((1 << depth, 0), np.float32)


def _key(unit, planes, cuts, centres):
    """The sort key of each unit vector in one pass."""
    import numpy as np

    depth = len(cuts).bit_length() - 1
    projected, node = unit @ planes, np.ones(len(unit), np.int64)
    for level in range(depth):
        node = 2 * node + (projected[:, level] > cuts[node])
    leaf, rest = node - len(cuts), KEY_BITS - depth
    bits = (projected[:, depth:] > centres[leaf]).astype(np.int64)
    return (leaf << rest) + bits @ (np.int64(1) << np.arange(rest - 1, -1, -1, dtype=np.int64))


def forest_for(sample, n: int, block: int, threshold: float, miss: float, seed: int, first: int = 0,
               passes: int | None = None) -> Forest:
    """Passes for ``n`` vectors of which ``sample`` is a sample (unit rows), as many as the
    model needs for ``miss``.  ``passes`` fixes their number instead."""
    import numpy as np

    dim = sample.shape[1]
    rng = np.random.default_rng([seed, dim])
    x = sample[rng.permutation(len(sample))[:PROBES]]
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.maximum(np.sqrt((side * side).sum(axis=1, keepdims=True)), 1e-300)
    y = threshold * x + np.sqrt(max(0.0, 1 - threshold * threshold)) * side
    apart, out = np.ones(len(x), bool), Forest(first, [], [], [])
    while apart.mean() > miss if passes is None else len(out.planes) < passes:
        planes = rng.standard_normal((dim, KEY_BITS))
        one = (planes, *_tree(sample, planes))
        for kept, part in zip(out[1:], one, strict=True):
            kept.append(part)
        if passes is None:
            start = rng.random()
            at, other = (np.floor(_key(v, *one) / 2.0 ** KEY_BITS * n / block + start) for v in (x, y))
            apart &= np.abs(at - other) > 1
    return out


def _usable(df: DataFrame, single: bool) -> DataFrame:
    """(vec_id, v) -> vec_id, raw (bytes of the vector), dim; unusable vectors are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            ids, raw, dims = [], [], []
            for vec_id, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if vec_id is None or not v or any(x is None for x in v):
                    continue
                a = np.asarray(v, np.float32 if single else np.float64)
                if np.isfinite(a).all() and a.any():
                    ids.append(vec_id)
                    raw.append((a + 0).tobytes())  # -0.0 becomes 0.0
                    dims.append(len(a))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(dims, pa.int32())],
                                             names=["vec_id", "raw", "dim"])

    return df.mapInArrow(run, "vec_id long, raw binary, dim int")


def _vectors(raw: list, single: bool):
    import numpy as np

    return _unit(np.stack([np.frombuffer(x, np.float32 if single else np.float64) for x in raw]).astype(np.float64))


def _keyed(reps: DataFrame, forests: dict[int, Forest], whole: dict[int, int], single: bool) -> DataFrame:
    """(digest, cid, dim, raw) -> digest, cid, dim, passes, keys.  Vectors of a length in
    ``whole`` have that one pass; those of other lengths without a forest have pass 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            dims = batch.column("dim").to_numpy()
            passes, keys = [[whole.get(d, 0)] for d in dims.tolist()], [[0]] * len(dims)
            raw = batch.column("raw").to_pylist()
            for d in set(dims.tolist()) & set(forests):
                own = np.flatnonzero(dims == d)
                unit, forest = _vectors([raw[i] for i in own], single), forests[d]
                found = np.stack([_key(unit, *one) for one in zip(*forest[1:], strict=True)], axis=1).tolist()
                numbers = list(range(forest.first, forest.first + len(forest.planes)))
                for i, k in zip(own.tolist(), found, strict=True):
                    passes[i], keys[i] = numbers, k
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), batch.column("cid"), batch.column("dim"),
                 pa.array(passes, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))],
                names=["digest", "cid", "dim", "passes", "keys"])

    return (reps.select("digest", "cid", "dim", "raw")
            .mapInArrow(run, "digest binary, cid long, dim int, passes array<int>, keys array<long>"))


def _numbered(ordered: DataFrame) -> DataFrame:
    """Adds the written partition and the row's place in it, as data."""
    names = ["pass", "digest", "part", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(place, place + n))],
                names=names)
            place += n

    return ordered.select(*names[:2]).mapInArrow(run, "pass int, digest binary, part int, place long")


def _compare(rows: DataFrame, reps: DataFrame, pairs: DataFrame, threshold: float, single: bool) -> DataFrame:
    """Compare the rows of block ``b`` with those of block ``c`` for each (pass, b, c) in
    ``pairs``: links (a, b) with a < b, and per pair of blocks a row without ids if it has a link."""
    left = rows.join(pairs, ["pass", "block"]).select("pass", "block", "other", F.lit(0).alias("side"), "digest")
    right = (rows.withColumnRenamed("block", "other").join(pairs.where("block <> other"), ["pass", "other"])
             .select("pass", "block", "other", F.lit(1).alias("side"), "digest"))
    both = left.unionByName(right).join(reps.select("digest", "cid", "dim", "raw"), "digest").drop("digest")

    def run(key: tuple, t: pa.Table) -> pa.Table:
        import numpy as np

        side, cid, dim = (t.column(c).to_numpy() for c in ("side", "cid", "dim"))
        raw = t.column("raw").to_pylist()
        found_a, found_b = [], []
        for d in np.unique(dim):
            own = dim == d
            m = _vectors([raw[i] for i in np.flatnonzero(own)], single)
            ids, s = cid[own], side[own]
            alone = not (side == 1).any() and key[1].as_py() == key[2].as_py()
            x, y = (m, m) if alone else (m[s == 0], m[s == 1])
            ix, iy = (ids, ids) if alone else (ids[s == 0], ids[s == 1])
            i, j = np.nonzero(x @ y.T >= threshold)
            a, b = ix[i], iy[j]
            keep = a < b if alone else a != b
            found_a.append(np.minimum(a, b)[keep])
            found_b.append(np.maximum(a, b)[keep])
        a = np.concatenate([np.empty(0, np.int64), *found_a])
        b = np.concatenate([np.empty(0, np.int64), *found_b])
        n = len(a)
        return pa.table({"pass": pa.array([key[0].as_py()] * n, pa.int32()), "block": pa.array([key[1].as_py()] * n, pa.int64()),
                         "other": pa.array([key[2].as_py()] * n, pa.int64()), "a": pa.array(a), "b": pa.array(b)})

    return (both.groupBy("pass", "block", "other")
            .applyInArrow(run, "pass int, block long, other long, a long, b long"))


def _samples(reps: DataFrame, sizes: dict[int, int], single: bool) -> dict:
    """About SAMPLE unit vectors of each length in ``sizes``, drawn by a hash of their digest."""
    if not sizes:
        return {}
    drawn = F.pmod(F.xxhash64("digest"), F.lit(1 << 40)) / float(1 << 40)
    rows = reps.where(reduce(or_, [(F.col("dim") == d) & (drawn < SAMPLE / n) for d, n in sizes.items()]))
    raw: dict[int, list] = {}
    for r in rows.select("dim", "digest", "raw").collect():
        raw.setdefault(r["dim"], []).append((bytes(r["digest"]), bytes(r["raw"])))
    return {d: _vectors([x for _, x in sorted(own)], single) for d, own in sorted(raw.items())}


def near_dedup(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.95,
               passes: int | None = None, block: int = BLOCK, seed: int = SEED, miss: float = MISS,
               exact: bool = False) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors are linked when a pass brings them together and their cosine is at
    least ``threshold``; by the model of the passes, at most ``miss`` of the pairs
    at just the threshold never meet (``passes`` fixes the number of passes instead).
    ``exact`` compares all pairs and misses none, at a cost that grows with the square of the rows.
    Vectors that are null, empty, zero, or hold null or non-finite components,
    vectors without an id, and vectors of different length link with nothing.  Rows that repeat an id are the same vector only
    if they hold the same numbers; else they all link under that id.
    """
    spark = df.sparkSession
    prepare(spark)
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    single = "array<float>" in df.select(vec_col).dtypes[0][1]
    usable = materialize(_usable(rows, single).withColumn("digest", F.unhex(F.sha2("raw", 256))), "vec-usable")
    classes = usable.groupBy("digest").agg(F.min("vec_id").alias("cid"), F.count("*").alias("copies"))
    member = materialize(usable.join(classes, "digest")
                         .select("vec_id", "cid", "copies", "digest", *[F.when(F.col("vec_id") == F.col("cid"), F.col(c)).alias(c)
                                                                        for c in ("raw", "dim")]), "vec-classes")
    reps = materialize(member.where("vec_id = cid").dropDuplicates(["digest"]), "vec-reps")
    sizes = {r["dim"]: r["count"] for r in reps.groupBy("dim").count().where(F.col("count") > block).collect()}
    forests, whole, number = {}, {}, 1
    if exact:
        whole = {dim: number for number, dim in enumerate(sorted(sizes), 1)}
    else:
        for dim, sample in _samples(reps, sizes, single).items():
            forests[dim] = forest_for(sample, sizes[dim], block, threshold, miss, seed, number, passes)
            number += len(forests[dim].planes)
    keyed = materialize(_keyed(reps, forests, whole, single), "vec-keyed")
    deal = keyed.select("digest", "cid", "dim", F.inline(F.arrays_zip(F.col("passes").alias("pass"), F.col("keys").alias("key"))))
    ordered = deal.repartitionByRange("pass", "dim", "key", "cid").sortWithinPartitions("pass", "dim", "key", "cid")
    numbered = materialize(_numbered(ordered), "vec-ordered")
    before = Window.partitionBy("pass").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (numbered.groupBy("pass", "part").agg(F.count("*").alias("n"), F.min("place").alias("low"))
             .select("pass", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift")))
    placed = numbered.join(parts, ["pass", "part"]).select(
        "pass", ((F.col("place") + F.col("shift")) / block).cast("long").alias("block"), "digest")
    placed = materialize(placed, "vec-blocks")
    blocks = placed.select("pass", "block").distinct()
    last = F.max("block").over(Window.partitionBy("pass"))
    blocks = materialize(blocks.withColumn("last", last), "vec-list")
    until = F.when(F.col("pass").isin(*whole.values()), F.col("last")).otherwise(F.least(F.col("block") + 1, "last"))
    pairs = blocks.select("pass", "block", F.explode(F.sequence("block", until)).alias("other"))
    found, links = _compare(placed, reps, pairs, threshold, single), None
    while True:
        found = materialize(found, "vec-links")
        links = found.select("a", "b") if links is None else links.unionByName(found.select("a", "b"))
        pairs = (found.where((F.col("other") > F.col("block")) & ~F.col("pass").isin(*whole.values()))
                 .select("pass", "block", "other").distinct()
                 .join(blocks.select("pass", "last").distinct(), "pass")
                 .select("pass", "block", (F.col("other") + 1).alias("other"), "last").where("other <= last"))
        pairs = materialize(pairs.drop("last"), "vec-list")
        if pairs.isEmpty():
            break
        found = _compare(placed, reps, pairs, threshold, single)
    links = materialize(links.distinct(), "vec-pairs")
    grouped = components(links)
    copies = reps.select(F.col("cid").alias("b"), "copies").distinct()
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(copies, "b").groupBy("a").agg(F.sum("copies").alias("near")).withColumnRenamed("a", "cid")
    per_class = (reps.select("cid", "copies").distinct().join(degree, "cid", "left")
                 .join(grouped.withColumnRenamed("id", "cid"), "cid", "left")
                 .select("cid", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "cid").alias("component_id")))
    known = (member.select("vec_id", "cid").join(per_class, "cid").groupBy("vec_id")
             .agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")))
    return (rows.select("vec_id").join(known, "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                    F.coalesce("component_id", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
