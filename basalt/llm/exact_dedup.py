"""Exact deduplication by an extendible-hash index on shared files.

1. Every row gets a 64-bit key of its text.  The entries (key, id) are written
   without texts and counted.  A key that occurs once has no copy: its text is
   never moved.
2. The directory starts with one bucket and doubles as long as some bucket holds
   more rows with repeated keys than its capacity; only overfull buckets split,
   the others keep their shorter prefix.  It is built from the row counts of its
   finest slots (at most ``2**max_depth`` rows), so it stays bounded at every
   input size.  Prefixes cannot split one hot key: its n rows are dealt by id to
   about sqrt(n) / 2 slices of the bucket.
3. Texts under repeated keys go to the owner of their range of (bucket, slice).
   The owner sorts each of them by key and bytes and compares neighbours: the
   same key and bytes belong to one link, the same key with other bytes starts
   the next link of the key's chain.  One text per link stays.
4. Links of a sliced key meet again, one per slice and text, and are chained the
   same way; the members take the largest id and the size of their whole chain.

Where the repeated keys are small enough Spark broadcasts them for step 3; beyond
that all texts are joined with them by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.llm.common import materialize, text_of

#: Rows that a slice of a bucket holds before the bucket splits, and the finest directory.
CAPACITY, MAX_DEPTH = 1_000, 14


def grow_directory(counts: dict[int, int], capacity: int, max_depth: int) -> list[tuple[int, int]]:
    """Leaf buckets (depth, prefix) from the row counts of the finest slots.

    Doubling: at each depth the overfull buckets split in two and the rest stay.
    """
    leaves, open_, depth = [], {0: sum(counts.values())}, 0
    while open_:
        full = {p for p, n in open_.items() if n > capacity and depth < max_depth}
        leaves += [(depth, p) for p in open_ if p not in full]
        depth += 1
        open_ = dict.fromkeys((child for p in full for child in (2 * p, 2 * p + 1)), 0) if full else {}
        for slot, n in counts.items():
            p = slot >> (max_depth - depth) if depth <= max_depth else slot
            if p in open_:
                open_[p] += n
    return sorted(leaves)


def bucket_of(key: Column, leaves: list[tuple[int, int]], max_depth: int) -> Column:
    """Bucket number of a 64-bit key: look its finest slot up in the directory."""
    if len(leaves) == 1:
        return F.lit(0)
    slots = [0] * (1 << max_depth)
    for number, (depth, prefix) in enumerate(leaves):
        width = 1 << (max_depth - depth)
        slots[prefix * width:(prefix + 1) * width] = [number] * width
    depth = max(d for d, _ in leaves)  # the directory needs no finer slots than its deepest bucket
    step = 1 << (max_depth - depth)
    directory = F.lit([slots[i] for i in range(0, len(slots), step)])
    return F.get(directory, F.shiftrightunsigned(key, 64 - depth).cast("int"))


def text_key(text: Column) -> Column:
    """64-bit hash key of a text; different texts may share it."""
    return F.xxhash64(text)


def chain_links(held: DataFrame, where: list[str], order: list[str]) -> DataFrame:
    """Compare neighbours within ``where``, in order of key, bytes and ``order``: ``starts``
    marks the first row of each text, ``link`` numbers the texts."""
    w = Window.partitionBy(*where).orderBy("key", "t", *order)
    same = (F.lag("key").over(w) == F.col("key")) & (F.lag("t").over(w) == F.col("t"))
    marked = held.withColumn("starts", ~F.coalesce(same, F.lit(False)))
    return marked.withColumn("link", F.sum(F.col("starts").cast("long")).over(w))


def chained_entries(docs: DataFrame, repeated: DataFrame, capacity: int, max_depth: int) -> DataFrame:
    """Index entries of the rows whose key repeats: bucket, slice, link, key, slices, doc_id,
    text_sha256, and the text ``t`` at the first row of each link (else null).

    ``docs`` has doc_id, t, key; ``repeated`` has key and its number of rows n.
    """
    slices = F.ceil(F.sqrt("n") / 2).alias("slices")
    loads = (repeated.select(F.shiftrightunsigned("key", 64 - max_depth).alias("slot"), F.ceil(F.col("n") / slices).alias("rows"))
             .groupBy("slot").agg(F.sum("rows").alias("rows")))
    leaves = grow_directory({r["slot"]: r["rows"] for r in loads.toLocalIterator()}, capacity, max_depth)
    held = docs.join(repeated.select("key", slices), "key").select(
        bucket_of(F.col("key"), leaves, max_depth).alias("bucket"),
        F.pmod(F.xxhash64("doc_id"), "slices").alias("slice"), "key", "slices", "doc_id", "t")
    linked = chain_links(held.repartitionByRange("bucket", "slice"), ["bucket", "slice"], ["doc_id"])
    return linked.select("bucket", "slice", "link", "key", "slices", "doc_id", F.sha2("t", 256).alias("text_sha256"),
                         F.when(F.col("starts"), F.col("t")).alias("t"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                max_depth: int = MAX_DEPTH) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty.  Of equal texts the
    row with the largest id stays; rows repeating an id are the same document
    and are all kept when it stays (all null ids: keep_id is null, kept).  An
    empty table gives an empty result.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t")).withColumn("key", text_key(F.col("t")))
    entries = materialize(docs.select("doc_id", "key", F.sha2("t", 256).alias("text_sha256")), "exact-entries")
    repeated = materialize(entries.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "exact-keys")
    index = materialize(chained_entries(docs, repeated, capacity, max_depth), "exact-index")
    place = ["bucket", "slice", "link"]
    sums = index.groupBy(*place).agg(F.max("doc_id").alias("top"), F.count("*").alias("rows"))
    heads = index.where("t IS NOT NULL")
    met = chain_links(heads.where("slices > 1").withColumnRenamed("link", "first_link"), ["bucket", "key"], ["slice"])
    chains = materialize(
        heads.where("slices = 1").select(*place, "key", F.col("link").alias("chain")).unionByName(
            met.select("bucket", "slice", F.col("first_link").alias("link"), "key", F.col("link").alias("chain")))
        .join(sums, place), "exact-chains")
    totals = chains.groupBy("key", "chain").agg(F.max("top").alias("keep_id"), F.sum("rows").alias("group_size"))
    members = index.select(*place, "doc_id", "text_sha256").join(
        chains.select(*place, "key", "chain").join(totals, ["key", "chain"]).drop("key", "chain"), place)
    alone = entries.join(repeated, "key", "left_anti").withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long")})
    return alone.select("doc_id", "keep_id", "group_size", "text_sha256").unionByName(members.drop(*place)).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_exact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.  A row stays when both its id
    and its text do, so an id that repeats with other texts (or is null) keeps only those of
    its texts that stay with it; of rows that repeat an id and its text one stays."""
    marks = materialize(exact_dedup(df, id_col, text_col, **kw).where("kept")
                        .select(F.col("doc_id").alias("__kept"), F.col("text_sha256").alias("__kept_digest")), "exact-kept")
    rows = df.withColumn("__digest", F.sha2(text_of(text_col).cast("binary"), 256))
    out = rows.join(marks, F.col(id_col).eqNullSafe(F.col("__kept")) & (F.col("__digest") == F.col("__kept_digest")), "left_semi")
    repeated = not marks.groupBy("__kept", "__kept_digest").count().where("count > 1").isEmpty()
    return (out.dropDuplicates([id_col, "__digest"]) if repeated else out).drop("__digest")
