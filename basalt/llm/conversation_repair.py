"""Cheapest repair of the turn structure of conversations, by a square-root checkpointed DP.

The rows of a conversation, in order, are edited so that the initials of the roles read
``(s?(ua)+)?``.  Costs: Keep 0, Rerole (to user or assistant) 3, Delete 4, Insert (an
empty user or assistant row) 3; an undeleted truncated row adds 3; blank and
duplicate rows must go.  Of the cheapest edit strings (initials D, I, K, R) the
ASCII-least is taken.

A conversation of n rows is cut into blocks of ceil(sqrt(n)) rows.  The cost to go
is a vector over four states (nothing yet; after the system row; after a user;
after an assistant), and a block maps the vector behind it to the one before it.
1. every block gives that map as a 4 x 4 matrix (minimum, plus), in parallel;
2. per conversation, from its last block to its first, the vectors at the block ends
   follow from the matrices alone: these checkpoints are all that is stored;
3. every block recomputes its inner vectors from its checkpoint and walks forward from
   each state it may be entered in, in parallel;
4. per conversation, from first to last, the exits tell each block's entry.
So one task never holds more than a block, and of a conversation with a third of
all rows only sqrt(n) matrices pass through one task.  Texts stay out of all this: rows
are known by a digest, and texts meet the surviving rows at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basalt.llm.common import materialize, prepare

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: 0 nothing yet, 1 after the system row, 2 after a user, 3 after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"
#: The state after keeping a row with this initial, by the state before.
KEEP = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The state after the only row that a rerole or an insert can give there.
PUT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
#: Cost to go behind the last row: the trailing inserts.
AT_END = (0, 6, 3, 0)
LEGAL = {"su", "ua", "au"}
#: Blocks up to this length are remembered by their classes.
MEMO_LENGTH = 24

_FAULTS = ("plain", "truncated", "gone")


def class_of(initial: str, fault: str) -> str:
    """One letter for what the DP needs of a row."""
    return chr(ord("A") + 4 * _FAULTS.index(fault) + (INITIALS.index(initial) if initial in INITIALS and initial else 3))


_CLASSES = {class_of(i, f): (i, f) for f in _FAULTS for i in "sua?"}


def _before(letter: str, after: tuple) -> tuple:
    """Cost to go before a row of this class, from the cost to go behind it."""
    initial, fault = _CLASSES[letter]
    extra = TRUNCATED if fault == "truncated" else 0
    v = []
    for q in range(4):
        best = DELETE + after[q]
        if fault != "gone":
            best = min(best, REROLE + extra + after[PUT[q]])
            if initial in KEEP[q]:
                best = min(best, extra + after[KEEP[q][initial]])
        v.append(best)
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[START], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


def _matrix(classes: str) -> tuple:
    """Costs from each state before the block to each state behind it (16 numbers, row by row)."""
    columns = []
    for j in range(4):
        v = tuple(0 if q == j else FAR for q in range(4))
        for letter in reversed(classes):
            v = _before(letter, v)
        columns.append(v)
    return tuple(columns[j][q] for q in range(4) for j in range(4))


def _walks(classes: str, end: tuple, last: bool) -> tuple:
    """The ASCII-least tight edits of a block from each state before it: (letters, state behind it)."""
    vectors = [end]
    for letter in reversed(classes):
        vectors.append(_before(letter, vectors[-1]))
    vectors.reverse()
    out = []
    for entry in range(4):
        q, letters = entry, []
        for i, letter in enumerate(classes):
            initial, fault = _CLASSES[letter]
            extra = TRUNCATED if fault == "truncated" else 0
            here, after = vectors[i], vectors[i + 1]
            while here[q] != DELETE + after[q] and here[q] == INSERT + here[PUT[q]]:
                letters.append("I")
                q = PUT[q]
            if here[q] == DELETE + after[q]:
                letters.append("D")
            elif initial in KEEP[q] and here[q] == extra + after[KEEP[q][initial]]:
                letters.append("K")
                q = KEEP[q][initial]
            else:
                letters.append("R")
                q = PUT[q]
        while last and end[q]:
            letters.append("I")
            q = PUT[q]
        out.append(("".join(letters), q))
    return tuple(out)


_short_matrix, _short_walks = lru_cache(1 << 14)(_matrix), lru_cache(1 << 15)(_walks)


def block_matrix(classes: str) -> tuple:
    return (_short_matrix if len(classes) <= MEMO_LENGTH else _matrix)(classes)


def block_walks(classes: str, end: tuple, last: bool) -> tuple:
    low = min(end)  # only differences decide
    return (_short_walks if len(classes) <= MEMO_LENGTH else _walks)(classes, tuple(v - low for v in end), last)


def survivors(classes: str, letters: str, state: int) -> Iterator[tuple[int | None, str | None, str]]:
    """(row of the block or None for an insert, new role or None, letter) of each row that remains."""
    i, q = 0, state
    for letter in letters:
        if letter == "K":
            q = KEEP[q][_CLASSES[classes[i]][0]]
            yield i, None, letter
        elif letter != "D":
            q = PUT[q]
            yield (i if letter == "R" else None), ROLE_OF[q], letter
        i += letter != "I"


def illegal_pairs(initials: str) -> int:
    return sum(initials[i:i + 2] not in LEGAL for i in range(len(initials) - 1))


def _map(df: DataFrame, schema: str, rows: Callable[[Iterator[tuple]], Iterator[tuple]]) -> DataFrame:
    """A stream of row tuples per task; ``rows`` keeps its state from batch to batch."""
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()),
             "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    fields = [c.split() for c in schema.split(", ")]
    names, types = [n for n, _ in fields], [kinds[t] for _, t in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def incoming() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple] = []
        for row in rows(incoming()):
            out.append(row)
            if len(out) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)
                out.clear()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    return df.mapInArrow(run, schema)


def _blocks(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, block, first, classes in rows:
        initials = "".join(_CLASSES[c][0] for c in classes)
        yield conv, block, first, classes, list(block_matrix(classes)), illegal_pairs(initials), initials[0], initials[-1]


def _checkpoints(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Blocks from last to first: the vector behind each, the cost before the first, illegal pairs up to the next block."""
    conv, v, follow = object(), AT_END, None
    for c, block, first, m, illegal, head, tail in rows:
        last = c != conv
        if last:
            conv, v, follow = c, AT_END, None
        end = v
        v = tuple(min(m[4 * q + j] + end[j] for j in range(4)) for q in range(4))
        yield (first, list(end), last, v[START] if block == 0 else 0,
               illegal + (0 if follow is None else illegal_pairs(tail + follow)))
        follow = head


def _walk_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, block, first, classes, end, last in rows:
        found = block_walks(classes, tuple(end), last)
        yield (conv, block, first, [w for w, _ in found], [q for _, q in found], [len(w) - w.count("D") for w, _ in found])


def _entries(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Blocks from first to last: the state each is entered in and the repaired rows before it."""
    conv, q, seq = object(), START, 0
    for c, _, first, exits, remain in rows:
        if c != conv:
            conv, q, seq = c, START, 0
        yield first, q, seq
        seq += remain[q]
        q = exits[q]


def _edited(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv, first, classes, letters, state, seq in rows:
        for n, (i, role, letter) in enumerate(survivors(classes, letters, state)):
            yield conv, seq + n, None if i is None else first + i, letter, role


def _digest() -> Column:
    """What tells rows of one conversation apart: role and text (128 bits)."""
    return F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))).alias("digest")


def place(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) without their text, numbered in conversation order, with their first fault.

    ``g`` numbers all rows by (conv_id, turn, digest), nulls first: a range sort written once, plus one offset per
    partition, so no conversation has to fit a task.  Rows of one turn are ordered by the digest of role and
    text.  The first row of each (conversation, role, text) is found by a minimum of ``g`` and joined by ``g``.
    """
    solid = F.rtrim("text", F.lit(" \t\n\x0b\x0c\r"))
    light = rows.select(
        "conv_id", "turn", _digest(),
        F.substring("role", 1, 1).alias("initial"), (solid == "").alias("blank"),
        (~F.substring(solid, -1, 1).isin(".", "!", "?")).alias("cut"))
    keys = ["conv_id", "turn", "digest"]
    placed = materialize(light.repartitionByRange(*keys).sortWithinPartitions(*keys)
                         .withColumn("at", F.monotonically_increasing_id()), "turns").withColumn("pid", F.shiftright("at", 33))
    counts = placed.groupBy("pid").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_at"))
    before = Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("pid", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_at")).alias("shift"))
    numbered = placed.join(F.broadcast(offsets), "pid").withColumn("g", F.col("at") + F.col("shift"))  # one row a partition
    firsts = (numbered.where(~F.col("blank")).groupBy("conv_id", "digest").agg(F.min("g").alias("g"))
              .select("g", F.lit(True).alias("first")))
    sizes = numbered.groupBy(F.col("conv_id").alias("c")).agg(F.min("g").alias("start"), F.count(F.lit(1)).alias("n_rows"))
    width = F.ceil(F.sqrt("n_rows"))
    fault = (F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated"))
    joined = (numbered.join(firsts, "g", "left").join(sizes, F.col("conv_id").eqNullSafe(F.col("c")))
              .select("g", "conv_id", "turn", "digest", "initial", fault.alias("fault"),
                      F.floor((F.col("g") - F.col("start")) / width).alias("block")))
    return materialize(joined, "turns")


def _class_column() -> Column:
    order = F.when(F.col("fault").isNull(), 0).when(F.col("fault") == "truncated", 4).otherwise(8)
    initial = F.when(F.col("initial") == "s", 0).when(F.col("initial") == "u", 1).when(F.col("initial") == "a", 2).otherwise(3)
    return F.char(F.lit(ord("A")) + order + initial)


def edits(placed: DataFrame) -> DataFrame:
    """One row per block of :func:`place`: conv_id, block, first (its first ``g``), classes, letters, state (before
    it), seq (repaired rows before it), cost (of the whole conversation on its block 0, else 0), illegal."""
    prepare(placed.sparkSession)
    strings = (placed.select("conv_id", "block", "g", _class_column().alias("class"))
               .groupBy("conv_id", "block").agg(F.min("g").alias("first"), F.sort_array(F.collect_list(F.struct("g", "class"))).alias("rows"))
               .select("conv_id", "block", "first", F.array_join(F.col("rows.class"), "").alias("classes")))
    blocks = materialize(_map(strings, "conv_id long, block long, first long, classes string, m array<long>, illegal long, "
                              "head string, tail string", _blocks), "blocks")
    ends = _map(blocks.select("conv_id", "block", "first", "m", "illegal", "head", "tail").repartition("conv_id")
                .sortWithinPartitions("conv_id", F.desc("block")),
                "first long, end array<long>, last boolean, cost long, illegal long", _checkpoints)
    ends = materialize(ends, "checkpoints")
    walks = _map(blocks.select("conv_id", "block", "first", "classes").join(ends.select("first", "end", "last"), "first")
                 .select("conv_id", "block", "first", "classes", "end", "last"),
                 "conv_id long, block long, first long, walks array<string>, exits array<int>, remain array<long>", _walk_rows)
    walks = materialize(walks, "walks")
    entries = _map(walks.select("conv_id", "block", "first", "exits", "remain").repartition("conv_id")
                   .sortWithinPartitions("conv_id", "block"), "first long, state int, seq long", _entries)
    out = (blocks.select("first", "classes").join(walks.select("conv_id", "block", "first", "walks"), "first").join(entries, "first")
           .join(ends.select("first", "cost", "illegal"), "first")
           .select("conv_id", "block", "first", "classes", F.get("walks", "state").alias("letters"), "state", "seq", "cost", "illegal"))
    return materialize(out, "edits")


def report(placed: DataFrame, edited: DataFrame) -> DataFrame:
    """Per conversation that has rows: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    count = lambda kind: F.count_if(F.col("fault") == kind)
    kinds = ("blank", "duplicate", "truncated")
    turns = placed.groupBy("conv_id", "turn").agg(*[count(k).alias(k) for k in kinds])
    faults = turns.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"), *[F.sum(k).alias(k) for k in kinds])
    audits = edited.groupBy("conv_id").agg(
        F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"),
        F.array_join(F.sort_array(F.collect_list(F.struct("block", "letters")))["letters"], "").alias("audit"))
    a = audits.select(F.col("conv_id").alias("c"), "illegal", "cost", "audit")
    return faults.join(a, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")


def repaired_rows(rows: DataFrame, placed: DataFrame, edited: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq (from 0), edit (K, R or I), role, text.

    Texts are shuffled once, by (conv_id, turn, digest): equal rows combine before the
    shuffle, and only the surviving one of them is named by an edit."""
    out = _map(edited.select("conv_id", "first", "classes", "letters", "state", "seq"),
               "conv_id long, seq long, g long, edit string, new_role string", _edited)
    out = materialize(out, "survivors")
    named = out.where("g is not null").join(placed.select("g", "turn", "digest"), "g")
    none = F.lit(None)
    texts = rows.select("conv_id", "turn", _digest(), "role", "text", none.cast("long").alias("seq"), none.cast("string").alias("edit"))
    wanted = named.select("conv_id", "turn", "digest", F.col("new_role").alias("role"), none.cast("string").alias("text"), "seq", "edit")
    both = texts.unionByName(wanted).groupBy("conv_id", "turn", "digest").agg(
        F.max("text").alias("text"), F.max(F.when(F.col("seq").isNull(), F.col("role"))).alias("role"),
        F.max("seq").alias("seq"), F.max("edit").alias("edit"), F.max(F.when(F.col("seq").isNotNull(), F.col("role"))).alias("new_role"))
    kept = both.where("seq is not null").select("conv_id", "seq", "edit", F.coalesce("new_role", "role").alias("role"), "text")
    inserted = out.where("g is null").select("conv_id", "seq", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return kept.unionByName(inserted)


def _hashes(rows: Iterator[tuple]) -> Iterator[tuple]:
    conv, sha = None, None
    for c, role, text in rows:
        if sha is None or c != conv:
            if sha is not None:
                yield conv, sha.hexdigest()
            conv, sha = c, hashlib.sha256()
        else:
            sha.update(b"\n")
        sha.update(f"{role}:{text}".encode())
    if sha is not None:
        yield conv, sha.hexdigest()


def transcript_digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation as ``role:text`` lines (conv_id, repaired_sha256).  A digest is
    sequential: a conversation's rows pass through one task, but as a sorted stream, never held."""
    ordered = repaired.repartition("conv_id").sortWithinPartitions("conv_id", "seq").select("conv_id", "role", "text")
    return _map(ordered, "conv_id long, repaired_sha256 string", _hashes)


def turns_of(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """The columns the operator reads, under their own names; null roles and texts are one space."""
    space = F.lit(" ")
    return df.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
                     F.coalesce(F.make_valid_utf8(F.col(text_col).cast("string")), space).alias("text"))


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The report per conversation and the repaired rows of ``rows`` (conv_id, turn, role, text; see :func:`turns_of`).

    A null conv_id is a conversation of its own; null turns come first and count in no gap; rows of one
    turn are ordered by a digest of role and text; a repeated row is a duplicate; roles other than
    system, user and assistant are read by their first character, and can only be reroled or deleted where that
    is none of s, u and a.  Of an empty table both results are empty.
    """
    prepare(rows.sparkSession)
    placed = place(rows)
    edited = edits(placed)
    return report(placed, edited), repaired_rows(rows, placed, edited)


def repair_digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """The report with ``repaired_sha256`` for every conv_id of ``conversations``, also those without rows
    (zeros, an empty audit, the digest of the empty string)."""
    found, repaired = repair(rows)
    counters = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    empty = {c: F.lit(0).cast("long").alias(c) for c in counters} | {
        "audit": F.lit("").alias("audit"), "repaired_sha256": F.lit("").alias("repaired_sha256")}
    parts = [conversations.select("conv_id").distinct().select("conv_id", *empty.values()),
             found.select("conv_id", *counters, "audit", empty["repaired_sha256"]),
             transcript_digests(repaired).select("conv_id", *[empty[c] for c in (*counters, "audit")], "repaired_sha256")]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    digest = F.max("repaired_sha256")
    return together.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in counters], F.max("audit").alias("audit"),
        F.when(digest == "", hashlib.sha256().hexdigest()).otherwise(digest).alias("repaired_sha256"))
