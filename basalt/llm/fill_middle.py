"""Fill-in-the-middle transformation of whole texts by an Arrow compute pipeline.

A text is cut into units (runs of ASCII letters, or one other code point).  Per
slice of a batch the units become a list array, which is flattened with the
index of its parent; ordinals inside the parent give each unit its role (prefix,
middle or suffix); the units of each role are filtered out, rebuilt into lists
and joined, and the pieces are joined with the sentinels.  Nothing is shuffled:
one row in, one row out.

The cuts and the form of a document follow from a hash of its id alone, so
reruns, other partitionings and lost executors give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import prepare, text_of

SENTINELS = ("<P>", "<S>", "<M>")
#: One unit of UTF-8 text: ASCII letters, another ASCII character, or a longer code point.
UNIT = rb"[A-Za-z]+|[\x00-@\[-`{-\x7f]|[\xc2-\xf4][\x80-\xbf]+"
#: A byte that no UTF-8 text holds; it ends each unit.
END = b"\xff"
#: Text bytes handled at once (a single longer text is a slice of its own).
SLICE_BYTES = 2 << 20

OUT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of at most SLICE_BYTES of text, one row at least."""
    start = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        if i > start and size + n > SLICE_BYTES:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def split_units(texts: pa.Array) -> pa.ListArray:
    """The units of each text (binary) as a list, with one empty unit at its end."""
    return pc.split_pattern(pc.replace_substring_regex(texts, UNIT, b"\\0" + END), END)


def pieces(units: pa.ListArray, first_cut, second_cut) -> list[pa.Array]:
    """Prefix, middle and suffix of each list of units, cut after so many units."""
    import numpy as np

    flat, parent = units.flatten(), pc.list_parent_indices(units)
    lengths = pc.list_value_length(units).to_numpy().astype(np.int64)
    starts = np.cumsum(lengths) - lengths
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pa.array(starts).take(parent))
    in_prefix = pc.less(ordinal, pa.array(first_cut).take(parent))
    before_suffix = pc.less(ordinal, pa.array(second_cut).take(parent))
    roles = [(in_prefix, first_cut), (pc.and_not(before_suffix, in_prefix), second_cut - first_cut),
             (pc.invert(before_suffix), lengths - second_cut)]
    out = []
    for mask, count in roles:
        offsets = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        out.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), flat.filter(mask)), b""))
    return out


def _transform(ids: pa.Array, texts: pa.Array, hashes: list, sentinels, fim_percent: int, spm_percent: int) -> pa.RecordBatch:
    import numpy as np

    raw = texts.cast(pa.binary())
    units = split_units(raw)
    n = pc.list_value_length(units).to_numpy().astype(np.int64) - 1
    h1, h2, h3, h4 = hashes
    one, two = h1 % (n + 1), h2 % (n + 1)
    prefix, middle, suffix = pieces(units, np.minimum(one, two), np.maximum(one, two))
    plain = pc.or_(pc.equal(pc.binary_length(raw), 0), pa.array(h3 % 100 >= fim_percent))
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(texts, s))
    p, s, m = (pa.scalar(x.encode()) for x in sentinels)
    psm = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, pa.scalar(b""))
    spm = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, pa.scalar(b""))
    as_spm = pa.array(h4 % 100 < spm_percent)
    output = pc.if_else(plain, raw, pc.if_else(as_spm, spm, psm))
    none = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, none, pc.utf8_length(x.cast(pa.string())).cast(pa.int64())) for x in (prefix, middle)]
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(n), pc.if_else(plain, "plain", pc.if_else(as_spm, "spm", "psm")), *chars, output.cast(pa.string())],
        names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   fim_percent: int = 90, spm_percent: int = 20, sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """Rearrange every whole text: rows (doc_id, n, form, prefix_chars, middle_chars, output).

    ``h1`` to ``h4`` are the first 32-bit groups of the SHA-256 of ``seed:id``.  The
    prefix ends after the smaller of ``h1 % (n + 1)`` and ``h2 % (n + 1)`` units, the
    middle after the larger.  ``form`` is ``plain`` (the text as it is) for empty texts, texts
    that hold a sentinel and ``h3 % 100 >= fim_percent``; else ``spm`` if
    ``h4 % 100 < spm_percent``, else ``psm``.

    Null texts are empty (n = 0, plain); a null id hashes as the empty string; malformed
    UTF-8 is read with replacement characters; rows that repeat an id get the same
    draws; very long texts are handled alone; other columns are not read.  An empty
    table gives no rows.
    """
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _slices(batch.column(1)):
                part = batch.slice(a, b - a)
                hashes = [part.column(i).to_numpy() for i in range(2, 6)]
                yield _transform(part.column(0), part.column(1).cast(pa.string()), hashes, sentinels, fim_percent, spm_percent)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.make_valid_utf8(text_of(text_col)).alias("t"),
                     digest.alias("d"))
    draws = [F.conv(F.substring("d", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    return rows.select("doc_id", "t", *draws).mapInArrow(run, OUT_SCHEMA)


def restore(output: Column | str = "output", form: Column | str = "form",
            sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that a transformed output was made of: exact, since a transformed text holds no sentinel."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "|".join(rf"\Q{s}\E" for s in sentinels), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
