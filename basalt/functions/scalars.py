"""Column -> Column helpers used across the manifest, message and log operators.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen; none needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's output -----------------------
# File type labels by suffix, checked in this order; anything else is OTRO.
TYPE_LABELS = [
    (".parquet", "PARQUET"),
    (".json", "JSON"),
    (".jsonl", "JSONL"),
    (".csv", "CSV"),
    (".txt", "TXT"),
    (".metadata", "METADATA"),
]
OTHER_TYPE_LABEL = "OTRO"
# Extension used when a key has no dot.
NO_EXTENSION = "sin_ext"
# Suffixes the readers accept, and the ones a viewer can open as a table.
SUPPORTED_SUFFIXES = ["parquet", "json", "jsonl", "csv", "txt", "metadata"]
READABLE_SUFFIXES = ["parquet", "json", "jsonl", "csv"]
# Units of the long human size form (one decimal, a space, unit).
SIZE_UNITS_LONG = ["B", "KB", "MB", "GB"]
SIZE_UNIT_LAST = "TB"
# ---------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(key) -> Column:
    """Last path element: ``a/b/c.json`` -> ``c.json``."""
    return F.substring_index(_c(key), "/", -1)


def extension(key) -> Column:
    """Lower-case text after the last dot of the key, ``sin_ext`` without a dot."""
    k = _c(key)
    return F.when(k.contains("."), F.lower(F.substring_index(k, ".", -1))).otherwise(F.lit(NO_EXTENSION))


def type_label(key) -> Column:
    """PARQUET / JSON / JSONL / CSV / TXT / METADATA / OTRO by suffix."""
    k = _c(key)
    expr = None
    for suffix, label in TYPE_LABELS:
        expr = (F.when(k.endswith(suffix), F.lit(label)) if expr is None
                else expr.when(k.endswith(suffix), F.lit(label)))
    return expr.otherwise(F.lit(OTHER_TYPE_LABEL))


def _one_decimal(x: Column) -> Column:
    # Python's "%.1f" rounds ties to even on the exact binary value; bround does
    # the same for the binary-exact fractions that byte counts produce, and
    # formatting the already-rounded value keeps Java's half-up out of the way.
    return F.format_string("%.1f", F.bround(x, 1))


def human_size(size) -> Column:
    """``0 B``, ``512.0 B``, ``1.5 KB`` .. ``2.0 TB``: one decimal and a space."""
    s = _c(size).cast("double")
    expr = F.when(s == 0, F.lit("0 B"))
    for i, unit in enumerate(SIZE_UNITS_LONG):
        scaled = s / F.lit(float(1024 ** i))
        expr = expr.when(scaled < 1024, F.concat(_one_decimal(scaled), F.lit(" " + unit)))
    return expr.otherwise(F.concat(_one_decimal(s / F.lit(float(1024 ** 4))), F.lit(" " + SIZE_UNIT_LAST)))


def human_size_short(size) -> Column:
    """``512B``, ``1.5KB``, ``3.2MB``: short form without a space."""
    s = _c(size)
    return (F.when(s < 1024, F.concat(s.cast("bigint").cast("string"), F.lit("B")))
            .when(s < 1024 * 1024, F.concat(_one_decimal(s / F.lit(1024.0)), F.lit("KB")))
            .otherwise(F.concat(_one_decimal(s / F.lit(1048576.0)), F.lit("MB"))))


def size_mb(size, digits: int = 2) -> Column:
    """Bytes as megabytes rounded to ``digits``."""
    return F.round(_c(size) / F.lit(1048576.0), digits)


def timestamp_text(ts, minutes_only: bool = False) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` or ``yyyy-MM-dd HH:mm``."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm" if minutes_only else "yyyy-MM-dd HH:mm:ss")


def truncate_head(text, width: int) -> Column:
    """Keep the head: longer than ``width - 1`` -> first ``width - 4`` chars + ``...``."""
    t = _c(text)
    return F.when(F.length(t) > width - 1, F.concat(F.substring(t, 1, width - 4), F.lit("..."))).otherwise(t)


def truncate_tail(text, width: int) -> Column:
    """Keep the tail: ``...`` + last ``width - 4`` chars; narrow columns cut the head."""
    t = _c(text)
    if width > 10:
        cut = F.concat(F.lit("..."), F.substring(t, -(width - 4), width - 4))
    else:
        cut = F.substring(t, 1, width - 1)
    return F.when(F.length(t) > width - 1, cut).otherwise(t)


def text_preview(text, n: int = 100) -> Column:
    """First ``n`` characters and ``...`` when longer (M7)."""
    t = _c(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def short_id(text, n: int = 8) -> Column:
    """First ``n`` characters of an id."""
    return F.substring(_c(text), 1, n)


def json_key_preview(body, n: int = 3) -> Column:
    """First ``n`` top-level keys of a JSON object body; NULL for non-objects (M6)."""
    return F.slice(F.json_object_keys(_c(body)), 1, n)


def supported(ext) -> Column:
    """Suffix is one the readers accept."""
    return _c(ext).isin(*SUPPORTED_SUFFIXES)


def readable(ext) -> Column:
    """Suffix can be opened as a table."""
    return _c(ext).isin(*READABLE_SUFFIXES)
