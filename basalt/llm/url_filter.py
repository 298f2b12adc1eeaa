"""URL filters as a temporal list join.

A list is a log of dated entries: from ``listed_at`` on, a key (a URL prefix, a
host, or a domain with its subdomains) is blocked, or allowed again.  Entries
become validity intervals; an as-of join evaluates every capture against the
entries active when it was fetched, and the most specific active entry decides.

Intervals are cut into time buckets, so the as-of join is an equi-join on (kind,
key, bucket) with a range condition that at most one interval meets: it never
multiplies rows, and AQE splits a hot key.  The end of an interval is found
inside its bucket first and from the first entry of the next bucket otherwise,
so no task holds the whole history of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_SECONDS = 30 * 86_400
#: Specificity of the kinds of key; longer prefixes and domains are more specific than shorter ones.
KINDS = {"prefix": 200, "host": 190, "domain": 0}
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and trailing dot; empty if there is none."""
    authority = F.regexp_extract(url, _AUTHORITY, 1)
    return F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r"\.?(:[0-9]*)?$", ""))


def prefix_of(url: Column) -> Column:
    """Host and first path segment, the shortest key of a prefix entry."""
    return F.concat_ws("/", host_of(url), F.split_part(F.regexp_extract(url, _PATH, 1), F.lit("/"), F.lit(2)))


def _prefixes(url: Column, host: Column, depth: int) -> Column:
    """Keys of the prefix entries that cover ``url``, as far as ``depth`` slashes: the host
    with each number of whole path segments, with and without a slash after them."""
    if depth <= 1:
        return F.array(prefix_of(url))
    parts = F.split(F.regexp_extract(url, _PATH, 1), "/")
    n = F.least(F.greatest(F.size(parts) - 1, F.lit(1)), F.lit(depth))
    whole = F.transform(F.sequence(F.lit(1), n),
                        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, F.lit(2), i), "/")))
    return F.array_union(whole, F.transform(F.slice(whole, F.lit(1), n - 1), lambda p: F.concat(p, F.lit("/"))))


def intervals(entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """Entries (kind, key, listed_at, action, category, entry_id) with ``valid_to``.

    ``listed_at`` is in epoch seconds.  An entry holds until the next one for its
    key (open: null).  Of entries with the same time the largest entry_id holds.
    Entries without key or time are left out.
    """
    entries = (entries.where("key is not null and key <> '' and listed_at is not null")
               .withColumn("bucket", F.floor(F.col("listed_at") / bucket_seconds)))
    inside = Window.partitionBy("kind", "key", "bucket").orderBy("listed_at", F.col("entry_id").asc_nulls_first())
    firsts = entries.groupBy("kind", "key", "bucket").agg(F.min("listed_at").alias("first"))
    over = Window.partitionBy("kind", "key").orderBy("bucket")
    firsts = firsts.select("kind", "key", "bucket", F.lead("first").over(over).alias("next_first"))
    return (entries.withColumn("next", F.lead("listed_at").over(inside)).join(firsts, ["kind", "key", "bucket"])
            .withColumn("valid_to", F.coalesce("next", "next_first")).where("valid_to is null or valid_to > listed_at")
            .select("kind", "key", "listed_at", "valid_to", "action", "category", "entry_id"))


def _domains(host: Column) -> Column:
    """The host and its parent domains of at least two labels."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def filter_urls(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                time_col: str = "fetched_at", bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """One row per capture: page_id, url, fetched_at, host, allowed, kind, key, category, listed_at.

    ``fetched_at`` is in epoch seconds.  A capture is refused when the most
    specific entry active at its time blocks it (the longest prefix, then host, then
    the longest domain).  A prefix key is a host and whole path segments of any
    number (``host/a/b``); it covers the path that they name and all below it, with
    a slash at its end (``host/a/``) only what is below; one that ends inside a
    segment does not cover that segment; ``host/`` covers an empty
    first segment.  Kind, key, category and listed_at name that entry, null if
    none is active.  Captures without URL, host or time match nothing and are
    allowed.  Captures repeated in all three columns are reported once.
    """
    rows = captures.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                           F.col(time_col).cast("long").alias("fetched_at")).distinct()
    rows = rows.withColumn("host", F.nullif(host_of(F.col("url")), F.lit("")))
    deepest = entries.where("kind = 'prefix'").agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0] or 1
    keys = F.concat(
        F.transform(_prefixes(F.col("url"), F.col("host"), deepest),
                    lambda p: F.struct(F.lit("prefix").alias("kind"), p.alias("key"))),
        F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("key"))),
        F.transform(_domains(F.col("host")), lambda d: F.struct(F.lit("domain").alias("kind"), d.alias("key"))))
    asked = (rows.where("host is not null and fetched_at is not null")
             .select("page_id", "url", "fetched_at", F.explode(keys).alias("k"))
             .select("page_id", "url", "fetched_at", "k.kind", "k.key",
                     F.floor(F.col("fetched_at") / bucket_seconds).alias("bucket")))
    period = rows.agg(F.floor(F.min("fetched_at") / bucket_seconds).alias("low"),
                      F.floor(F.max("fetched_at") / bucket_seconds).alias("high")).first()
    low, high = (0, -1) if period["low"] is None else (period["low"], period["high"])
    spans = intervals(entries, bucket_seconds)
    first = F.greatest(F.floor(F.col("listed_at") / bucket_seconds), F.lit(low))
    last = F.least(F.floor((F.coalesce("valid_to", F.lit((high + 1) * bucket_seconds)) - 1) / bucket_seconds), F.lit(high))
    pieces = (spans.withColumn("first", first).withColumn("last", last).where("first <= last")
              .withColumn("bucket", F.explode(F.sequence("first", "last"))).drop("first", "last"))
    active = (asked.join(pieces, ["kind", "key", "bucket"])
              .where("listed_at <= fetched_at and (valid_to is null or fetched_at < valid_to)"))
    rank = F.when(F.col("kind") == "prefix", KINDS["prefix"] + F.length("key")).when(F.col("kind") == "host", KINDS["host"]) \
        .otherwise(KINDS["domain"] + F.size(F.split("key", r"\.")))
    best = (active.groupBy("page_id", "url", "fetched_at")
            .agg(F.max(F.struct(rank.alias("rank"), "kind", "key", "action", "category", "listed_at")).alias("e"))
            .select(F.col("page_id").alias("p"), F.col("url").alias("u"), F.col("fetched_at").alias("f"), "e"))
    joined = rows.join(best, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("url") == F.col("u"))
                       & (F.col("fetched_at") == F.col("f")), "left")
    return joined.select("page_id", "url", "fetched_at", "host",
                         (F.coalesce(F.col("e.action"), F.lit("allow")) != "block").alias("allowed"),
                         F.col("e.kind").alias("kind"), F.col("e.key").alias("key"), F.col("e.category").alias("category"),
                         F.col("e.listed_at").alias("listed_at"))
