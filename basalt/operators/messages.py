"""File-notification messages.

A message is ``(message_id, body, ...)`` with a JSON or plain-text body.  All
decoding is built-in JSON functions (``from_json``, ``get_json_object``,
``json_object_keys``, ``try_parse_json``), evaluated per row in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basalt.functions.scalars import json_key_preview, short_id, text_preview

RECORDS_SCHEMA = T.StructType([T.StructField("Records", T.ArrayType(T.StructType([
    T.StructField("s3", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType())])),
    ])),
])))])

# Queue attribute names and their typed columns (fixed values).
ATTRIBUTE_COLUMNS = [
    ("ApproximateNumberOfMessages", "messages_available", "int"),
    ("ApproximateNumberOfMessagesNotVisible", "messages_in_flight", "int"),
    ("ApproximateNumberOfMessagesDelayed", "messages_delayed", "int"),
    ("VisibilityTimeout", "visibility_timeout", "int"),
    ("MessageRetentionPeriod", "message_retention_period", "int"),
    ("CreatedTimestamp", "created_timestamp", "string"),
    ("LastModifiedTimestamp", "last_modified_timestamp", "string"),
]


# JSON grammar pieces (fixed values): white space, and a whole-body scalar
# (string, number, true, false, null) with nothing after it.
_WS = r"[ \t\n\r]*"
_JSON_SCALAR = (r'^' + _WS + r'(?:"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"'
                r'|-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false|null)' + _WS + r'$')


def body_kind(body="body") -> Column:
    """M1: ``object`` (JSON object), ``json`` (other JSON value) or ``text``.

    Spark's JSON functions stop after the first complete value, so ``true
    story`` or ``{"k": 1} x`` would pass as JSON.  A body is therefore JSON only
    when it is a whole scalar (checked by the grammar alone, no parse) or when
    it starts with ``{`` / ``[``, ends with the matching bracket and is the only
    value inside an array and inside an object put around it: whatever follows
    the first value (``{"k": 1}}``, ``{}{}``, ``{}]}``) breaks one of the two.
    The bracket test skips the parses for most text bodies."""
    b = F.col(body) if isinstance(body, str) else body
    lead = F.regexp_extract(b, "^" + _WS + "(.)", 1)
    last = F.regexp_extract(b, "(.)" + _WS + "$", 1)
    whole = ((F.json_array_length(F.concat(F.lit("["), b, F.lit("]"))) == 1)
             & F.json_object_keys(F.concat(F.lit('{"v":'), b, F.lit("}"))).isNotNull())
    is_object = (lead == "{") & (last == "}") & F.json_object_keys(b).isNotNull() & whole
    is_array = (lead == "[") & (last == "]") & F.try_parse_json(b).isNotNull() & whole
    return (F.when(is_object, F.lit("object"))
            .when(is_array | b.rlike(_JSON_SCALAR), F.lit("json"))
            .otherwise(F.lit("text")))


def resolve_target(messages: DataFrame, default_bucket: str, body: str = "body") -> DataFrame:
    """M2: bucket and key of every file a message points at, one row per target.

    Each of ``Records[].s3`` is a target of its own (key URL-decoded, D18;
    ``record_no`` counts from 0).  Without records, a JSON object with a ``key``
    field uses it with the default bucket, and a text body is the key itself
    (trimmed).  Other JSON leaves the key NULL, and ``resolved`` false routes
    the message to quarantine (D22).

    The body is parsed once.  The parse results come out of an ``inline``
    generator: a later filter on ``resolved`` stops above it, where a plain
    projection would let Catalyst copy every JSON parse into the pushed-down
    filter.  The records array is only built for bodies that name one.
    """
    b = F.col(body)
    kind = body_kind(b)
    recs = F.when(b.contains('"Records"') & (kind == "object"), F.from_json(b, RECORDS_SCHEMA)["Records"])
    parts = F.struct(kind.alias("body_kind"), F.get_json_object(b, "$.key").alias("_obj_key"), recs.alias("_records"))
    parsed = messages.select("*", F.inline(F.array(parts)))
    each = parsed.select("*", F.posexplode_outer("_records").alias("record_no", "_rec"))
    rec_key = F.try_url_decode(F.col("_rec.s3.object.key"))
    kind = F.col("body_kind")
    key = (F.when(rec_key.isNotNull(), rec_key).when(kind == "object", F.col("_obj_key"))
           .when(kind == "text", F.trim(b)))
    bucket = F.when(rec_key.isNotNull(), F.col("_rec.s3.bucket.name")).when(key.isNotNull(), F.lit(default_bucket))
    out = each.select("*", bucket.alias("bucket"), key.alias("key"))
    return out.withColumn("resolved", F.col("key").isNotNull()).drop("_records", "_rec", "_obj_key")


def records(messages: DataFrame, body: str = "body") -> DataFrame:
    """M3: number of ``Records`` per message and one row per record (NULL when none)."""
    rec = F.from_json(F.col(body), RECORDS_SCHEMA)["Records"]
    out = messages.select("*", F.coalesce(F.size(rec), F.lit(0)).cast("int").alias("record_count"),
                          F.explode_outer(rec).alias("record"))
    return out.select(*[c for c in out.columns if c != "record"],
                      F.col("record.s3.bucket.name").alias("record_bucket"),
                      F.col("record.s3.object.key").alias("record_key"))


def sent_time(ms="sent_ms") -> Column:
    """M4: epoch-millisecond text -> timestamp; NULL when absent or not a number."""
    c = F.col(ms) if isinstance(ms, str) else ms
    return F.timestamp_millis(c.try_cast("bigint")).cast("timestamp_ntz")


def receive_count(attr="receive_count_attr") -> Column:
    """M5: receive count, 0 when absent."""
    c = F.col(attr) if isinstance(attr, str) else attr
    return F.coalesce(c.try_cast("int"), F.lit(0))


def previews(messages: DataFrame, body: str = "body", n_keys: int = 3, n_chars: int = 100) -> DataFrame:
    """First keys of JSON bodies, text preview, short id."""
    return messages.select("*", F.when(body_kind(body) == "object", json_key_preview(body, n_keys)).alias("key_preview"),
                           text_preview(body, n_chars).alias("body_preview"),
                           short_id("message_id").alias("short_id"))


def dedupe_targets(resolved: DataFrame, order: list[str]) -> DataFrame:
    """M8: one message per resolved (bucket, key), the first in ``order``; a
    ``min(struct)`` aggregate with a map-side partial step (skew-safe).

    Unresolved messages fall into the NULL key group, which is dropped after
    the aggregate; a filter before it would be pushed into the scan and parse
    every body a second time."""
    rest = [c for c in resolved.columns if c not in ("bucket", "key") and c not in order]
    agg = (resolved.groupBy("bucket", "key")
           .agg(F.min(F.struct(*order, *rest)).alias("m"), F.max(F.col("key").isNotNull()).alias("_ok")))
    return agg.where("_ok").select("bucket", "key", "m.*")


def queue_attributes(attrs: DataFrame, attr_col: str = "attributes") -> DataFrame:
    """M9: attribute map -> typed columns with defaults (0 / NULL); the
    ``RedrivePolicy`` JSON text gives ``max_receive_count`` (D17)."""
    a = F.col(attr_col)
    cols = []
    for name, alias, t in ATTRIBUTE_COLUMNS:
        v = F.try_element_at(a, F.lit(name))
        cols.append((F.coalesce(v.try_cast(t), F.lit(0)) if t == "int" else v).alias(alias))
    cols.append(F.get_json_object(F.try_element_at(a, F.lit("RedrivePolicy")), "$.maxReceiveCount")
                .alias("max_receive_count"))
    return attrs.select(*cols)


def queue_depth(messages: DataFrame, status: str = "status") -> DataFrame:
    """Available / in flight / delayed message counts."""
    s = F.col(status)
    return messages.agg(F.count_if(s == "available").alias("messages_available"),
                        F.count_if(s == "in_flight").alias("messages_in_flight"),
                        F.count_if(s == "delayed").alias("messages_delayed"))


def queue_state(available="messages_available", in_flight="messages_in_flight") -> Column:
    """EMPTY, ALL_IN_FLIGHT or BACKLOG."""
    a, f = F.col(available), F.col(in_flight)
    return (F.when((a == 0) & (f == 0), F.lit("EMPTY")).when(a == 0, F.lit("ALL_IN_FLIGHT"))
            .otherwise(F.lit("BACKLOG")))


def shown_of_total(total: Column, shown: int) -> Column:
    """Messages not shown when ``shown`` are listed."""
    return total - F.least(total, F.lit(shown))


def peek(messages: DataFrame, n: int = 10, order: list[str] | None = None) -> DataFrame:
    """A bounded peek at ``n`` messages (by ``order`` when given)."""
    return (messages.orderBy(*order) if order else messages).limit(n)
