"""Queue-message queries (M1-M13, S11) over messages derived from ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from basalt.operators import messages as M
from basalt.plans import views as V
from basalt.plans.registry import register

_MS = {"msgs": V.MESSAGES_SQL}
DEFAULT_BUCKET = "raw-default"
KIND_SQL = ("CASE WHEN json_valid(body) AND json_type(body) = 'OBJECT' THEN 'object' "
            "WHEN json_valid(body) THEN 'json' ELSE 'text' END")
# One row per record of a body; a body without records has one row with a NULL record.
RECORDS_SQL = f"""
SELECT message_id, body, body_kind, n_records, i, recs[i + 1] AS rec FROM (
  SELECT *, unnest(range(len(recs))) AS i FROM (
    SELECT message_id, body, body_kind, len(found) AS n_records,
           CASE WHEN len(found) > 0 THEN found ELSE [NULL] END AS recs
    FROM (SELECT message_id, body, {KIND_SQL} AS body_kind,
                 CASE WHEN json_valid(body) THEN json_extract(body, '$.Records[*]') ELSE [] END AS found FROM msgs)))"""
TARGETS_SQL = f"""
SELECT message_id, CAST(message_id AS BIGINT) AS seq, CASE WHEN n_records > 0 THEN CAST(i AS INTEGER) END AS record_no,
       body_kind, CASE WHEN rec_key IS NOT NULL THEN json_extract_string(rec, '$.s3.bucket.name')
                       WHEN key IS NOT NULL THEN '{DEFAULT_BUCKET}' END AS bucket,
       key, key IS NOT NULL AS resolved
FROM (SELECT *, CASE WHEN rec_key IS NOT NULL THEN url_decode(rec_key)
                     WHEN body_kind = 'object' THEN json_extract_string(body, '$.key')
                     WHEN body_kind = 'text' THEN trim(body) END AS key
      FROM (SELECT *, json_extract_string(rec, '$.s3.object.key') AS rec_key FROM ({RECORDS_SQL})))"""


def _msgs(spark, sf_dir):
    return V.messages(V.table(spark, sf_dir, "events"))


def _targets(spark, sf_dir):
    r = M.resolve_target(_msgs(spark, sf_dir), DEFAULT_BUCKET)
    return r.select("message_id", F.col("message_id").cast("bigint").alias("seq"), "record_no", "body_kind", "bucket",
                    "key", "resolved")


@register("message_body_kind", oracle=V.with_views(f"SELECT message_id, {KIND_SQL} AS body_kind FROM msgs", **_MS))
def message_body_kind(spark, sf_dir):
    """M1: JSON object / other JSON / text."""
    return _msgs(spark, sf_dir).select("message_id", M.body_kind("body").alias("body_kind"))


@register("message_targets", oracle=V.with_views(TARGETS_SQL, **_MS))
def message_targets(spark, sf_dir):
    """M2: bucket and key each message points at."""
    return _targets(spark, sf_dir)


@register("message_records", oracle=V.with_views(f"""
SELECT message_id, CAST(n_records AS INTEGER) AS record_count, json_extract_string(rec, '$.s3.bucket.name') AS record_bucket,
       json_extract_string(rec, '$.s3.object.key') AS record_key
FROM ({RECORDS_SQL})""", **_MS))
def message_records(spark, sf_dir):
    """M3: records per message (none, one or several), expanded."""
    return M.records(_msgs(spark, sf_dir)).select("message_id", "record_count", "record_bucket", "record_key")


@register("message_times", oracle=V.with_views("""
SELECT message_id, make_timestamp(CAST(sent_ms AS BIGINT) * 1000) AS sent_ts,
       coalesce(TRY_CAST(receive_count_attr AS INTEGER), 0) AS receive_count FROM msgs""", **_MS))
def message_times(spark, sf_dir):
    """M4/M5: sent time from epoch ms, receive count with default."""
    m = _msgs(spark, sf_dir)
    return m.select("message_id", M.sent_time("sent_ms").alias("sent_ts"),
                    M.receive_count("receive_count_attr").alias("receive_count"))


@register("message_previews", oracle=V.with_views(f"""
SELECT message_id,
       CASE WHEN ({KIND_SQL}) = 'object' THEN array_to_string(json_keys(body)[1:3], ',') END AS key_preview,
       CASE WHEN length(body) > 100 THEN concat(substr(body, 1, 100), '...') ELSE body END AS body_preview,
       substr(message_id, 1, 8) AS short_id
FROM msgs""", **_MS))
def message_previews(spark, sf_dir):
    """Key preview, 100-char body preview, short id."""
    p = M.previews(_msgs(spark, sf_dir))
    return p.select("message_id", F.array_join("key_preview", ",").alias("key_preview"), "body_preview", "short_id")


@register("message_dedupe", oracle=V.with_views("""
SELECT bucket, key, seq, record_no, message_id, body_kind, resolved FROM (
  SELECT *, row_number() OVER (PARTITION BY bucket, key ORDER BY seq, record_no NULLS FIRST) AS rn FROM t WHERE resolved)
WHERE rn = 1""",
    msgs=V.MESSAGES_SQL, t=TARGETS_SQL))
def message_dedupe(spark, sf_dir):
    """M8: one message per (bucket, key), the earliest kept."""
    return M.dedupe_targets(_targets(spark, sf_dir), ["seq", "record_no"])


@register("queue_depth_state", oracle=V.with_views("""
SELECT messages_available, messages_in_flight, messages_delayed,
       CASE WHEN messages_available = 0 AND messages_in_flight = 0 THEN 'EMPTY'
            WHEN messages_available = 0 THEN 'ALL_IN_FLIGHT' ELSE 'BACKLOG' END AS state,
       messages_available - least(messages_available, 10) AS not_shown
FROM (SELECT count(*) FILTER (WHERE status = 'available') AS messages_available,
             count(*) FILTER (WHERE status = 'in_flight') AS messages_in_flight,
             count(*) FILTER (WHERE status = 'delayed') AS messages_delayed FROM msgs)""", **_MS))
def queue_depth_state(spark, sf_dir):
    """Depth by status, state text and messages not shown by a 10-message peek."""
    d = M.queue_depth(_msgs(spark, sf_dir))
    return d.select("*", M.queue_state().alias("state"),
                    M.shown_of_total(F.col("messages_available"), 10).alias("not_shown"))


@register("queue_attributes", oracle=V.with_views("""
SELECT CAST(messages_available AS INTEGER) AS messages_available, CAST(messages_in_flight AS INTEGER) AS messages_in_flight,
       CAST(messages_delayed AS INTEGER) AS messages_delayed, 30 AS visibility_timeout, 0 AS message_retention_period,
       '1704067200' AS created_timestamp, NULL::VARCHAR AS last_modified_timestamp, '5' AS max_receive_count
FROM (SELECT count(*) FILTER (WHERE status = 'available') AS messages_available,
             count(*) FILTER (WHERE status = 'in_flight') AS messages_in_flight,
             count(*) FILTER (WHERE status = 'delayed') AS messages_delayed FROM msgs)""", **_MS))
def queue_attributes(spark, sf_dir):
    """M9: attribute map (built from the queue depth) -> typed row with defaults."""
    d = M.queue_depth(_msgs(spark, sf_dir))
    attrs = d.select(F.create_map(
        F.lit("ApproximateNumberOfMessages"), F.col("messages_available").cast("string"),
        F.lit("ApproximateNumberOfMessagesNotVisible"), F.col("messages_in_flight").cast("string"),
        F.lit("ApproximateNumberOfMessagesDelayed"), F.col("messages_delayed").cast("string"),
        F.lit("VisibilityTimeout"), F.lit("30"),
        F.lit("MessageRetentionPeriod"), F.lit("not-a-number"),
        F.lit("CreatedTimestamp"), F.lit("1704067200"),
        F.lit("RedrivePolicy"), F.lit('{"deadLetterTargetArn":"dlq","maxReceiveCount":"5"}'),
    ).alias("attributes"))
    return M.queue_attributes(attrs)


@register("message_peek", oracle=V.with_views("""
SELECT message_id, body, status FROM msgs ORDER BY CAST(message_id AS BIGINT) LIMIT 10""", **_MS))
def message_peek(spark, sf_dir):
    """A bounded peek at 10 messages in queue order."""
    m = _msgs(spark, sf_dir).withColumn("seq", F.col("message_id").cast("bigint"))
    return M.peek(m, 10, ["seq"]).select("message_id", "body", "status")
