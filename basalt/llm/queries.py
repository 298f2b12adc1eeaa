"""The operators bound to the given tables: ``QUERIES`` and, where SQL can express them, ``ORACLE``.

Vocabulary files come from the installed ``public_tokenizers`` package.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm import (
    bpe, conversation_repair, embedding_dedup, exact_dedup, fill_middle, license_scan, minhash_dedup, mixing, quality, suffix_dedup,
    token_output, url_filter, warc,
)
from basalt.llm.common import table
from basalt.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


#: Crawl period of the derived captures (2024) and lead of the derived list, in epoch seconds.
_YEAR_START, _YEAR, _LEAD = 1_704_067_200, 31_536_000, 15_768_000


def captures_and_list(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Dated captures and list entries derived from ``pages``: every page is fetched once
    and reports one entry, whose kind follows from its URL and whose dates and action
    follow from a hash of its id."""
    def drawn(purpose: str, modulo: int):
        text = F.concat(F.col("page_id").cast("string"), F.lit(f"/{purpose}"))
        return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long") % modulo

    host = url_filter.host_of(F.col("url"))
    kind = F.when(F.contains("url", F.lit("?")), "prefix").when(host.rlike(r"^(www|m|blog)[.]"), "domain").otherwise("host")
    key = (F.when(F.col("kind") == "prefix", url_filter.prefix_of(F.col("url")))
           .when(F.col("kind") == "domain", F.regexp_replace(host, r"^(www|m|blog)[.]", "")).otherwise(host))
    captures = pages.select("page_id", "url", (drawn("fetch", _YEAR) + _YEAR_START).alias("fetched_at"))
    entries = pages.select(
        kind.alias("kind"), "url", F.col("page_id").alias("entry_id"),
        (drawn("list", _YEAR + _LEAD) + (_YEAR_START - _LEAD)).alias("listed_at"),
        F.when(drawn("action", 2) == 0, "block").otherwise("allow").alias("action"),
        F.when(F.contains(host, F.lit("spam")), "spam").when(F.contains(host, F.lit("pills")), "pharmacy")
        .otherwise("report").alias("category")).withColumn("key", key).drop("url")
    return captures, entries


@query("op1_url_filter", oracle=r"""
    WITH p AS (
      SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1),
                                          '^.*@', ''), '\.?(:[0-9]*)?$', '') AS h0,
             split_part(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/', 2) AS seg,
             ('0x' || substr(md5(page_id || '/fetch'), 1, 7))::BIGINT % 31536000 + 1704067200 AS fetched_at,
             ('0x' || substr(md5(page_id || '/list'), 1, 7))::BIGINT % 47304000 + 1688299200 AS listed_at,
             ('0x' || substr(md5(page_id || '/action'), 1, 7))::BIGINT % 2 AS act
      FROM pages),
    c AS (SELECT *, nullif(lower(h0), '') AS host FROM p),
    e AS (
      SELECT page_id AS entry_id, listed_at, CASE WHEN act = 0 THEN 'block' ELSE 'allow' END AS action,
             CASE WHEN contains(host, 'spam') THEN 'spam' WHEN contains(host, 'pills') THEN 'pharmacy'
                  ELSE 'report' END AS category,
             CASE WHEN contains(url, '?') THEN 'prefix' WHEN regexp_matches(host, '^(www|m|blog)[.]') THEN 'domain'
                  ELSE 'host' END AS kind,
             CASE WHEN contains(url, '?') THEN host || '/' || seg
                  ELSE regexp_replace(host, CASE WHEN regexp_matches(host, '^(www|m|blog)[.]') THEN '^(www|m|blog)[.]'
                                                 ELSE '^$' END, '') END AS key
      FROM c),
    v AS (
      SELECT *, lead(listed_at) OVER (PARTITION BY kind, key ORDER BY listed_at, entry_id) AS valid_to
      FROM e WHERE key IS NOT NULL AND key <> ''),
    k AS (
      SELECT page_id, 'prefix' AS kind, host || '/' || seg AS key FROM c
      UNION SELECT page_id, 'host', host FROM c
      UNION SELECT page_id, 'domain', array_to_string(list_slice(string_split(host, '.'), i, 1000), '.')
      FROM (SELECT page_id, host, unnest(range(1, greatest(len(string_split(host, '.')), 2))) AS i FROM c)),
    best AS (
      SELECT c.page_id, arg_max({'kind': v.kind, 'key': v.key, 'action': v.action, 'category': v.category,
                                 'listed_at': v.listed_at},
                                CASE v.kind WHEN 'prefix' THEN 200 WHEN 'host' THEN 190
                                     ELSE len(string_split(v.key, '.')) END) AS e
      FROM c JOIN k USING (page_id) JOIN v ON v.kind = k.kind AND v.key = k.key
       AND v.listed_at <= c.fetched_at AND (v.valid_to IS NULL OR c.fetched_at < v.valid_to)
      GROUP BY c.page_id)
    SELECT c.page_id, c.url, c.fetched_at, c.host, coalesce(e.action, 'allow') <> 'block' AS allowed,
           e.kind AS kind, e.key AS key, e.category AS category, e.listed_at AS listed_at
    FROM c LEFT JOIN best USING (page_id)""")
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(*captures_and_list(table(spark, sf_dir, "pages")))


def _license_oracle() -> str:
    """Every window against every template, by the exact containment."""
    rows = ", ".join(f"('{n}', '{' '.join(license_scan.template_words(t))}')" for n, t in sorted(license_scan.TEMPLATES.items()))
    longest = max(len(license_scan.template_words(t)) for t in license_scan.TEMPLATES.values())
    sizes = license_scan.classes_for(longest)
    bounds = ", ".join(f"({low}, {size})" for low, size in zip((0, *sizes[:-1]), sizes, strict=True))
    k = license_scan.SHINGLE
    later = ", ".join(f"w[{i}:]" for i in range(2, k + 1))
    phrases = f"[concat_ws(' ', {', '.join(f'x[{i}]' for i in range(1, k + 1))}) FOR x IN list_zip(w, {later}, true)]"
    return rf"""
    WITH notices(license, body) AS (VALUES {rows}),
    classes(low, size) AS (VALUES {bounds}),
    n AS (
      SELECT license, size, list_distinct({phrases}) AS phrases
      FROM (SELECT license, string_split(body, ' ') AS w FROM notices) JOIN classes ON len(w) > low AND len(w) <= size),
    t AS (SELECT license, size, len(phrases) AS n_phrases, unnest(phrases) AS phrase FROM n),
    d AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{license_scan._UPPER}', '{license_scan._LOWER}'),
                                        '[a-z0-9]+') AS w
      FROM documents),
    p AS (SELECT doc_id, unnest({phrases}) AS phrase, unnest(range(0, len(w) - {k - 1})) AS place FROM d),
    h AS (
      SELECT doc_id, license, size, n_phrases, phrase, place, unnest([place // size, place // size - 1]) * size AS first_word
      FROM p JOIN t USING (phrase)),
    m AS (
      SELECT doc_id, license, first_word, count(DISTINCT phrase)::DOUBLE / n_phrases AS share
      FROM h WHERE first_word >= 0 AND place <= first_word + 2 * size - {k} GROUP BY doc_id, license, first_word, n_phrases)
    SELECT doc_id, license, max(share) AS containment, min(first_word)::INTEGER AS first_word, count(*) AS n_windows
    FROM m WHERE share >= {license_scan.CONTAINMENT} GROUP BY ALL"""


@query("op2_license_scan", oracle=_license_oracle())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_suffix_dedup")
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep="none", with_text=False)


@query("op4_exact_dedup", oracle="""
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""")
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query("op5_byte_bpe")
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, with_ids=False)


@query("op6_source_mixing", oracle=r"""
    WITH d AS (
      SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
             md5('mix-1/' || coalesce(doc_id::VARCHAR, 'null')) AS rnk
      FROM documents),
    s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
      FROM d GROUP BY source),
    r AS (
      SELECT *, 3.0 * source_size / w AS full_at,
             (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER p, 0))::DOUBLE AS rest,
             (sum(w) OVER () - coalesce(sum(w) OVER p, 0))::DOUBLE AS rest_w
      FROM s WINDOW p AS (ORDER BY 3.0 * source_size / w, source NULLS LAST
                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (
      SELECT arg_min(rest, (full_at, source)) AS rest, arg_min(rest_w, (full_at, source)) AS rest_w,
             min(full_at) AS full_at
      FROM r WHERE full_at >= rest / rest_w),
    t AS (
      SELECT r.source, r.source_size,
             CASE WHEN r.full_at >= level.full_at THEN level.rest * r.w / level.rest_w
                  ELSE 3.0::DOUBLE * r.source_size END AS target
      FROM r, level),
    x AS (
      SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS whole,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.rnk, d.size, d.doc_id
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (whole * size + least(size, greatest(floor(target)::BIGINT - whole * source_size - before, 0)))::BIGINT
             AS taken
    FROM x""")
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("copies")


@query("op10_token_output")
def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "tokens")
    token_output.write_tokens(table(spark, sf_dir, "documents"), out, public_tokenizers.path("byte_bpe_50k.json"))
    return token_output.token_digests(spark, out)


@query("op7_minhash_dedup")
def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_dedup(table(spark, sf_dir, "documents"), shingle_words=2, percent=80)


@query("op9_embedding_dedup")
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_dedup(table(spark, sf_dir, "embeddings"))


@query("op11_fill_middle", oracle=r"""
    WITH d AS (
      SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
    u AS (SELECT *, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS units FROM d),
    c AS (
      SELECT doc_id, t, units, len(units)::BIGINT AS n,
             ('0x' || substr(h, 1, 8))::BIGINT % (len(units) + 1) AS c1,
             ('0x' || substr(h, 9, 8))::BIGINT % (len(units) + 1) AS c2,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                    OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 THEN 'plain'
                  WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
      FROM u),
    p AS (
      SELECT *, array_to_string(units[:least(c1, c2)], '') AS pre,
             array_to_string(units[least(c1, c2) + 1:greatest(c1, c2)], '') AS mid,
             array_to_string(units[greatest(c1, c2) + 1:], '') AS suf
      FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                            ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(t) AS restored_sha256
    FROM p""")
def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(fill_middle.restore().cast("binary"), 256).alias("restored_sha256"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, drawn by a hash of conv_id and turn (nulls: one space): a row in
    twenty each is dropped, emptied, stripped of sentence ends, repeated, or given to the user."""
    space = F.lit(" ")
    draw = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                            F.coalesce(F.col("turn").cast("string"), space)).cast("binary")) % 20
    rows = conversation_repair.turns_of(conversations).withColumn("draw", draw).where("draw <> 0")
    text = F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
                       text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_digests(damaged(conversations), conversations)


@query("op13_warc", oracle=r"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages)
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes,
           array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             ((('0x' || substr(h, 10 * (i // 8) + 1, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31)::INTEGER + 1, 1)
             FOR i IN range(32)], '') AS payload_digest,
           CASE WHEN page_id IS NOT DISTINCT FROM max(page_id) OVER g THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN page_id IS DISTINCT FROM max(page_id) OVER g THEN max(page_id) OVER g END AS refers_to
    FROM p WINDOW g AS (PARTITION BY html)""")
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), out)
    return warc.record_report(spark, out)
