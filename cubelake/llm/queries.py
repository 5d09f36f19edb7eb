"""Queries of the operators in this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cubelake.llm import ann, bpe, filter_audit, html_text, jaccard, lang_id, merkle, packing, shards, spelling, toxicity, url_filter, warc
from cubelake.llm.common import table
from cubelake.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lang_id.identify_documents(table(spark, sf_dir, "documents"))


def op2_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(table(spark, sf_dir, "documents"), shards=24)


def op3_temporal_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a capture, against lists whose dated entries are derived from ``events``.

    Pages carry no time: the fetch time is spread over the month of the
    events by page_id. An event concerns the page numbered like its user
    (counted round where there are more users than pages); its type says
    whether that page's host, domain or first path segment is added to a list
    (purchase, signup, click) or removed (error, view).
    """
    pages = table(spark, sf_dir, "pages")
    captures = pages.select(
        "page_id",
        "url",
        F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("page_id") * 7919, F.lit(2592000))).alias("fetched_at"),
    )
    subject = pages.select(
        F.col("page_id").alias("user_id"),
        url_filter.host_of(F.col("url")).alias("host"),
        F.split(url_filter.path_of(F.col("url")), "/")[1].alias("first"),
    )
    last = pages.agg(F.max("page_id").cast("long")).first()[0]
    events = table(spark, sf_dir, "events").withColumn("user_id", F.col("user_id") % F.lit((last or 0) + 1))
    labels = F.split("host", r"\.")
    entries = events.join(subject, "user_id").select(
        F.when(F.col("user_id") % 4 == 0, "allow").otherwise("deny").alias("list"),
        F.element_at(F.array(F.lit("host"), F.lit("domain"), F.lit("prefix")), (F.col("event_id") % 3 + 1).cast("int")).alias("kind"),
        F.when(F.col("event_id") % 3 == 0, F.col("host"))
        .when(F.col("event_id") % 3 == 1, F.array_join(F.slice(labels, -3, 3), "."))
        .otherwise(F.concat_ws("/", "host", "first"))
        .alias("pattern"),
        F.when(F.col("event_type").isin("error", "view"), "remove").otherwise("add").alias("action"),
        F.date_trunc("second", "ts").alias("at"),
    )
    found = url_filter.evaluate(captures, entries)
    times = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("fetched_at", "valid_from")}
    return found.withColumns(times)


def op4_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = jaccard.link_components(table(spark, sf_dir, "documents"), size=3, percent=90)
    return links.select("doc_id", "n_shingles", "component_id")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_toxicity_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_window_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op9_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


def op13_warc_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives in the shared folder, written and read back."""
    manifest = warc.write_archives(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    records = warc.read_archives(manifest)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Query] = {
    "op1_language_filters": op1_language_filters,
    "op2_byte_shards": op2_byte_shards,
    "op3_temporal_url_lists": op3_temporal_url_lists,
    "op4_merkle_fingerprints": op4_merkle_fingerprints,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_toxicity_gru": op7_toxicity_gru,
    "op8_window_packing": op8_window_packing,
    "op9_learned_partitions": op9_learned_partitions,
    "op10_page_differencing": op10_page_differencing,
    "op11_filter_audit": op11_filter_audit,
    "op12_spelling_groups": op12_spelling_groups,
    "op13_warc_dictionary": op13_warc_dictionary,
}

ORACLE: dict[str, str] = {
    "op3_temporal_url_lists": r"""
        WITH p AS (
            SELECT page_id, url, to_timestamp(1704067200 + page_id * 7919 % 2592000) AT TIME ZONE 'UTC' AS fetched_at,
                   lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1)) AS host,
                   regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        e AS (
            SELECT DISTINCT CASE WHEN p.page_id % 4 = 0 THEN 'allow' ELSE 'deny' END AS list,
                   CASE event_id % 3 WHEN 0 THEN 'host' WHEN 1 THEN 'domain' ELSE 'prefix' END AS kind,
                   lower(trim(CASE event_id % 3 WHEN 0 THEN host
                              WHEN 1 THEN array_to_string(list_slice(string_split(host, '.'), -3, -1), '.')
                              ELSE host || '/' || string_split(path, '/')[2] END, './')) AS pattern,
                   CASE WHEN event_type IN ('error', 'view') THEN 'remove' ELSE 'add' END AS action,
                   date_trunc('second', ts) AS entry_at
            FROM events JOIN p ON p.page_id = events.user_id % (SELECT max(page_id) + 1 FROM pages)),
        i AS (
            SELECT list, kind, pattern, action, entry_at AS valid_from,
                   lead(entry_at) OVER (PARTITION BY list, kind, pattern ORDER BY entry_at, action) AS valid_to
            FROM e),
        v AS (SELECT * FROM i WHERE action = 'add' AND (valid_to IS NULL OR valid_to > valid_from)),
        k AS (
            SELECT page_id, fetched_at, 'host' AS kind, host AS pattern FROM p
            UNION ALL
            SELECT page_id, fetched_at, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1),
                   lambda n: array_to_string(list_slice(string_split(host, '.'), n, len(string_split(host, '.'))), '.')))
            FROM p
            UNION ALL
            SELECT page_id, fetched_at, 'prefix', unnest(list_transform(range(1, len(s) + 1),
                   lambda n: host || '/' || array_to_string(list_slice(s, 1, n), '/')))
            FROM (SELECT *, list_filter(string_split(lower(path), '/'), lambda x: x <> '') AS s FROM p)),
        m AS (
            SELECT k.page_id, v.*, row_number() OVER (
                       PARTITION BY k.page_id
                       ORDER BY length(v.pattern) DESC, v.list = 'allow' DESC, v.kind DESC, v.valid_from DESC) AS rn
            FROM k JOIN v ON v.kind = k.kind AND v.pattern = k.pattern AND v.valid_from <= k.fetched_at
                         AND (v.valid_to IS NULL OR k.fetched_at < v.valid_to))
        SELECT p.page_id, p.url, strftime(p.fetched_at, '%Y-%m-%d %H:%M:%S') AS fetched_at,
               CASE WHEN m.list IS NULL THEN 'unlisted' WHEN m.list = 'allow' THEN 'allowed' ELSE 'blocked' END AS verdict,
               m.list, m.kind, m.pattern, strftime(m.valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from
        FROM p LEFT JOIN m ON m.page_id = p.page_id AND m.rn = 1
    """,
    "op11_filter_audit": r"""
        WITH d AS (
            SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body FROM documents),
        w AS (
            SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
                   min(doc_id) OVER (PARTITION BY body) AS first
            FROM d),
        m AS (
            SELECT doc_id, part,
                   CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 2 * length(body)
                          THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
            FROM w),
        l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        c AS (
            SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE l.good) AS good,
                   count(*) FILTER (WHERE l.toxic) AS toxic
            FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
        f(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        o AS (
            SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
            FROM f a, f b, f c, f d, f e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
        s AS (
            SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
            FROM o, (SELECT unnest(range(1, 6)) AS step)),
        r AS (
            SELECT part, filter_order, step, own,
                   sum(CASE WHEN mask & (before | own) = 0 THEN n ELSE 0 END) AS kept,
                   sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed,
                   sum(CASE WHEN mask & before > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
                   sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
                   sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN good ELSE 0 END) AS good_lost,
                   sum(CASE WHEN mask & before = 0 AND mask & own > 0 THEN toxic ELSE 0 END) AS toxic_lost
            FROM c, s GROUP BY part, filter_order, step, own)
        SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
               CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
               CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
               CAST(toxic_lost AS BIGINT) AS toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
        FROM r
    """,
    # DuckDB has no crc32: bytes are taken off one by one, through the table of remainders
    "op12_spelling_groups": r"""
        WITH t AS (
            SELECT list(CAST(list_reduce(range(0, 8), lambda c, k:
                       CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS BIGINT) ORDER BY b) AS remainders
            FROM range(256) r(b)),
        r AS (
            SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
                   unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-zÀ-ÿ]{5,}')) AS run
            FROM documents),
        d AS (SELECT id, run, count(*) AS times, hex(encode(id || ':' || run)) AS digits FROM r GROUP BY id, run),
        h AS (
            SELECT run, times, xor(4294967295, list_reduce(
                       list_transform(range(1, strlen(digits), 2), lambda i: CAST('0x' || digits[i:i + 1] AS BIGINT)),
                       lambda c, b: xor(remainders[xor(c, b) % 256 + 1], c // 256), 4294967295)) AS checksum
            FROM d, t),
        v AS (
            SELECT times, CASE WHEN checksum % 97 = 0
                   THEN left(run, CAST(checksum % length(run) AS BIGINT)) || substr(run, CAST(checksum % length(run) + 2 AS BIGINT))
                   ELSE run END AS word
            FROM h),
        w AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM v WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3),
        x AS (
            SELECT word, n, place, left(word, place) || substr(word, place + 2) AS less
            FROM (SELECT *, unnest(range(0, length(word))) AS place FROM w)),
        p AS (
            SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM x a JOIN x b USING (less, place) WHERE a.word <> b.word
            UNION SELECT x.word, w.word, w.n FROM x JOIN w ON w.word = x.less
            UNION SELECT w.word, x.word, x.n FROM x JOIN w ON w.word = x.less),
        f AS (
            SELECT word, count(*) AS n_near, arg_min(other, (-m, other)) AS other, max(m) AS m FROM p GROUP BY word),
        g AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form,
                   CASE WHEN m >= 2 * w.n THEN m END AS form_n
            FROM w LEFT JOIN f USING (word)),
        c AS (
            WITH RECURSIVE steps AS (
                SELECT word, word AS reached FROM g
                UNION ALL
                SELECT steps.word, g.form FROM steps JOIN g ON g.word = steps.reached WHERE g.form IS NOT NULL)
            SELECT steps.word, steps.reached AS root FROM steps JOIN g ON g.word = steps.reached WHERE g.form IS NULL)
        SELECT word, form, root, n, n_near, form_n FROM g JOIN c USING (word)
    """,
    "op13_warc_dictionary": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
            FROM pages),
        r AS (SELECT *, payload_bytes >= 100 AND page_id <> first AS revisit FROM p)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN revisit THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN revisit THEN first END AS refers_to
        FROM r
    """,
}
