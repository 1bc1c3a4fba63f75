"""The queries of the subpackage, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterline.llm import (
    exact_dedup,
    filter_audit,
    language_id,
    language_model,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    phrase_index,
    quality,
    spelling,
    substring_dedup,
)
from quarterline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


@query("op1_substring_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup.repeated_passages(table(spark, folder, "documents"))


@query("op2_hilbert_neighbours")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op3_kneser_ney_quality")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op4_pitman_yor_scores")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.language_scores(table(spark, folder, "documents"))


@query(
    "op5_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS sha FROM documents),
         g AS (SELECT *, count(*) OVER (PARTITION BY sha) AS group_size,
                      first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id FROM t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256 FROM g
    """,
)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query("op6_language_id")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.language_of(table(spark, folder, "documents"))


@query("op7_minhash_near_dedup")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), near_dedup.Near(shingle=3, percent=85))


@query(
    "op8_poisson_mix",
    """
    WITH RECURSIVE sizes AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source),
         whole AS (SELECT sum(chars) AS chars, sum(pow(chars, 0.7)) AS weights FROM sizes),
         rates AS (SELECT source, CASE WHEN s.chars > 0 THEN w.chars * pow(s.chars, 0.7) / w.weights / s.chars ELSE 1.0 END AS rate FROM sizes s, whole w),
         steps AS (SELECT source, rate, 0 AS k, exp(-rate) AS p, exp(-rate) AS step FROM rates
                   UNION ALL
                   SELECT source, rate, k + 1, p * rate / (k + 1), step + p * rate / (k + 1) FROM steps WHERE k < ceil(rate + 12 * sqrt(rate) + 30)),
         drawn AS (SELECT doc_id, source, coalesce(text, '') AS text,
                          ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':17'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM documents),
         counted AS (SELECT d.doc_id, d.source, d.text, (SELECT count(*) FROM steps s WHERE s.source IS NOT DISTINCT FROM d.source AND s.step <= d.u) AS copies FROM drawn d),
         copied AS (SELECT doc_id, source, text, copies, unnest(range(copies)) AS copy FROM counted)
    SELECT doc_id, source, copies, copy, length(text) AS chars,
           ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || copy || ':18'), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS place
    FROM copied
    """,
)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    copies = mixing.replicate(docs, mixing.source_rates(docs, 0.7))
    return copies.select(
        "doc_id", "source", F.col("__copies").cast("long").alias("copies"), F.col("__copy").cast("long").alias("copy"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"), F.col("__place").alias("place"),
    )


@query("op9_pack")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), tokenizer_path())


@query(
    "op10_line_dedup",
    r"""
    WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
         l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM t),
         k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
         f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
         j AS (SELECT k.doc_id, k.pos, k.line, f.key IS NOT NULL AND k.doc_id <> f.last AS gone FROM k LEFT JOIN f ON k.key = f.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
    FROM j GROUP BY doc_id
    """,
)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query(
    "op11_filter_audit",
    r"""
    WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') AS runs FROM documents),
         w AS (SELECT *, [x FOR x IN runs IF x <> ''] AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM t),
         l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
         f AS (SELECT part, [x FOR x IN [
                      CASE WHEN len(words) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' END,
                      CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) THEN 'C' END,
                      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN doc_id > first THEN 'E' END] IF x IS NOT NULL] AS fails,
                      coalesce(good, false)::BIGINT AS good, coalesce(toxic, false)::BIGINT AS toxic
               FROM w LEFT JOIN l USING (doc_id)),
         m AS MATERIALIZED (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
         letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
         orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
                    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
         gone AS (SELECT *, coalesce(list_min([instr(filter_order, x) FOR x IN fails]), 6) AS gone_at FROM m, orders),
         grid AS (SELECT part, filter_order, step, substr(filter_order, step, 1) AS filter
                  FROM (SELECT DISTINCT part FROM m), orders, (SELECT unnest(range(1, 6))::INTEGER AS step)),
         counted AS (SELECT g.part, g.filter_order, g.step, any_value(filter) AS filter,
                            sum(CASE WHEN gone_at > step THEN n ELSE 0 END)::BIGINT AS kept, sum(CASE WHEN gone_at = step THEN n ELSE 0 END)::BIGINT AS removed,
                            sum(CASE WHEN list_contains(fails, filter) AND gone_at < step THEN n ELSE 0 END)::BIGINT AS redundant,
                            sum(CASE WHEN fails = [filter] THEN n ELSE 0 END)::BIGINT AS unique_fails,
                            sum(CASE WHEN gone_at = step THEN good ELSE 0 END)::BIGINT AS good_lost, sum(CASE WHEN gone_at = step THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
                     FROM grid g JOIN gone ON g.part = gone.part AND g.filter_order = gone.filter_order GROUP BY 1, 2, 3)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, sum(removed) OVER (PARTITION BY part, filter)::BIGINT AS shapley
    FROM counted
    """,
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Five filters over every document, in all 120 orders, by source."""
    flags = filter_audit.document_failures(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return filter_audit.audit(flags, "ABCDE", "part", ["good", "toxic"])


@query(
    "op12_phrase_index",
    r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS doc,
                      regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
         i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
         windows AS (SELECT DISTINCT item, least(len(words), 10) AS size, list_slice(words, pos, pos + least(len(words), 10) - 1) AS phrase
                     FROM (SELECT *, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS pos FROM i WHERE len(words) > 0)),
         sizes AS (SELECT DISTINCT size FROM windows),
         runs AS (SELECT doc, pos, size, list_slice(words, pos, pos + size - 1) AS phrase
                  FROM (SELECT doc, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM d, sizes)),
         found AS MATERIALIZED (SELECT doc, pos, size, item FROM runs JOIN windows USING (size, phrase)),
         hits AS (SELECT doc, count(DISTINCT place) AS n_hit FROM (SELECT doc, unnest(range(pos, pos + size)) AS place FROM found) GROUP BY doc),
         named AS (SELECT doc, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc, item FROM found WHERE item IS NOT NULL) GROUP BY doc)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits USING (doc) LEFT JOIN named USING (doc)
    """,
)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Ten-word windows of every benchmark item in the index of every document."""
    found = phrase_index.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"), length=10)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op13_spelling_variants")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document and the frequent forms that they are one edit from."""
    return spelling.spelling_variants(table(spark, folder, "documents"))
