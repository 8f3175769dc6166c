"""Queries that apply the operators to their whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, embedding_dedup, html_extract, langid, line_dedup, mixing, packing, simhash, suffix_dedup, url_filter
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def list_events(pages: DataFrame) -> DataFrame:
    """Dated entries for the pages' own hosts, domains and sections, by the smallest page that has each.

    The tables hold no lists, so entry m of a key is added on day 7m mod 366, taken off again
    sixty days later for even m, and put back after another sixty for every tenth; multiples of
    3 go on list 'spam' (hosts), of 4 on 'adult' (parent domains), of 5 on 'malware' (sections).
    """
    first = lambda key: pages.select("page_id", key.alias("key")).where("key <> ''").groupBy("key").agg(F.min("page_id").alias("m"))
    host = url_filter.host(F.col("url"))
    parent = F.regexp_extract(host, r"^[^.]*\.([^.]+\.[^.]+\.[^.]+)$", 1)
    section = F.concat(host, F.lit("/"), F.regexp_extract("url", url_filter.PATH, 1))
    day = lambda plus: F.date_add(F.lit("2024-01-01").cast("date"), (F.col("m") * 7 % 366 + plus).cast("int"))
    event = lambda plus, action: F.struct(day(plus).alias("date"), F.lit(action).alias("action"))
    history = F.array_compact(F.array(event(0, "add"), F.when(F.col("m") % 2 == 0, event(60, "remove")), F.when(F.col("m") % 10 == 0, event(120, "add"))))
    named = lambda name, n, key: first(key).where(F.col("m") % n == 0).select(F.lit(name).alias("list"), "key", F.explode(history).alias("e")).select("list", "key", "e.date", "e.action")
    return named("spam", 3, host).unionByName(named("adult", 4, parent)).unionByName(named("malware", 5, section))


def op1_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    return url_filter.evaluate(pages.select(F.col("page_id").alias("id"), "url", fetched.alias("fetched")), list_events(pages)).withColumnRenamed("id", "page_id")


OP1_SQL = r"""
WITH p AS (
  SELECT page_id, url, DATE '2024-01-01' + CAST(page_id % 366 AS INTEGER) AS fetched,
    lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS seg
  FROM pages),
k AS (
  SELECT 'spam' AS list, host AS key, min(page_id) AS m, 3 AS n FROM p WHERE host <> '' GROUP BY host
  UNION ALL
  SELECT 'adult', regexp_extract(host, '^[^.]*\.([^.]+\.[^.]+\.[^.]+)$', 1) AS key, min(page_id), 4 FROM p
  WHERE regexp_extract(host, '^[^.]*\.([^.]+\.[^.]+\.[^.]+)$', 1) <> '' GROUP BY 2
  UNION ALL
  SELECT 'malware', host || '/' || seg AS key, min(page_id), 5 FROM p GROUP BY 2),
held AS (
  SELECT list, key, DATE '2024-01-01' + CAST(m * 7 % 366 AS INTEGER) + spell.a AS d0,
    CASE WHEN spell.b IS NULL THEN NULL ELSE DATE '2024-01-01' + CAST(m * 7 % 366 AS INTEGER) + spell.b END AS d1
  FROM k, (VALUES (0, 0, 60), (1, 120, NULL), (2, 0, NULL)) spell(kind, a, b)
  WHERE m % n = 0 AND ((kind = 0 AND m % 2 = 0) OR (kind = 1 AND m % 10 = 0) OR (kind = 2 AND m % 2 <> 0))),
hit AS (
  SELECT p.page_id, p.url, list FROM p JOIN held ON (held.key = p.host OR p.host LIKE '%.' || held.key OR held.key = p.host || '/' || p.seg)
    AND p.fetched >= d0 AND (d1 IS NULL OR p.fetched < d1)),
v AS (SELECT page_id, url, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, count(*) AS n_entries FROM hit GROUP BY page_id, url)
SELECT p.page_id, p.url, p.fetched, coalesce(v.lists, '') AS lists, coalesce(v.n_entries, 0) AS n_entries, v.page_id IS NOT NULL AS blocked
FROM p LEFT JOIN v ON p.page_id = v.page_id AND p.url = v.url
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 4096)


def op3_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


def op4_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_html_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op7_nn_descent_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.dedup(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_suffix_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"), length=50)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(table(spark, sf_dir, "documents"), words=3, seed=42)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.fit(langid.learned(docs)))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_temporal_url_filter, op2_best_fit_packing, op3_line_templates, op4_block_matrix_neighbours, op5_source_mixing, op6_html_min_cut, op7_nn_descent_dedup, op8_suffix_intervals, op9_simhash, op10_language_id)}


def oracle_sql() -> dict[str, str]:
    return {"op1_temporal_url_filter": OP1_SQL}
