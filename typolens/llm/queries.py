"""Queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typolens.functions.keys import clean_value, reference_key
from typolens.llm.blocks import boilerplate_lines, main_bodies
from typolens.llm.group_topn import top_n_per_group
from typolens.llm.language import page_languages
from typolens.llm.leakage import leaked_items
from typolens.llm.mixture import mix_sources, mixture_shares
from typolens.llm.residue import residue_fields, residue_report
from typolens.llm.truncation import truncated_texts, truncation_by_source
from typolens.session import table

WS = r"\t-\r\x1c-\x1f \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boilerplate_lines(table(spark, sf_dir, "crawl_pages"))


def p2_main_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_bodies(table(spark, sf_dir, "crawl_pages"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "crawl_pages")).filter("differs").select("page_id", "line_no", "lang")


def p3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_languages(table(spark, sf_dir, "crawl_pages")).select("page_id", "line_no", "lang", "confidence")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_fields(table(spark, sf_dir, "crawl_pages")).select("page_id", "field_name")


def p6_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_report(table(spark, sf_dir, "crawl_pages"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p8_leaks_by_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))
    return found.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_docs"), F.max("words").alias("most_words"))


def p9_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_shares(p9_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncated_texts(table(spark, sf_dir, "documents")).select("doc_id")


def p10_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation_by_source(table(spark, sf_dir, "documents"))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "match_rows").select(
        clean_value(F.col("brand")).alias("brand"), "match_id", "final_score", "distance", "score_jarowinkler",
        reference_key(F.col("keyword_misspelling")).alias("misspelling"),
    )
    rows = rows.filter(F.col("final_score").isNotNull() & ~F.isnan("final_score") & F.col("misspelling").isNotNull())
    jw = F.when(~F.isnan("score_jarowinkler"), F.col("score_jarowinkler"))
    order = [F.col("final_score").desc(), F.col("distance").asc_nulls_last(), jw.desc_nulls_last(), F.col("misspelling").asc(), F.col("match_id").asc()]
    return top_n_per_group(rows, "brand", 10, order, distinct="misspelling")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select("brand", "match_id")


def p7_top_misspellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ranked(spark, sf_dir).select("brand", F.col("rank").cast("long").alias("rank"), "misspelling", "final_score", "match_id")


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_main_bodies, p3_found, p3_languages, p6_found, p6_messages, p7_found, p7_top_misspellings, p8_found, p8_leaks_by_item, p9_mixture, p9_shares, p10_found, p10_by_source)}


def _p7_sql(cols: str) -> str:
    strip = lambda c, extra="": f"regexp_replace({c}, '^[{WS}{extra}]+|[{WS}]+$', '', 'g')"
    order = "final_score desc, distance asc nulls last, case when isnan(score_jarowinkler) then null else score_jarowinkler end desc nulls last, misspelling asc, match_id asc"
    bom = r"\x{feff}"
    return f"""
with r as (select nullif(lower({strip('brand')}), '') as brand, nullif(nullif(lower({strip('keyword_misspelling', bom)}), ''), 'nan') as misspelling, match_id, final_score, distance, score_jarowinkler from match_rows
  where final_score is not null and not isnan(final_score)),
f as (select *, row_number() over (partition by brand, misspelling order by {order}) as d from r where brand is not null and misspelling is not null),
t as (select *, row_number() over (partition by brand order by {order}) as rank from f where d = 1)
select {cols} from t where rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {
        "p7_found": _p7_sql("brand, match_id"),
        "p7_top_misspellings": _p7_sql("brand, rank, misspelling, final_score, match_id"),
    }
