"""From match rows and traffic to report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.functions.keys import strip
from typolens.operators.targets import with_ordinal

#: Order of tiers; unknown tiers come last. Fixed values.
TIERS = {"brand_core": 0, "branded": 1, "category_strong": 2}


def report_key(c: Column) -> Column:
    return F.lower(strip(c))


def tier(c: Column) -> Column:
    out = F.when(F.lit(False), 0)
    for name, k in TIERS.items():
        out = out.when(c == name, k)
    return out.otherwise(9)


def as_number(c: Column) -> Column:
    """Number of a text, null where it is unreadable."""
    return F.trim(c).try_cast("double")


def best_per_brand(matches: DataFrame) -> DataFrame:
    """The best row of each brand and misspelling: score, distance, similarity, keyword, then id decide."""
    order = [F.col("final_score").desc_nulls_last(), F.col("distance").asc_nulls_last(), F.col("score_jarowinkler").desc_nulls_last(), F.col("keyword").asc_nulls_last(), F.col("match_id").asc()]
    w = W.partitionBy("brand", "key").orderBy(*order)
    keyed = matches.withColumn("key", report_key(F.col("keyword_misspelling")))
    return keyed.withColumn("__r", F.row_number().over(w)).filter("__r = 1").drop("__r")


def assert_disjoint(left: DataFrame, right: DataFrame, on: list[str]) -> None:
    """Columns of both sides other than the keys would be ambiguous afterwards: refuse them."""
    both = (set(left.columns) & set(right.columns)) - set(on)
    if both:
        raise ValueError(f"columns on both sides: {sorted(both)}")


def join_traffic(best: DataFrame, traffic: DataFrame) -> DataFrame:
    """Traffic rows with the match rows of the same normalised address (many to many); null keys match nothing."""
    right = traffic.withColumn("key", report_key(F.col("target_address")))
    assert_disjoint(best, right, ["key"])
    return right.join(best, "key")


def client_order() -> list[Column]:
    """Brand, tier, visits descending (unreadable as 0), address."""
    visits = F.coalesce(F.col("visits"), F.lit(0.0))
    return [F.col("brand").asc_nulls_first(), F.col("tier").asc(), F.when(F.isnan(visits), 0.0).otherwise(visits).desc(), F.col("keyword_misspelling").asc_nulls_first()]


def popular_flag(rows: DataFrame, popular: DataFrame, domain: Column) -> DataFrame:
    """Rows with ``is_popular``: whether the domain is in ``popular`` (``domain``). No row is dropped."""
    marked = rows.withColumn("__d", domain).join(popular.select(F.lower("domain").alias("__d"), F.lit(True).alias("__hit")).distinct(), "__d", "left")
    return marked.withColumn("is_popular", F.coalesce("__hit", F.lit(False))).drop("__d", "__hit")


#: Lines of one part of a Markdown table.
PART_LINES = 1_000


def grouped_markdown(rows: DataFrame, part_lines: int = PART_LINES) -> DataFrame:
    """``brand, keyword, specificity, part, table``: Markdown tables per brand, keyword and tier, in parts.

    Lines are in order of address and of their text. All lines are numbered through by a range sort, and every
    ``part_lines`` of them begin a new part, so a part is bounded and no group meets in one task, however many rows it has.
    The first part of a table has its head. Null brands, keywords and tiers have no table.
    """
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in ("keyword_misspelling", "visits", "final_score", "match_type")]), F.lit(" |"))
    kept = rows.filter("brand IS NOT NULL AND keyword IS NOT NULL AND specificity IS NOT NULL").select("brand", "keyword", "specificity", "keyword_misspelling", line.alias("line"))
    numbered = with_ordinal(kept, ["brand", "keyword", "specificity", "keyword_misspelling", "line"])
    group = ["brand", "keyword", "specificity"]
    parts = numbered.groupBy(*group, F.floor(F.col("ordinal") / part_lines).alias("p")).agg(F.array_sort(F.collect_list(F.struct("ordinal", "line"))).alias("l"))
    parts = parts.withColumn("part", F.row_number().over(W.partitionBy(*group).orderBy("p")))
    head = F.when(F.col("part") == 1, "| misspelling | visits | score | match |\n|---|---|---|---|\n").otherwise("")
    return parts.select(*group, "part", F.concat(head, F.array_join(F.transform("l", lambda x: x["line"]), "\n")).alias("table"))
