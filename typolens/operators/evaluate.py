"""Evaluation of keywords against labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.functions.keys import strip

#: Labels; the first two count as hits. Fixed values.
DIRECT, CATEGORY, REJECT = "brand_direct", "category_ok", "reject"


def pair_key(brand: str = "brand", keyword: str = "keyword") -> list[Column]:
    return [F.lower(strip(F.col(brand))).alias("b"), F.lower(strip(F.col(keyword))).alias("k")]


def label_pairs(generated: DataFrame, labels: DataFrame) -> DataFrame:
    """Generated rows with their label (null: none), by brand and keyword in lower case; of repeats the least label."""
    lab = labels.filter("label != ''").select(*pair_key(), "label").groupBy("b", "k").agg(F.min("label").alias("label"))
    keyed = generated.withColumns({"b": F.lower(strip(F.col("brand"))), "k": F.lower(strip(F.col("keyword")))})
    return keyed.join(lab, ["b", "k"], "left")


def metrics(df: DataFrame, by: list[str], digits: int | None = None) -> DataFrame:
    """``n, n_labelled, precision, share_direct, coverage`` over all rows or per group; null where nothing is labelled."""
    n, labelled = F.count(F.lit(1)), F.count("label")
    r = (lambda c: F.round(c, digits)) if digits is not None else (lambda c: c)
    aggs = [
        n.alias("n"), labelled.alias("n_labelled"),
        r(F.try_divide(F.count_if(F.col("label").isin(DIRECT, CATEGORY)), labelled)).alias("precision"),
        r(F.try_divide(F.count_if(F.col("label") == DIRECT), labelled)).alias("share_direct"),
        r(F.try_divide(labelled, n)).alias("coverage"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def label_counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(*[F.count_if(F.col("label") == x).alias(f"n_{x}") for x in (DIRECT, CATEGORY, REJECT)], F.count_if(F.col("label").isNull()).alias("n_unlabelled"))


def inactive_labels(generated: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled pairs (``b, k``) that were not generated."""
    return labels.filter("label != ''").select(*pair_key()).distinct().join(generated.select(*pair_key()), ["b", "k"], "left_anti")


def unlabelled_sample(rows: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` generated rows without a label, by brand and keyword in lower case."""
    brand, keyword = F.col("brand"), F.col("keyword")
    return rows.filter("label IS NULL").select(brand, keyword).orderBy(F.lower(brand), F.lower(keyword), brand, keyword).limit(n)


def evaluation_order(brand: str = "brand", keyword: str = "keyword", label: str = "label") -> list[Column]:
    """Brand, then rows still to be labelled, then keyword."""
    labelled = F.coalesce(F.col(label), F.lit("")) != ""
    return [F.lower(F.col(brand)).asc(), labelled.asc(), F.lower(F.col(keyword)).asc(), F.col(brand).asc(), F.col(keyword).asc()]


def label_progress(rows: DataFrame) -> DataFrame:
    """Per brand ``n, n_labelled, n_open`` and ``fallback``: whether a generated row had no context.

    ``rows`` has ``brand, label, source, context_used``; empty and null labels are open. A null brand is a row.
    """
    labelled = F.coalesce(F.col("label"), F.lit("")) != ""
    bare = F.startswith(F.col("source"), F.lit("baseline")) & ~F.coalesce(F.col("context_used") == "Yes", F.lit(False))
    return rows.groupBy("brand").agg(F.count(F.lit(1)).alias("n"), F.count_if(labelled).alias("n_labelled"), F.count_if(~labelled).alias("n_open"), F.coalesce(F.max(bare), F.lit(False)).alias("fallback"))


def usage_sums(usage: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Sums of ``prompt_tokens`` and ``completion_tokens``; a missing figure counts 0."""
    return usage.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("prompt_tokens", "completion_tokens")])


def upsert_pairs(sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """Union of pair lists in order: first casing, sources joined by ``+``, first non-empty label."""
    rows = None
    for i, (name, df) in enumerate(sources):
        label = F.col("label") if "label" in df.columns else F.lit("")
        part = df.select(*pair_key(), F.col("brand"), F.col("keyword"), label.alias("label"), F.lit(i).alias("i"), F.lit(name).alias("source"))
        rows = part if rows is None else rows.unionByName(part)
    order = F.struct("i", "brand", "keyword")
    some = F.when(F.coalesce(F.col("label"), F.lit("")) != "", F.col("label"))
    merged = rows.groupBy("b", "k").agg(F.min_by("brand", order).alias("brand"), F.min_by("keyword", order).alias("keyword"), F.sort_array(F.collect_set(F.struct("i", "source"))).alias("s"), F.min_by(some, F.when(some.isNotNull(), order)).alias("label"))
    return merged.select("brand", "keyword", F.array_join(F.transform("s", lambda x: x["source"]), "+").alias("source"), F.coalesce("label", F.lit("")).alias("label"))


def append_new(existing: DataFrame, new: DataFrame) -> DataFrame:
    """New pairs that the existing table lacks; existing rows stay as they are."""
    return new.select(*pair_key(), "brand", "keyword").join(existing.select(*pair_key()), ["b", "k"], "left_anti").groupBy("b", "k").agg(F.min(F.struct("brand", "keyword")).alias("x")).select("x.brand", "x.keyword")


def sample_brands(rows: DataFrame, per_vertical: int, seed: str = "42") -> DataFrame:
    """The same ``per_vertical`` brands of each vertical on every run, by a seeded hash."""
    h = F.md5(F.concat(F.lit(seed), F.col("brand")))
    return rows.select("vertical", "brand").distinct().withColumn("r", F.row_number().over(W.partitionBy("vertical").orderBy(h, "brand"))).filter(F.col("r") <= per_vertical).drop("r")
