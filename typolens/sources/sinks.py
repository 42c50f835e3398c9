"""Writers. A single file is written only on request; a report folder has one file per task otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from typolens.functions.keys import normalize_domain
from typolens.operators.targets import with_ordinal
from typolens.session import cut

CLIENT_COLUMNS = ["brand", "keyword", "specificity", "keyword_misspelling", "match_type", "visits", "avg_cost", "final_score"]


def python_booleans(df: DataFrame) -> DataFrame:
    """Booleans as ``True`` and ``False``, for readers that expect this spelling."""
    return df.select(*[F.initcap(F.col(c).cast("string")).alias(c) if t == "boolean" else F.col(c) for c, t in df.dtypes])


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None, single: bool = False) -> None:
    out = df.orderBy(*order) if order else df
    out = python_booleans(out)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).csv(path)


def append_batch(df: DataFrame, path: str, batch: str = "batch_id") -> None:
    """One folder per request batch; a batch that is written again replaces only itself."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(batch).parquet(path)


def append_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_reports(rows: DataFrame, reason: Column, path: str) -> None:
    """Client view (rows without a reason) and internal view (all rows with it)."""
    marked = rows.withColumn("cut_reason", reason)
    write_csv(marked.filter("cut_reason = ''").select(*[c for c in CLIENT_COLUMNS if c in rows.columns]), f"{path}/client")
    write_csv(marked, f"{path}/internal")


def write_markdown(tables: DataFrame, path: str) -> None:
    """The grouped tables in brand order as text."""
    head = F.when(F.col("part") > 1, "").otherwise(F.concat(F.lit("## "), F.col("brand"), F.lit("\n### "), F.col("keyword"), F.lit("  `"), F.col("specificity"), F.lit("`\n")))
    tables.orderBy("brand", "keyword", "specificity", "part").select(F.concat(head, F.col("table"), F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def write_contexts(brands: DataFrame, contexts: DataFrame, path: str, reason: str = "Failed all crawl methods") -> None:
    """``path/contexts``: a JSON array of the contexts in brand order; ``path/failed``: a CSV of the brands without one.

    ``brands`` has ``brand, pos``; both sides meet by normalised domain, and of one domain the first brand counts.
    """
    keyed = brands.withColumn("__d", normalize_domain(F.col("brand"))).filter(F.coalesce("__d", F.lit("")) != "")
    first = keyed.groupBy("__d").agg(F.min_by(F.struct("brand", "pos"), "pos").alias("b")).select("__d", "b.brand", "b.pos")
    records = contexts.select(normalize_domain(F.col("domain")).alias("__d"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in contexts.columns])).alias("json"))
    joined = cut(first.join(records, "__d", "left"))
    found = with_ordinal(joined.filter("json IS NOT NULL").select("pos", "__d", "json"), ["pos", "__d"])
    lines = found.select("ordinal", F.concat(F.when(F.col("ordinal") == 0, "[").otherwise(","), F.col("json")).alias("value"))
    end = lines.agg((F.coalesce(F.max("ordinal"), F.lit(-1)) + 1).alias("ordinal")).select("ordinal", F.when(F.col("ordinal") == 0, "[]").otherwise("]").alias("value"))
    lines.unionByName(end).orderBy("ordinal").select("value").write.mode("overwrite").text(f"{path}/contexts")
    failed = joined.filter("json IS NULL").orderBy("pos", "__d").select(F.col("brand").alias("Brand"), F.lit(reason).alias("Status"))
    failed.write.mode("overwrite").option("header", True).csv(f"{path}/failed")


def manifest(spark: SparkSession, folder: str, digests: bool = False) -> DataFrame:
    """``path, length, modified`` of every file below a folder, with ``sha256`` on request (a file is read by one task)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    extra = [F.sha2("content", 256).alias("sha256")] if digests else []
    return files.select("path", "length", F.col("modificationTime").alias("modified"), *extra)


def snapshot(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> DataFrame:
    """Writes the tables below ``folder`` and a manifest of their files beside them; returns the manifest."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/tables/{name}")
    manifest(spark, f"{folder}/tables", digests=True).write.mode("overwrite").json(f"{folder}/manifest")
    return spark.read.json(f"{folder}/manifest")
