"""Readers of the pipeline's files. Everything is lazy; row order comes from an ordinal attached at read time."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from typolens.functions.keys import normalize_domain, strip
from typolens.operators.match import as_null

# Words of shop operations whose misspellings carry no brand intent.
BLOCKLIST = """shipping delivery returns refund refunds checkout basket cart order orders tracking coupon coupons promo promocode discount discounts deal deals sale sales clearance outlet online
store stores shop shopping buy cheap price prices pricing premium exclusive official website homepage login signin signup account support help contact service services customer quality
bestseller bestsellers trending popular newarrivals freeshipping giftcard giftcards voucher vouchers newsletter brand brands product products item items collection collections catalog
catalogue wholesale retail platform solutions innovation lifestyle experience"""

#: Brand context record.
CONTEXT_SCHEMA = T.StructType([
    *(T.StructField(c, T.StringType()) for c in ("domain", "url", "title", "meta_description", "meta_keywords", "site_name", "lang")),
    *(T.StructField(c, T.ArrayType(T.StringType())) for c in ("h1_headings", "h2_headings", "nav_links")),
    T.StructField("json_ld_summary", T.StringType()),
    T.StructField("internal_links", T.ArrayType(T.StringType())),
    T.StructField("main_content", T.StringType()),
    T.StructField("subpages", T.ArrayType(T.StructType([T.StructField(c, T.StringType()) for c in ("url", "title", "text")]))),
    T.StructField("wikidata", T.StructType([T.StructField("name", T.StringType()), T.StructField("description", T.StringType()), T.StructField("aliases", T.ArrayType(T.StringType()))])),
    *(T.StructField(c, T.StringType()) for c in ("search_snippet", "status", "error", "source", "timestamp")),
])


def blocklist_words() -> list[str]:
    return BLOCKLIST.split()


def require(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {missing}; it has {df.columns}")
    return df


def read_table(spark: SparkSession, path: str, columns: list[str] | None = None, multi_line: bool = False) -> DataFrame:
    """A CSV with header, all text: headers trimmed and without byte-order mark, lines with too many fields dropped.

    Lines with too few fields keep nulls for the rest. A large file is split over many tasks, as a record is a line;
    ``multi_line`` reads files whose quoted fields hold line feeds, a task per file. With ``columns`` only these are kept.
    The column ``pos`` follows the line order. A file without lines has no header and is refused.
    """
    options = {"quote": '"', "escape": '"'}
    if multi_line:
        raw = spark.read.options(header=True, multiLine=True, mode="DROPMALFORMED", **options).csv(path)
        named = raw.select(*[F.col(f"`{c}`").alias(_header(c)) for c in raw.columns])
    else:
        lines = spark.read.text(path)
        first = lines.first()
        if first is None:
            raise ValueError(f"{path} has no header")
        names = [_header(c) for c in next(csv.reader([first[0]]))]
        schema = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
        # Commas outside quotes; a doubled quote inside a field pairs up with itself.
        fields = F.length(F.regexp_replace(F.regexp_replace("value", '"[^"]*"', ""), "[^,]", "")) + 1
        kept = lines.filter((F.col("value") != first[0]) & (F.trim("value") != "") & (fields <= len(names)))
        parsed = kept.select(F.from_csv("value", schema.simpleString()[len("struct<") : -1].replace(":", " "), options).alias("r"))
        named = parsed.select(*[F.col(f"r._{i}").alias(c) for i, c in enumerate(names)])
    if columns:
        named = require(named, columns, path).select(*columns)
    return named.withColumn("pos", F.monotonically_increasing_id())


def _header(name: str) -> str:
    return name.lstrip("\ufeff").strip()


def first_by(df: DataFrame, key: Column, order: str = "pos") -> DataFrame:
    """The first row of each key by order; rows without key are dropped."""
    cols = df.columns
    keyed = df.withColumn("__k", key).filter(F.col("__k").isNotNull() & (F.col("__k") != ""))
    return keyed.groupBy("__k").agg(F.min_by(F.struct(*cols), F.col(order)).alias("__r")).select(*[F.col("__r")[c].alias(c) for c in cols])


def read_brands(spark: SparkSession, path: str, column: str = "Brand", by_domain: bool = True) -> DataFrame:
    """Brands in original casing, first of each normalised domain (or of each lower-case text)."""
    b = read_table(spark, path, [column]).select(strip(F.col(column)).alias("brand"), "pos").filter("brand != ''")
    return first_by(b, normalize_domain(F.col("brand")) if by_domain else F.lower("brand"))


def read_inventory(spark: SparkSession, path: str, column: str = "address") -> DataFrame:
    return require(read_table(spark, path), [column], path).withColumn(column, as_null(F.col(column)))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on the file system that the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_popular(spark: SparkSession, path: str) -> DataFrame:
    """``domain`` of lines ``rank,domain``; a missing file is an empty list."""
    if not exists(spark, path):
        return spark.createDataFrame([], "domain string")
    lines = spark.read.text(path).filter(F.contains("value", F.lit(",")))
    return lines.select(F.lower(F.trim(F.element_at(F.split("value", ","), -1))).alias("domain")).filter("domain != ''").distinct()


def read_blocklist(spark: SparkSession, path: str) -> DataFrame:
    """One word a line in lower case; text after ``#`` is a comment."""
    return spark.read.text(path).select(F.lower(F.trim(F.substring_index("value", "#", 1))).alias("word")).filter("word != ''").distinct()


def read_contexts(spark: SparkSession, path: str) -> DataFrame:
    """Context records of a JSON array with an explicit schema; of one domain the last counts."""
    rows = spark.read.schema(CONTEXT_SCHEMA).option("multiLine", True).json(path).withColumn("pos", F.monotonically_increasing_id())
    return first_by(rows.withColumn("pos", -F.col("pos")), normalize_domain(F.col("domain"))).drop("pos")


def read_checkpoint(spark: SparkSession, path: str, schema: T.StructType = CONTEXT_SCHEMA) -> DataFrame:
    """Records of a JSON-lines checkpoint; blank and broken lines are skipped."""
    wide = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = lines.select(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r")).select("r.*")
    return parsed.filter("_corrupt_record IS NULL").drop("_corrupt_record")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """``target_id, feed, traffic_type, pos`` of a target list."""
    t = read_table(spark, path, ["Generic ID", "Publisher Feed Hash", "Traffic Type"])
    return t.select(F.col("Generic ID").alias("target_id"), F.col("Publisher Feed Hash").alias("feed"), F.col("Traffic Type").alias("traffic_type"), "pos")
