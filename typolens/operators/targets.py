"""Resolution of matched addresses to traffic targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.functions.keys import dump_key


def usable_key(c: Column) -> Column:
    """Normalised lookup key; blank and ``nan`` are none."""
    v = dump_key(c)
    return F.when((v != "") & (v != "nan"), v)


def target_multimap(lookup: DataFrame, dump: DataFrame) -> DataFrame:
    """One row per lookup row and target row of the same key (a plain one-to-many join, nothing is collected).

    ``lookup`` has ``pos, address``; ``dump`` has ``dump_pos, address, target_id, feed``. Keys keep ``www.``.
    Null, blank and ``nan`` keys match nothing; repeated lookup keys repeat their targets.
    """
    left = lookup.select("pos", usable_key(F.col("address")).alias("key"))
    right = dump.select("dump_pos", usable_key(F.col("address")).alias("key"), "target_id", F.coalesce("feed", F.lit("")).alias("feed"))
    return left.filter(F.col("key").isNotNull()).join(right.filter("key IS NOT NULL AND trim(target_id) != ''"), "key")


def first_by_id(pairs: DataFrame) -> DataFrame:
    """``target_id, feed`` of the first occurrence of each id in (lookup, dump) order: a mergeable minimum, no sort."""
    return pairs.groupBy("target_id").agg(F.min_by("feed", F.struct("pos", "dump_pos")).alias("feed"))


def unmatched_keys(lookup: DataFrame, dump: DataFrame) -> DataFrame:
    """``key, n`` of lookup keys (counted with repeats) without any target."""
    left = lookup.select(usable_key(F.col("address")).alias("key")).filter("key IS NOT NULL").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return left.join(dump.filter("trim(target_id) != ''").select(usable_key(F.col("address")).alias("key")), "key", "left_anti")


def multi_feed_addresses(dump: DataFrame) -> DataFrame:
    """``key, n_pairs`` of addresses with more than one (id, feed) row."""
    rows = dump.select(usable_key(F.col("address")).alias("key"), "target_id", "feed").filter("key IS NOT NULL AND trim(target_id) != ''")
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_pairs")).filter("n_pairs > 1")


def feed_by_id(targets: DataFrame, traffic_type: str = "Domain") -> DataFrame:
    """``target_id, feed``: the last row of each id in position order, of rows of the wanted type with an id."""
    rows = targets.filter((F.trim("traffic_type") == traffic_type) & (F.trim("target_id") != ""))
    return rows.groupBy(F.trim("target_id").alias("target_id")).agg(F.max_by("feed", "pos").alias("feed"))


def enrich_feed(report: DataFrame, feeds: DataFrame) -> DataFrame:
    """Report rows with the feed of their target, ``""`` where none is known. A null id has none."""
    return report.join(feeds, "target_id", "left").withColumn("feed", F.coalesce("feed", F.lit("")))


def with_ordinal(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Consecutive numbers from 0 in the given total order, without a single-task window.

    Rows are range-partitioned and sorted; the counts of the partitions (one row each) give the offsets.
    """
    from typolens.session import cut

    ranged = cut(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__p", F.spark_partition_id()).withColumn("__i", F.monotonically_increasing_id()))
    sizes = ranged.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"), F.min("__i").alias("__first"))
    offsets = sizes.withColumn("__before", F.sum("__n").over(W.orderBy("__p").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")).select("__p", "__before", "__first")
    return ranged.join(F.broadcast(offsets), "__p").withColumn(name, F.col("__before") + F.col("__i") - F.col("__first")).drop("__p", "__i", "__before", "__first")


def request_batches(ids: DataFrame, order: list[str], size: int = 10_000) -> DataFrame:
    """Rows with the number of the request batch they belong to."""
    return with_ordinal(ids, order).withColumn("batch_id", F.floor(F.col("ordinal") / size).cast("long"))
