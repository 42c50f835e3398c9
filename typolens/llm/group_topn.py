"""Top N items of every group, with the same result however the rows are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: A group with more rows than this is heavy, and so many rows of it make a salt.
LIGHT_ROWS = 20_000
#: Of more heavy groups only the largest ones are salted. A group that is left then has less than one in so many of all
#: rows, no more than a task has anyway.
MOST_HEAVY = 10_000


def top_n_per_group(df: DataFrame, group: str, n: int, order: list[Column], distinct: str | None = None, light_rows: int = LIGHT_ROWS) -> DataFrame:
    """The first ``n`` rows of every ``group`` by ``order``, at most one per value of ``distinct``, with ``rank``.

    Exact group counts (partially aggregated) split the groups: light groups go through one exchange on the group and
    ordinary windows; the rows of heavy groups are spread over as many salts as the largest one has ``light_rows``, by the
    hash of ``distinct`` (or of all columns), and range-partitioned by group and salt, so that small pieces share a task;
    each range is sorted and cut to ``n``, and
    only those survivors meet in the final window. ``order`` must be total for a reproducible result. A null group is no
    group. Groups with fewer than ``n`` items are returned whole; ``n`` below 1 and empty tables give no rows; extra
    columns are kept.
    """
    rows = df.filter(F.col(group).isNotNull())
    sizes = rows.groupBy(group).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > light_rows)
    heavy = [(r[0], -(-r[1] // light_rows)) for r in sizes.orderBy(F.col("__n").desc(), group).limit(MOST_HEAVY).collect()]
    first = lambda by: F.row_number().over(W.partitionBy(*by).orderBy(*order))

    def best(part: DataFrame, by: list[str]) -> DataFrame:
        if distinct:
            part = part.withColumn("__d", first([*by, distinct])).filter("__d = 1").drop("__d")
        return part.withColumn("rank", first(by)).filter(F.col("rank") <= n)

    if not heavy:
        return best(rows.repartition(group), [group])
    # A list in the filter reaches the scan: what only the other half needs is not worked out for a row.
    is_heavy = F.col(group).isin([g for g, _ in heavy])
    light = best(rows.filter(~is_heavy).repartition(group), [group])
    spot = F.xxhash64(distinct) if distinct else F.xxhash64(*df.columns)
    salts = max(n for _, n in heavy)
    hot = rows.filter(is_heavy).withColumn("__salt", F.pmod(spot, F.lit(salts)))
    # The windows below are clustered by these columns already: nothing is exchanged between them.
    local = best(hot.repartitionByRange(group, "__salt"), [group, "__salt"]).select(*df.columns)
    return light.unionByName(local.withColumn("rank", first([group])).filter(F.col("rank") <= n))
