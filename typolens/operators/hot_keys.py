"""Per-key results at even load when a handful of keys hold most rows.

Heavy keys and exact per-key quantiles are both found by distributed selection: histograms of mergeable counts are
refined step by step until the wanted ranks resolve. No step gathers the values of a key in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.session import cut

#: Bits of the key hash that one refinement resolves; a histogram has at most 2 ** BITS bins per field.
BITS = 12
BINS = 256
#: A key of at most so many distinct values is sorted in one task; more are refined by histograms.
COLD_VALUES = 2_000
#: Rows of keys and ranks that may be broadcast (some 100 bytes each).
BROADCAST_KEYS = 20_000
SALTS = 32


def key_rows(df: DataFrame, fields: dict[str, Column], *carry: Column) -> DataFrame:
    """One row per row and field: ``field_name, key_value`` (null keys dropped) and the carried columns."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field_name"), c.alias("key_value")) for n, c in fields.items()])
    exploded = df.select(F.explode(pairs).alias("__k"), *carry)
    kept = [c for c in exploded.columns if c != "__k"]
    return exploded.select("__k.field_name", "__k.key_value", *kept).filter(F.col("key_value").isNotNull())


def heavy_keys(df: DataFrame, fields: dict[str, Column], share: float) -> DataFrame:
    """``field_name, key_value, n_rows`` of every key with at least ``share`` of all rows of ``df``.

    Exact. Two histograms over the key hash leave at most ``1 / share`` bins per field (the only thing the driver sees
    is a histogram of at most ``2 ** BITS`` bins per field); keys are counted in full only inside those bins, so the
    many light keys are never shuffled one by one. Null keys are no keys but their rows count in the total. An empty
    table has no heavy keys; keys that tie at the threshold are all reported.
    """
    total = df.count()
    least = max(1, share * total)
    rows = key_rows(df, fields).withColumn("__h", F.xxhash64("key_value"))
    kept: list[tuple[str, int]] | None = None
    for level in (1, 2):
        b = F.shiftright(F.col("__h"), 64 - BITS * level)
        inside = rows if kept is None else rows.filter(F.struct("field_name", F.shiftright(F.col("__h"), 64 - BITS * (level - 1))).isin([F.struct(F.lit(f), F.lit(x).cast("long")) for f, x in kept]))
        hist = inside.groupBy("field_name", b.alias("__b")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
        kept = [(r["field_name"], r["__b"]) for r in hist.collect()]
        if not kept:
            return rows.filter(F.lit(False)).groupBy("field_name", "key_value").agg(F.count(F.lit(1)).alias("n_rows"))
    last = rows.filter(F.struct("field_name", F.shiftright(F.col("__h"), 64 - BITS * 2)).isin([F.struct(F.lit(f), F.lit(x).cast("long")) for f, x in kept]))
    return last.groupBy("field_name", "key_value").agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") >= least)


def _cold_quantiles(data: DataFrame, by: list[str], quantiles: Sequence[float]) -> DataFrame:
    """Keys of few distinct values: a running sum over each key's counts, all quantiles at once."""
    w = W.partitionBy(*by).orderBy("__v")
    upto = data.withColumn("__upto", F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, 0))).withColumn("__m", F.sum("__n").over(W.partitionBy(*by)))
    rank = [F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("__m"))) for q in quantiles]
    picked = [F.max(F.when((F.col("__upto") - F.col("__n") < r) & (r <= F.col("__upto")), F.col("__v"))).alias(f"__q{i}") for i, r in enumerate(rank)]
    wide = upto.groupBy(*by).agg(*picked)
    return wide.select(*by, F.explode(F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.col(f"__q{i}").alias("value")) for i, q in enumerate(quantiles)])).alias("__q")).select(*by, "__q.quantile", "__q.value")


def key_quantiles(counts: DataFrame, by: Sequence[str], value: str, n: str, quantiles: Sequence[float], max_rounds: int = 64, cold_values: int = COLD_VALUES) -> DataFrame:
    """Exact nearest-rank quantiles per key: ``by``, ``quantile``, ``value``.

    ``counts`` holds value counts (``by``, ``value``, ``n``), one row per key and value; rows whose key is null or whose
    value is null or NaN take no part. The quantile ``q`` of ``m`` values is the one of rank ``ceil(q * m)`` (at least 1).
    Keys of at most ``cold_values`` distinct values are resolved by a running sum. For all others each round lays ``BINS``
    bins over the interval in which a rank must lie, counts them, and goes on inside the bin that holds the rank; the bins
    carry their least and greatest value, so a rank is resolved when these agree. Keys without values are absent.
    """
    by = list(by)
    data = counts.filter(F.col(value).isNotNull() & ~F.isnan(value) & (F.col(n) > 0)).dropna(subset=by).select(*by, F.col(value).cast("double").alias("__v"), F.col(n).alias("__n"))
    data = cut(data)
    sizes = data.groupBy(*by).agg(F.sum("__n").alias("__m"), F.count(F.lit(1)).alias("__d"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    hot = cut(sizes.filter(F.col("__d") > cold_values))
    n_hot = hot.count()
    if not n_hot:
        return _cold_quantiles(data, by, quantiles)
    keys = hot.select(*by)
    keys = F.broadcast(keys) if n_hot <= BROADCAST_KEYS else keys
    cold = _cold_quantiles(data.join(keys, by, "left_anti"), by, quantiles)
    # Rounds read the hot keys' counts only, and their keys are salted by the value wherever a join shuffles them.
    values = cut(data.join(keys, by, "left_semi"))
    ranks = F.array(*[F.struct(F.lit(float(q)).alias("quantile"), F.greatest(F.lit(1), F.ceil(F.lit(float(q)) * F.col("__m"))).alias("__r")) for q in quantiles])
    state = hot.select(*by, "__lo", "__hi", F.explode(ranks).alias("__q")).select(*by, "__lo", "__hi", "__q.quantile", "__q.__r")
    resolved = state.filter("__lo = __hi").select(*by, "quantile", F.col("__lo").alias("value"))
    open_, n_open = state.filter("__lo < __hi"), n_hot * len(quantiles)
    for _ in range(max_rounds):
        if not n_open:
            break
        if n_open <= BROADCAST_KEYS:
            joined = values.join(F.broadcast(open_), by)
        else:
            salted = open_.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
            joined = values.withColumn("__salt", F.pmod(F.xxhash64("__v"), F.lit(SALTS)).cast("int")).join(salted, [*by, "__salt"]).drop("__salt")
        hit = joined.filter(F.col("__v").between(F.col("__lo"), F.col("__hi")))
        half = F.col("__hi") / 2 - F.col("__lo") / 2
        b = F.least(F.lit(BINS - 1), F.floor((F.col("__v") / 2 - F.col("__lo") / 2) / half * BINS)).cast("int")
        bins = hit.groupBy(*by, "quantile", "__r", b.alias("__b")).agg(F.sum("__n").alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
        w = W.partitionBy(*by, "quantile").orderBy("__b")
        below = F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")
        picked = bins.withColumn("__below", below).filter((F.col("__below") < F.col("__r")) & (F.col("__r") <= F.col("__below") + F.col("__n")))
        state = cut(picked.select(*by, "__lo", "__hi", "quantile", (F.col("__r") - F.col("__below")).alias("__r")))
        resolved = resolved.unionByName(state.filter("__lo = __hi").select(*by, "quantile", F.col("__lo").alias("value")))
        open_ = state.filter("__lo < __hi")
        n_open = open_.count()
    return cold.unionByName(resolved)


def key_results(df: DataFrame, fields: dict[str, Column], member: Column, score: Column, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Per field and key: ``n_rows, n_members`` (distinct, nulls not counted), ``best_score`` and the quantiles.

    Quantile columns are named ``score_p50`` and so on. Rows are counted per key and member, and per key and score, with
    map-side partial aggregation, so a key's rows stay spread by member and by score. Null keys are dropped; null and NaN
    scores count as rows but not for the best score or quantiles.
    """
    s = F.when(F.isnan(score), None).otherwise(score)
    rows = key_rows(df, fields, member.alias("__m"), s.alias("__s"))
    per_member = rows.groupBy("field_name", "key_value", "__m").agg(F.count(F.lit(1)).alias("__n"), F.max("__s").alias("__best"))
    main = per_member.groupBy("field_name", "key_value").agg(F.sum("__n").alias("n_rows"), F.count("__m").alias("n_members"), F.max("__best").alias("best_score"))
    values = rows.filter(F.col("__s").isNotNull()).groupBy("field_name", "key_value", "__s").agg(F.count(F.lit(1)).alias("__c"))
    q = key_quantiles(values, ["field_name", "key_value"], "__s", "__c", quantiles)
    wide = q.groupBy("field_name", "key_value").agg(*[F.max(F.when(F.col("quantile") == float(x), F.col("value"))).alias(f"score_p{round(x * 100)}") for x in quantiles])
    return main.join(wide, ["field_name", "key_value"], "left")
