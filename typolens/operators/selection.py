"""Keyword candidates: merging generations, rules, context and slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.functions.domains import registrable_sld
from typolens.functions.keys import strip
from typolens.operators.report import TIERS, tier

MIN_LENGTH, MAX_LENGTH = 4, 20
INJECTED = "injected"


def normalize_token(c: Column) -> Column:
    """Trimmed, lower case, without blanks, hyphens and underscores."""
    return F.regexp_replace(F.lower(strip(c)), r"[\s\-_]+", "")


def merge_generations(items: DataFrame) -> DataFrame:
    """One candidate per brand and token from ``brand, generation, pos, keyword`` and further columns.

    ``confidence`` is high if all generations of the brand have the token; everything else comes from its first
    occurrence. Blank tokens are dropped. Aggregates only; the number of generations per brand is joined back.
    """
    extra = [c for c in items.columns if c not in ("brand", "generation", "pos", "keyword")]
    rows = items.withColumn("token", normalize_token(F.col("keyword"))).filter("token != ''")
    total = items.groupBy("brand").agg(F.count_distinct("generation").alias("__all"))
    first = F.struct("generation", "pos")
    merged = rows.groupBy("brand", "token").agg(F.count_distinct("generation").alias("__n"), F.min(first).alias("__first"), *[F.min_by(c, first).alias(c) for c in extra])
    return merged.join(total, "brand").select("brand", "token", F.when(F.col("__n") == F.col("__all"), "high").otherwise("low").alias("confidence"), F.col("__first.generation").alias("generation"), F.col("__first.pos").alias("pos"), *extra)


def drop_reason(token: Column, specificity: Column, kind: Column, blocked: Column) -> Column:
    """First rule that a candidate breaks, else null (repeats are judged separately)."""
    return (
        F.when(kind == "third_party_brand", "trap:third_party_brand")
        .when(specificity == "weak", "trap:weak")
        .when(specificity.isNull() | ~specificity.isin(list(TIERS)), F.concat(F.lit("unknown_specificity:"), F.coalesce(specificity, F.lit(""))))
        .when(~token.rlike("^[a-z0-9]+$"), "non_ascii_or_symbols")
        .when(~F.length(token).between(MIN_LENGTH, MAX_LENGTH), F.concat(F.lit("length:"), F.length(token).cast("string")))
        .when(blocked, "blocklist")
    )


def validate_candidates(rows: DataFrame, blocklist: list[str]) -> DataFrame:
    """Adds ``reason`` (null: kept) to ``brand, pos, token, specificity, kind``; the first kept occurrence of a token wins."""
    r = rows.withColumn("reason", drop_reason(F.col("token"), F.col("specificity"), F.col("kind"), F.col("token").isin([b.lower() for b in blocklist]) if blocklist else F.lit(False)))
    w = W.partitionBy("brand", "token", F.col("reason").isNull()).orderBy("pos")
    return r.withColumn("reason", F.when(F.col("reason").isNull() & (F.row_number().over(w) > 1), "duplicate").otherwise(F.col("reason")))


def inject_label(rows: DataFrame, brands: DataFrame) -> DataFrame:
    """Every brand's own label as a first-tier candidate: an existing one is promoted, a missing one put in front."""
    own = brands.select("brand", registrable_sld(F.col("brand")).alias("own")).distinct().filter("own != ''")
    marked = rows.join(own, "brand", "left")
    is_own = F.coalesce(F.col("token") == F.col("own"), F.lit(False))
    promoted = marked.withColumn("specificity", F.when(is_own, "brand_core").otherwise(F.col("specificity"))).withColumn("confidence", F.when(is_own, "high").otherwise(F.col("confidence"))).drop("own")
    missing = own.join(rows.select("brand", F.col("token").alias("own")), ["brand", "own"], "left_anti")
    added = missing.select("brand", F.col("own").alias("token"), F.lit("brand_core").alias("specificity"), F.lit("high").alias("confidence"), F.lit(-1).cast(dict(rows.dtypes)["pos"]).alias("pos"))
    return promoted.unionByName(added, allowMissingColumns=True)


def in_context(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """Adds whether the token stands in the brand's context block (lower case); no context, no hit."""
    c = contexts.select("brand", F.lower("context").alias("__c"))
    return rows.join(c, "brand", "left").withColumn("in_context", F.coalesce(F.contains("__c", F.col("token")), F.lit(False))).drop("__c")


def fill_slots(rows: DataFrame, slots: int, category_ratio: float = 0.5) -> DataFrame:
    """The candidates that fill a brand's slots, with ``slot``: tier, confidence and position decide.

    Category rows take at most ``int(slots * category_ratio)`` slots. As they are the last tier, two ranks are exact:
    one within category, one over what remains.
    """
    order = [tier(F.col("specificity")), F.when(F.col("confidence") == "high", 0).otherwise(1), F.col("pos"), F.col("token")]
    category = F.col("specificity") == "category_strong"
    w = W.partitionBy("brand", F.coalesce(category, F.lit(False))).orderBy(*order)
    capped = rows.withColumn("__c", F.row_number().over(w)).filter(~F.coalesce(category, F.lit(False)) | (F.col("__c") <= int(slots * category_ratio))).drop("__c")
    return capped.withColumn("slot", F.row_number().over(W.partitionBy("brand").orderBy(*order))).filter(F.col("slot") <= slots)


def direct_counts(rows: DataFrame) -> DataFrame:
    """``brand, n_direct``: candidates of the brand tiers that were not injected (``pos`` below 0)."""
    return rows.groupBy("brand").agg(F.count_if(F.col("specificity").isin("brand_core", "branded") & (F.col("pos") >= 0)).alias("n_direct"))
