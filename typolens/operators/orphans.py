"""References to records that do not exist (yet, or any more).

A parent key is valid at integer instants (microseconds). The sorted instants at which a key is valid are compressed
into contiguous runs ``[run_start, run_end)``; a reference at an instant is matched as-of to the preceding run start
of its key, and reported if it lies at or beyond the run's end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.operators.targets import with_ordinal

ALWAYS = "timestamp_ntz'9999-12-31 23:59:59.999999'"
NEVER = "timestamp_ntz'0001-01-01 00:00:00'"
_NO_TIME = "timestamp_ntz'9999-12-31 23:59:59.999998'"

#: Keys that the sketch tells apart; a key below one in so many of all references is never hot.
SKETCH_KEYS = 1_000
#: A key with more references than this is salted, with a salt for each so many of them.
ROWS_PER_SALT = 50_000


def _merge(df: DataFrame, by: list[str]) -> DataFrame:
    """Union of overlapping or touching intervals within ``by``: one row per contiguous run, numbered from 1."""
    w = W.partitionBy(*by).orderBy("run_start", "run_end")
    before = F.max("run_end").over(w.rowsBetween(W.unboundedPreceding, -1))
    marked = df.withColumn("__new", F.when(before.isNull() | (F.col("run_start") > before), 1).otherwise(0))
    numbered = marked.withColumn("run_no", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "run_no").agg(F.min("run_start").alias("run_start"), F.max("run_end").alias("run_end"))


def compress_runs(parents: DataFrame) -> DataFrame:
    """``parent, key, run_no, run_start, run_end`` from ``parent, key, valid_from, valid_to``.

    Rows without key are dropped; no ``valid_to`` means still valid; no ``valid_from`` means never loaded, and a row
    whose end is not after its start is an empty run (the key exists but is never valid). Runs are merged within a
    key and month first, so that the rows of a very frequent key are shared by many tasks.
    """
    rows = parents.filter(F.col("key").isNotNull()).select(
        "parent", "key",
        F.coalesce(F.col("valid_from").cast("timestamp_ntz"), F.expr(ALWAYS)).alias("run_start"),
        F.coalesce(F.col("valid_to").cast("timestamp_ntz"), F.expr(ALWAYS)).alias("run_end"),
    )
    rows = rows.withColumn("run_end", F.greatest("run_start", "run_end")).withColumn("__part", F.trunc("run_start", "month"))
    return _merge(_merge(rows, ["parent", "key", "__part"]).select("parent", "key", "run_start", "run_end"), ["parent", "key"])


def hot_references(refs: DataFrame, rows: int = ROWS_PER_SALT) -> list[tuple[str, str, int]]:
    """``(parent, key, salts)`` of keys that may have more than ``rows`` references, from a mergeable frequent-items sketch
    (at most ``SKETCH_KEYS``)."""
    k = SKETCH_KEYS
    got = refs.filter(F.col("key").isNotNull()).agg(F.expr(f"approx_top_k(concat(parent, '\\u0000', key), {k}, {k * 8})").alias("top")).first()
    return [(*x["item"].split("\0", 1), -(-x["count"] // rows)) for x in got["top"] or [] if x["count"] > rows]


def orphan_references(refs: DataFrame, parents: DataFrame, rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """``table_name, row_id, ref_field, ref_at, reason`` of every reference without a valid parent.

    ``refs`` has ``table_name, row_id, ref_field, parent, key, ref_at``; a null key is no reference. ``reason`` is
    ``missing`` (no row has the key), ``late`` (all were loaded after ``ref_at``) or ``deleted``. A reference without
    a time can only be ``missing``. Repeated references are all reported; an empty parent table makes every reference
    missing. References of hot keys are salted and the few runs of such a key are copied to each salt.
    """
    hot = hot_references(refs, rows_per_salt)
    hot_key = F.concat("parent", F.lit("\0"), "key").isin([f"{p}\0{k}" for p, k, _ in hot]) if hot else F.lit(False)
    salts = max((n for _, _, n in hot), default=1)
    runs = compress_runs(parents)
    never = F.struct(F.expr(NEVER).alias("at"), F.expr(NEVER).alias("run_end"))
    own = F.struct(F.col("run_start").alias("at"), F.col("run_end"))
    runs = runs.select("parent", "key", F.explode(F.when(F.col("run_no") == 1, F.array(never, own)).otherwise(F.array(own))).alias("r"))
    runs = runs.select("parent", "key", F.explode(F.when(hot_key, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))).alias("salt"), "r.at", "r.run_end", F.lit(0).alias("kind"))
    timed = F.coalesce(F.col("ref_at").cast("timestamp_ntz"), F.expr(_NO_TIME))
    asked = refs.filter(F.col("key").isNotNull()).select(
        "parent", "key", F.when(hot_key, F.pmod(F.xxhash64("row_id"), F.lit(salts)).cast("int")).otherwise(0).alias("salt"),
        timed.alias("at"), F.lit(1).alias("kind"), "table_name", "row_id", "ref_field", F.col("ref_at"),
    )
    w = W.partitionBy("parent", "key", "salt").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    lined = runs.unionByName(asked, allowMissingColumns=True).withColumn("run_end", F.last("run_end", ignorenulls=True).over(w)).filter("kind = 1")
    reason = (
        F.when(F.col("run_end").isNull(), "missing")
        .when(F.col("ref_at").isNull(), None)
        .when(F.col("run_end") == F.expr(NEVER), "late")
        .when(F.col("at") >= F.col("run_end"), "deleted")
    )
    return lined.select("table_name", "row_id", "ref_field", "ref_at", reason.alias("reason")).filter("reason IS NOT NULL")


def orphans_by_period(orphans: DataFrame) -> DataFrame:
    """Orphan counts per table, field, month and reason; references without a time have a null month."""
    month = F.date_format(F.col("ref_at"), "yyyy-MM")
    return orphans.groupBy("table_name", "ref_field", month.alias("month"), "reason").agg(F.count(F.lit(1)).alias("n_orphans"))


#: Keys of one block of runs: a power of two. A run counts once in each block that it covers.
BLOCK_BITS = 16


def integer_runs(parents: DataFrame, key: str = "key") -> DataFrame:
    """``run_start, run_end``: the distinct integer keys compressed into contiguous runs; nulls are no keys.

    Keys are numbered in order by a range sort. Along a run the key less its number stays the same, so one aggregation
    finds the runs, and a table of a billion consecutive keys becomes one row.
    """
    keys = parents.select(F.col(key).cast("long").alias("k")).filter("k IS NOT NULL").distinct()
    numbered = with_ordinal(keys, ["k"])
    return numbered.groupBy((F.col("k") - F.col("ordinal")).alias("g")).agg(F.min("k").alias("run_start"), F.max("k").alias("run_end")).drop("g")


def integer_orphans(refs: DataFrame, parents: DataFrame, key: str = "key", parent_key: str = "key") -> DataFrame:
    """The rows of ``refs`` whose integer ``key`` no row of ``parents`` has, with all their columns.

    Each distinct reference is matched as-of to the preceding run start, block by block of the key range, and lies beyond
    the run's end or is met. Null keys are no references; repeated references are all reported; without parents every
    reference is an orphan. Keys are made distinct before the match, so a frequent one costs a row.
    """
    block = lambda c: F.shiftright(c, BLOCK_BITS)
    runs = integer_runs(parents, parent_key).select(F.explode(F.sequence(block(F.col("run_start")), block(F.col("run_end")))).alias("block"), "run_start", "run_end")
    runs = runs.select("block", F.greatest("run_start", F.shiftleft("block", BLOCK_BITS)).alias("at"), F.lit(0).alias("kind"), "run_end")
    asked = refs.select(F.col(key).cast("long").alias("at")).filter("at IS NOT NULL").distinct()
    asked = asked.select(block(F.col("at")).alias("block"), "at", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("run_end"))
    w = W.partitionBy("block").orderBy("at", "kind").rowsBetween(W.unboundedPreceding, 0)
    met = runs.unionByName(asked).withColumn("run_end", F.last("run_end", ignorenulls=True).over(w)).filter("kind = 1")
    orphans = met.filter("run_end IS NULL OR at > run_end").select(F.col("at").alias("__orphan"))
    return refs.join(orphans, F.col(key).cast("long") == F.col("__orphan"), "left_semi")
