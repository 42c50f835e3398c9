"""Queries of the general data-quality operators, with the equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typolens.functions.keys import clean_value, normalize_domain, reference_key
from typolens.operators.dataset_diff import diff_copies
from typolens.operators.hot_keys import heavy_keys, key_results
from typolens.operators.orphans import integer_orphans, orphan_references, orphans_by_period
from typolens.session import table

GOLDEN_FIELDS = ["domain", "status", "source", "lang", "title", "content_chars", "error", "crawled_at"]


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"domain": normalize_domain(F.col("domain")), "run_no": F.col("run_no")}
    found = diff_copies(table(spark, sf_dir, "golden_base"), table(spark, sf_dir, "golden_cand"), keys, GOLDEN_FIELDS)
    return found.select("domain", F.col("run_no").cast("int").alias("run_no"), "finding")


def _references(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = table(spark, sf_dir, "match_rows").select(F.lit("match_rows").alias("table_name"), F.col("match_id").alias("row_id"), F.lit("keyword_misspelling").alias("ref_field"), F.lit("address").alias("parent"), reference_key(F.col("keyword_misspelling")).alias("key"), F.col("matched_at").alias("ref_at"))
    two = F.explode(F.array(*[F.struct(F.lit(f).alias("ref_field"), F.lit(p).alias("parent"), reference_key(F.col(f)).alias("key")) for f, p in (("target_address", "address"), ("target_hash", "target_hash"))]))
    t = table(spark, sf_dir, "target_data").select(F.lit("target_data").alias("table_name"), "row_id", two.alias("r"), F.col("report_at").alias("ref_at")).select("table_name", "row_id", "r.ref_field", "r.parent", "r.key", "ref_at")
    d = table(spark, sf_dir, "target_dump")
    keys = F.explode(F.array(*[F.struct(F.lit(p).alias("parent"), reference_key(F.col(p)).alias("key")) for p in ("address", "target_hash")]))
    parents = d.select(keys.alias("r"), F.col("loaded_at").alias("valid_from"), F.col("deleted_at").alias("valid_to")).select("r.parent", "r.key", "valid_from", "valid_to")
    return m.unionByName(t), parents


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphan_references(*_references(spark, sf_dir)).select("table_name", "row_id", "ref_field", "reason")


def p4_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans_by_period(orphan_references(*_references(spark, sf_dir)))


def p4_integer_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders none of whose lines was returned, by runs of integer keys."""
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    return integer_orphans(table(spark, sf_dir, "orders").select("o_orderkey"), returned, "o_orderkey", "l_orderkey")


def _match_keys() -> dict:
    return {f: clean_value(F.col(f)) for f in ("brand", "keyword")}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heavy_keys(table(spark, sf_dir, "match_rows"), _match_keys(), 0.02).select("field_name", "key_value")


def p5_key_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_results(table(spark, sf_dir, "match_rows"), _match_keys(), reference_key(F.col("keyword_misspelling")), F.col("final_score"), (0.5, 0.9)).withColumnRenamed("n_members", "n_misspellings")


WS = r"\t-\r\x1c-\x1f \x{0085}\x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def sql_strip(c: str, extra: str = "") -> str:
    return f"regexp_replace({c}, '^[{WS}{extra}]+|[{WS}]+$', '', 'g')"


def sql_key(c: str) -> str:
    return f"nullif(nullif(lower({sql_strip(c, r'\x{feff}')}), ''), 'nan')"


def sql_value(c: str) -> str:
    return f"nullif(lower({sql_strip(c)}), '')"


def sql_domain(c: str) -> str:
    v = f"lower({sql_strip(c)})"
    v = f"regexp_replace(case when {v} = 'nan' then '' else {v} end, '^.*?://', '')"
    return f"regexp_replace(regexp_replace({v}, '/.*$', '', 's'), '^www\\.', '')"


def _p1_sql() -> str:
    pick = lambda t: f"(select * from (select {sql_domain('domain')} k, run_no r, *, count(*) over (partition by {sql_domain('domain')}, run_no) n, row_number() over (partition by {sql_domain('domain')}, run_no) rn from {t}) where rn = 1)"
    both = f"{pick('golden_base')} b join {pick('golden_cand')} c on b.k is not distinct from c.k and b.r is not distinct from c.r"
    parts = [f"select b.k as domain, b.r as run_no, '{f}' as finding from {both} where b.{f} is distinct from c.{f}" for f in GOLDEN_FIELDS]
    parts.append(f"select b.k, b.r, 'copies' from {both} where b.n <> c.n")
    parts.append(f"select b.k, b.r, 'missing_in_candidate' from {pick('golden_base')} b where not exists (select 1 from golden_cand c where {sql_domain('c.domain')} is not distinct from b.k and c.run_no is not distinct from b.r)")
    parts.append(f"select c.k, c.r, 'missing_in_baseline' from {pick('golden_cand')} c where not exists (select 1 from golden_base b where {sql_domain('b.domain')} is not distinct from c.k and b.run_no is not distinct from c.r)")
    return "\nunion all\n".join(parts)


def _p4_refs_sql() -> str:
    return f"""
with refs as (
  select 'match_rows' as table_name, match_id as row_id, 'keyword_misspelling' as ref_field, 'address' as parent, {sql_key('keyword_misspelling')} as key, matched_at as ref_at from match_rows
  union all select 'target_data', row_id, 'target_address', 'address', {sql_key('target_address')}, report_at from target_data
  union all select 'target_data', row_id, 'target_hash', 'target_hash', {sql_key('target_hash')}, report_at from target_data),
parents as (
  select 'address' as parent, {sql_key('address')} as key, loaded_at, deleted_at from target_dump
  union all select 'target_hash', {sql_key('target_hash')}, loaded_at, deleted_at from target_dump),
judged as (
  select r.table_name, r.row_id, r.ref_field, r.ref_at, count(p.key) as n,
    count(*) filter (p.loaded_at <= r.ref_at) as n_loaded,
    count(*) filter (p.loaded_at <= r.ref_at and (p.deleted_at is null or p.deleted_at > r.ref_at)) as n_valid
  from refs r left join parents p on p.parent = r.parent and p.key = r.key
  where r.key is not null group by all),
orphans as (
  select table_name, row_id, ref_field, ref_at, case when n = 0 then 'missing' when n_loaded = 0 then 'late' else 'deleted' end as reason
  from judged where n_valid = 0)
"""


def _p5_sql() -> str:
    return f"with k as (select 'brand' as field_name, {sql_value('brand')} as key_value, {sql_key('keyword_misspelling')} as m, final_score as s from match_rows union all select 'keyword', {sql_value('keyword')}, {sql_key('keyword_misspelling')}, final_score from match_rows)"


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p4_found, p4_by_month, p4_integer_keys, p5_found, p5_key_results)}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": _p1_sql(),
        "p4_found": _p4_refs_sql() + "select table_name, row_id, ref_field, reason from orphans",
        "p4_by_month": _p4_refs_sql() + "select table_name, ref_field, strftime(ref_at, '%Y-%m') as month, reason, count(*) as n_orphans from orphans group by all",
        "p4_integer_keys": "select o_orderkey from orders where not exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')",
        "p5_found": _p5_sql() + " select field_name, key_value from k where key_value is not null group by all having count(*) >= 0.02 * (select count(*) from match_rows)",
        "p5_key_results": _p5_sql() + """,
v as (select field_name, key_value, s, row_number() over (partition by field_name, key_value order by s) as rn, count(*) over (partition by field_name, key_value) as c from k where key_value is not null and s is not null and not isnan(s)),
q as (select field_name, key_value, max(s) as best_score, max(case when rn = greatest(1, ceil(0.5 * c)) then s end) as score_p50, max(case when rn = greatest(1, ceil(0.9 * c)) then s end) as score_p90 from v group by all),
m as (select field_name, key_value, count(*) as n_rows, count(distinct m) as n_misspellings from k where key_value is not null group by all)
select m.field_name, m.key_value, m.n_rows, m.n_misspellings, q.best_score, q.score_p50, q.score_p90 from m left join q using (field_name, key_value)""",
    }
