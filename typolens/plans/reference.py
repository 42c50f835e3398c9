"""Queries of the typo pipeline itself, with the equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from typolens.functions import permute
from typolens.functions.domains import SUFFIXES, address_matching_sld, registrable_domain, registrable_sld
from typolens.functions.keys import normalize_domain, strip
from typolens.functions.phonetic import phonetic_code_udf
from typolens.functions.textdist import QWERTY_NEIGHBOURS, dice_bigram, edit_threshold, qwerty_substitutions
from typolens.operators import crawl, evaluate, match, report, selection, targets
from typolens.operators.dataset_diff import multiset_diff
from typolens.plans.problems import sql_domain, sql_strip
from typolens.session import table
from typolens.sources.html import parse_pages
from typolens.sources.readers import blocklist_words

SOURCE_ORDER = ["plain_http", "web_scraper", "common_crawl", "wayback_machine"]
_Q: dict = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        _Q[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return keep


# ---------------------------------------------------------------- matcher

_NULLISH = "('', 'nan', 'na', 'null', 'none', 'n/a', '<na>', '#n/a')"
_CLEAN_BRANDS = f"""select * from brand_keywords where lower({sql_strip('brand_domain')}) not in {_NULLISH} and lower({sql_strip('keyword')}) not in {_NULLISH}
  and contains(brand_domain, '.') and length(brand_domain) <= 35"""


@_query(f"select brand_domain, keyword, specificity from ({_CLEAN_BRANDS})")
def clean_brands(spark: SparkSession, d: str) -> DataFrame:
    return match.clean_brands(table(spark, d, "brand_keywords")).select("brand_domain", "keyword", "specificity")


_CLEAN_ADDRESSES = f"""select distinct address from (select {sql_strip('address')} as address from target_dump)
  where lower(address) not in {_NULLISH} and length(address) <= 35 and regexp_full_match(address, '[a-zA-Z0-9.-]+')
  and not (length(address) >= 3 and address[1] = address[2] and address[2] = address[3]) and not contains(address, '--')"""


@_query(_CLEAN_ADDRESSES)
def clean_addresses(spark: SparkSession, d: str) -> DataFrame:
    return match.clean_addresses(table(spark, d, "target_dump").select(strip(F.col("address")).alias("address")))


@_query(f"select distinct domain, {sql_domain('domain')} as normalized from golden_base")
def normalized_domains(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "golden_base").select("domain", normalize_domain(F.col("domain")).alias("normalized")).distinct()


_SUFFIX_RE = "|".join(s.replace(".", "\\.") for s in sorted(set(SUFFIXES), key=lambda s: (-s.count("."), s)))


def _sql_parts(host: str, group: int) -> str:
    return f"case when {host} in ({', '.join(repr(s.replace(chr(92), '')) for s in _SUFFIX_RE.split('|'))}) then '' else regexp_extract({host}, '^(?:(.+?)\\.)??([^.]+)\\.({_SUFFIX_RE})$', {group}) end"


def _sql_sld(c: str) -> str:
    host = f"lower({sql_strip(c)})"
    return f"case when not contains({host}, '.') then {host} when ({_sql_parts(host, 1)}) = '' then {_sql_parts(host, 2)} else '' end"


_DOMAINS_SQL = f"""with a as (select distinct {sql_strip('address')} as address from target_dump)
select address, {_sql_sld('address')} as matching_sld,
  case when not contains({sql_domain('address')}, '.') then {sql_domain('address')} when ({_sql_parts(sql_domain('address'), 2)}) <> '' then {_sql_parts(sql_domain('address'), 2)} else split_part({sql_domain('address')}, '.', 1) end as sld,
  case when ({_sql_parts(sql_domain('address'), 2)}) <> '' then ({_sql_parts(sql_domain('address'), 2)}) || '.' || ({_sql_parts(sql_domain('address'), 3)}) else {sql_domain('address')} end as registrable
from a"""


@_query(_DOMAINS_SQL)
def registrable_domains(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "target_dump").select(strip(F.col("address")).alias("address")).distinct()
    return a.select("address", address_matching_sld(F.col("address")).alias("matching_sld"), registrable_sld(F.col("address")).alias("sld"), registrable_domain(F.col("address")).alias("registrable"))


_TOKENS = f"tokens as (select distinct token from (select {{sld}} as token from ({_CLEAN_BRANDS})) where token <> '')".replace("{sld}", f"case when not contains({sql_domain('keyword')}, '.') then {sql_domain('keyword')} when ({_sql_parts(sql_domain('keyword'), 2)}) <> '' then {_sql_parts(sql_domain('keyword'), 2)} else split_part({sql_domain('keyword')}, '.', 1) end")
_SLDS = f"slds as (select distinct address_sld from (select {_sql_sld('address')} as address_sld from ({_CLEAN_ADDRESSES})) where address_sld <> '')"
_LIMIT = "case when length(token) >= 6 then 2 when length(token) >= 4 then 1 else 0 end"
_PAIRS = f"{_TOKENS}, {_SLDS}, pairs as (select token, address_sld, cast(damerau_levenshtein(token, address_sld) as integer) as distance from tokens, slds where abs(length(token) - length(address_sld)) <= 2 and damerau_levenshtein(token, address_sld) <= {_LIMIT})"


@_query(f"with {_TOKENS} select token, cast(length(token) as integer) as n_chars, {_LIMIT} as max_distance from tokens")
def length_threshold(spark: SparkSession, d: str) -> DataFrame:
    t = match.keyword_dimension(table(spark, d, "brand_keywords")).select("token").distinct().filter("token != ''")
    return t.select("token", F.length("token").alias("n_chars"), edit_threshold(F.length("token")).alias("max_distance"))


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return match.keyword_dimension(table(spark, d, "brand_keywords")), match.inventory(table(spark, d, "target_dump"))


@_query(f"with {_PAIRS} select token, address_sld, distance from pairs")
def fuzzy_match(spark: SparkSession, d: str) -> DataFrame:
    return match.fuzzy_pairs(*_sides(spark, d))


_NEAR_SQL = "case token[i] " + " ".join(f"when '{k}' then '{v}'" for k, v in QWERTY_NEIGHBOURS.items()) + " else '' end"
_QWERTY = f"(select count(*) from unnest(range(1, least(length(token), length(address_sld)) + 1)) t(i) where contains({_NEAR_SQL}, address_sld[i]))"
_GRAMS = lambda c: f"list_distinct([{c}[i:i+1] for i in range(1, length({c}))])"


@_query(f"""with {_PAIRS}, q as (select token, address_sld, distance, least(cast({_QWERTY} as integer), distance) as qwerty_subs from pairs)
select token, address_sld, distance, qwerty_subs, round(1.0 - (distance::double - 0.4::double * qwerty_subs::double) / greatest(length(token), length(address_sld))::double, 4) as base_score,
  round(case when len({_GRAMS('token')}) + len({_GRAMS('address_sld')}) = 0 then 1.0 else 2.0 * len(list_intersect({_GRAMS('token')}, {_GRAMS('address_sld')}))::double / (len({_GRAMS('token')}) + len({_GRAMS('address_sld')}))::double end, 4) as score_dice,
  round(jaro_winkler_similarity(token, address_sld), 4) as score_jarowinkler from q""")
def fuzzy_scores(spark: SparkSession, d: str) -> DataFrame:
    s = match.score_pairs(match.fuzzy_pairs(*_sides(spark, d)), phonetic=False)
    return s.select("token", "address_sld", "distance", "qwerty_subs", F.col("final_score").alias("base_score"), "score_dice", "score_jarowinkler")


def _sql_swaps(table: dict[str, list[str]]) -> str:
    """Each character replaced by each one that the table has for it."""
    to = "case token[i] " + " ".join(f"when '{k}' then [{', '.join(map(repr, v))}]" for k, v in table.items() if v) + " else [] end"
    return f"flatten([[token[:i-1] || c || token[i+1:] for c in {to}] for i in range(1, length(token) + 1)])"


def _sql_glyph(src: str, dst: str) -> str:
    return f"[token[:i-1] || '{dst}' || token[i+{len(src)}:] for i in range(1, length(token) + 1) if token[i:i+{len(src) - 1}] = '{src}']"


_CLASS_SQL = {
    "omission": "[token[:i-1] || token[i+1:] for i in range(1, length(token) + 1)]",
    "transposition": "[token[:i-1] || token[i+1] || token[i] || token[i+2:] for i in range(1, length(token)) if token[i] <> token[i+1]]",
    "qwerty_sub": _sql_swaps({k: [x for x in v if x in permute.ALLOWED] for k, v in QWERTY_NEIGHBOURS.items()}),
    "homoglyph": "flatten([" + ", ".join(_sql_glyph(x, y) for x, y in permute.HOMOGLYPHS) + "])",
    "doubling": "[token[:i] || token[i:] for i in range(1, length(token) + 1)]",
    "hyphenation": "[token[:i] || '-' || token[i+1:] for i in range(1, length(token))]",
    "vowel_swap": _sql_swaps({v: [x for x in "aeiou" if x != v] for v in "aeiou"}),
    "bitsquat": _sql_swaps({c: [x for x in permute.ALLOWED if (ord(x) ^ ord(c)).bit_count() == 1] for c in permute.ALLOWED}),
}
_ALL_TOKENS = _TOKENS.replace("where token <> ''", "")
_VARIANTS = "variants as (select token, variant, arg_min(c, r) as generated_class from (" + " union all ".join(f"select token, unnest({sql}) as variant, '{c}' as c, {k} as r from tokens" for k, (c, sql) in enumerate(_CLASS_SQL.items())) + ") where variant <> token and regexp_full_match(variant, '[a-z0-9-]{3,}') and variant[1] <> '-' and variant[-1] <> '-' group by token, variant)"
_PROBE = f"{_VARIANTS}, probe as (select token, variant as address_sld, generated_class from variants where variant in (select address_sld from slds))"


@_query(f"with {_ALL_TOKENS}, {_VARIANTS} select token, variant, generated_class from variants")
def generated_variants(spark: SparkSession, d: str) -> DataFrame:
    return match.generated_variants(_sides(spark, d)[0])


@_query(f"with {_ALL_TOKENS}, {_SLDS}, {_PROBE} select token, address_sld, generated_class from probe")
def generated_probe(spark: SparkSession, d: str) -> DataFrame:
    return match.generated_pairs(*_sides(spark, d))


@_query()
def match_inventory(spark: SparkSession, d: str) -> DataFrame:
    return match.match_inventory(*_sides(spark, d))


_SLD_OF_KW = f"case when not contains({sql_domain('keyword')}, '.') then {sql_domain('keyword')} when ({_sql_parts(sql_domain('keyword'), 2)}) <> '' then {_sql_parts(sql_domain('keyword'), 2)} else split_part({sql_domain('keyword')}, '.', 1) end"


@_query(f"""with {_PAIRS}, k as (select distinct lower({sql_strip('brand_domain')}) as brand, lower({sql_strip('keyword')}) as keyword, {_SLD_OF_KW} as token from ({_CLEAN_BRANDS})),
a as (select address, {_sql_sld('address')} as address_sld from ({_CLEAN_ADDRESSES})),
reg as (select *, case when ({_sql_parts(sql_domain('brand'), 2)}) <> '' then ({_sql_parts(sql_domain('brand'), 2)}) || '.' || ({_sql_parts(sql_domain('brand'), 3)}) else {sql_domain('brand')} end as own,
  case when ({_sql_parts(sql_domain('address'), 2)}) <> '' then ({_sql_parts(sql_domain('address'), 2)}) || '.' || ({_sql_parts(sql_domain('address'), 3)}) else {sql_domain('address')} end as other
  from pairs join k using (token) join a using (address_sld))
select case when own = other then 'self' when distance = 0 then 'exact_other_tld' when starts_with(address_sld, token) and length(address_sld) > length(token) then 'affix' else 'misspelling' end as match_type, count(*) as n, count(distinct brand) as n_brands from reg group by 1""")
def match_taxonomy(spark: SparkSession, d: str) -> DataFrame:
    k, a = _sides(spark, d)
    return match.taxonomy(match.fuzzy_pairs(k, a), k, a)


_REGISTRABLE = lambda c: f"case when ({_sql_parts(sql_domain(c), 2)}) <> '' then ({_sql_parts(sql_domain(c), 2)}) || '.' || ({_sql_parts(sql_domain(c), 3)}) else {sql_domain(c)} end"
_LAST = lambda c: f"case when contains({c}, '.') then lower(split_part({c}, '.', -1)) else '' end"


@_query(f"""with {_PAIRS}, {_PROBE},
joint as (select token, address_sld, distance, null as generated_class from pairs union all
  select token, address_sld, cast(damerau_levenshtein(token, address_sld) as integer), generated_class from probe where not exists (select 1 from pairs p where p.token = probe.token and p.address_sld = probe.address_sld)),
q as (select *, least(cast({_QWERTY} as integer), distance) as qwerty_subs from joint),
k as (select distinct lower({sql_strip('brand_domain')}) as brand, lower({sql_strip('keyword')}) as keyword, {_SLD_OF_KW} as token from ({_CLEAN_BRANDS})),
a as (select address, {_sql_sld('address')} as address_sld from ({_CLEAN_ADDRESSES})),
r as (select *, {_REGISTRABLE('brand')} as own, {_REGISTRABLE('address')} as other from q join k using (token) join a using (address_sld))
select brand, keyword, address as keyword_misspelling,
  case when generated_class is not null then 'generated' when own = other then 'self' when distance = 0 then 'exact_other_tld' when starts_with(address_sld, token) and length(address_sld) > length(token) then 'affix' else 'misspelling' end as match_type,
  generated_class, distance, qwerty_subs, {_LAST('address')} = {_LAST('brand')} as tld_match,
  round(1.0 - (distance::double - 0.4::double * qwerty_subs::double) / greatest(length(token), length(address_sld))::double, 4) as final_score,
  round(jaro_winkler_similarity(token, address_sld), 4) as score_jarowinkler,
  round(case when len({_GRAMS('token')}) + len({_GRAMS('address_sld')}) = 0 then 1.0 else 2.0 * len(list_intersect({_GRAMS('token')}, {_GRAMS('address_sld')}))::double / (len({_GRAMS('token')}) + len({_GRAMS('address_sld')}))::double end, 4) as score_dice from r""")
def match_inventory_plain(spark: SparkSession, d: str) -> DataFrame:
    """The whole matcher without the phonetic factor, which SQL has no function for."""
    return match.match_inventory(*_sides(spark, d), phonetic=False).drop("phonetic_match")


#: Words with the primary code of the published algorithm.
_PINS = {"smith": "SM0", "schmidt": "XMT", "thumb": "0M", "knight": "NT", "night": "NT", "xavier": "SF", "caesar": "SSR", "wright": "RT", "pneumonia": "NMN", "phone": "FN", "church": "XRX", "judge": "JJ", "cough": "KF", "laugh": "LF", "thomas": "TMS", "zebra": "SPR", "gnome": "NM", "psalm": "SLM", "quick": "KK", "vision": "FSN"}


@_query("select * from (values " + ", ".join(f"('{w}', '{c}')" for w, c in _PINS.items()) + ") t(word, code)")
def phonetic_pins(spark: SparkSession, d: str) -> DataFrame:
    return spark.createDataFrame([(w,) for w in _PINS], "word string").withColumn("code", phonetic_code_udf("word"))


@_query()
def phonetic_codes(spark: SparkSession, d: str) -> DataFrame:
    return _sides(spark, d)[0].select("token").distinct().withColumn("code", phonetic_code_udf("token"))


@_query("""select brand, keyword, keyword_misspelling, match_id, rank from (select *, row_number() over (partition by brand, keyword order by final_score desc nulls last, distance asc nulls last, score_jarowinkler desc nulls last,
  lower(keyword_misspelling) asc nulls last, keyword_misspelling asc nulls last, match_id) as rank from (select brand, keyword, keyword_misspelling, match_id, case when isnan(final_score) then null else final_score end as final_score, distance, score_jarowinkler from match_rows)) where rank <= 3""")
def topn_per_pair(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "match_rows").withColumn("final_score", F.when(~F.isnan("final_score"), F.col("final_score")))
    return match.top_per_pair(m, 3, tie="match_id").select("brand", "keyword", "keyword_misspelling", "match_id", F.col("rank").cast("long").alias("rank"))


@_query("select brand, keyword, keyword_misspelling, match_id from match_rows where brand is not null and keyword is not null")
def canonical_order(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "match_rows").filter("brand IS NOT NULL AND keyword IS NOT NULL")
    return m.orderBy(*match.canonical_order(), "match_id").select("brand", "keyword", "keyword_misspelling", "match_id")


@_query("select count(*) as n_rows, count(distinct lower(keyword)) as n_keywords, count(*) filter (match_type = 'generated') as n_generated from match_rows")
def matcher_stats(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "match_rows").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.lower("keyword")).alias("n_keywords"), F.count_if(F.col("match_type") == "generated").alias("n_generated"))


# ---------------------------------------------------------------- targets

def _sql_dump_key(c: str) -> str:
    v = f"lower({sql_strip(f'regexp_replace({c}, {chr(39)}^[\\x{{feff}}]+{chr(39)}, {chr(39)}{chr(39)})')})"
    return f"nullif(nullif({v}, ''), 'nan')"


_LOOKUP = f"lookup as (select match_id as pos, {_sql_dump_key('keyword_misspelling')} as key from match_rows)"
_DUMP = f"dump as (select dump_no as dump_pos, {_sql_dump_key('address')} as key, target_id, coalesce(feed, '') as feed from target_dump where trim(target_id) <> '')"


def _lookup(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    left = table(spark, d, "match_rows").select(F.col("match_id").alias("pos"), F.col("keyword_misspelling").alias("address"))
    return left, table(spark, d, "target_dump").select(F.col("dump_no").alias("dump_pos"), "address", "target_id", "feed")


@_query(f"with {_LOOKUP}, {_DUMP} select pos, dump_pos, target_id, feed from lookup join dump using (key)")
def target_multimap(spark: SparkSession, d: str) -> DataFrame:
    return targets.target_multimap(*_lookup(spark, d)).select("pos", "dump_pos", "target_id", "feed")


@_query(f"with {_LOOKUP}, {_DUMP} select target_id, feed from (select *, row_number() over (partition by target_id order by pos, dump_pos) as r from lookup join dump using (key)) where r = 1")
def target_first_by_id(spark: SparkSession, d: str) -> DataFrame:
    return targets.first_by_id(targets.target_multimap(*_lookup(spark, d)))


@_query(f"with {_LOOKUP}, {_DUMP} select key, count(*) as n from lookup where key is not null and key not in (select key from dump where key is not null) group by key")
def unmatched_keys(spark: SparkSession, d: str) -> DataFrame:
    return targets.unmatched_keys(*_lookup(spark, d))


@_query(f"with {_DUMP} select key, count(*) as n_pairs from dump where key is not null group by key having count(*) > 1")
def multi_feed_addresses(spark: SparkSession, d: str) -> DataFrame:
    return targets.multi_feed_addresses(_lookup(spark, d)[1])


@_query("""with f as (select trim(target_id) as target_id, feed, row_number() over (partition by trim(target_id) order by dump_no desc) as r from target_dump where trim(target_id) <> '' and feed is not null)
select t.row_id, t.target_id, coalesce(f.feed, '') as feed from target_data t left join f on f.target_id = t.target_id and f.r = 1""")
def feed_enrich(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "target_dump").select("target_id", "feed", F.col("dump_no").alias("pos"), F.when(F.col("feed").isNull(), "Search").otherwise(" Domain").alias("traffic_type"))
    return targets.enrich_feed(table(spark, d, "target_data").select("row_id", "target_id"), targets.feed_by_id(ids)).select("row_id", "target_id", "feed")


@_query("select target_id, row_number() over (order by target_id) - 1 as ordinal, cast(floor((row_number() over (order by target_id) - 1) / 1000) as bigint) as batch_id from (select distinct target_id from target_data where target_id is not null)")
def request_batches(spark: SparkSession, d: str) -> DataFrame:
    ids = table(spark, d, "target_data").select("target_id").filter("target_id IS NOT NULL").distinct()
    return targets.request_batches(ids, ["target_id"], 1000).select("target_id", F.col("ordinal").cast("long").alias("ordinal"), "batch_id")


# ---------------------------------------------------------------- report

_BEST = f"""best as (select * from (select *, lower({sql_strip('keyword_misspelling')}) as key, row_number() over (partition by brand, lower({sql_strip('keyword_misspelling')}) order by final_score desc nulls last, distance asc nulls last, score_jarowinkler desc nulls last, keyword asc nulls last, match_id) as r
  from (select match_id, brand, keyword, specificity, keyword_misspelling, match_type, case when isnan(final_score) then null else final_score end as final_score, distance, score_jarowinkler from match_rows)) where r = 1)"""


def _best(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "match_rows").select("match_id", "brand", "keyword", "specificity", "keyword_misspelling", "match_type", F.when(~F.isnan("final_score"), F.col("final_score")).alias("final_score"), "distance", "score_jarowinkler")
    return report.best_per_brand(m)


@_query(f"with {_BEST} select brand, key, match_id from best")
def brand_dedup(spark: SparkSession, d: str) -> DataFrame:
    return _best(spark, d).select("brand", "key", "match_id")


_JOINED = f"joined as (select t.row_id, b.match_id, b.brand, b.keyword, b.specificity, b.keyword_misspelling, b.match_type, b.final_score, try_cast(trim(t.total_visits) as double) as visits, t.avg_cost from (select *, lower({sql_strip('target_address')}) as key from target_data) t join best b using (key))"


def _joined(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "target_data").select("row_id", "target_address", report.as_number(F.col("total_visits")).alias("visits"), "avg_cost")
    return report.join_traffic(_best(spark, d), t)


@_query(f"with {_BEST}, {_JOINED} select row_id, match_id, brand, visits from joined")
def report_join(spark: SparkSession, d: str) -> DataFrame:
    return _joined(spark, d).select("row_id", "match_id", "brand", "visits")


@_query(f"with {_BEST}, {_JOINED} select brand, keyword, specificity, keyword_misspelling, row_id, case specificity when 'brand_core' then 0 when 'branded' then 1 when 'category_strong' then 2 else 9 end as tier, visits from joined")
def client_report(spark: SparkSession, d: str) -> DataFrame:
    rows = _joined(spark, d).withColumn("tier", report.tier(F.col("specificity")))
    return rows.orderBy(*report.client_order(), "row_id").select("brand", "keyword", "specificity", "keyword_misspelling", "row_id", "tier", "visits")


@_query(f"""with {_BEST}, {_JOINED}, popular as (select distinct domain from (select lower({sql_domain('domain')}) as domain from golden_base where status = 'success'))
select match_type, case when p.domain is not null then true else false end as is_popular, count(*) as n, count(distinct brand) as n_brands from joined j left join popular p on p.domain = {sql_domain('j.keyword_misspelling')} group by all""")
def cut_histogram(spark: SparkSession, d: str) -> DataFrame:
    popular = table(spark, d, "golden_base").filter("status = 'success'").select(normalize_domain(F.col("domain")).alias("domain"))
    rows = report.popular_flag(_joined(spark, d), popular, normalize_domain(F.col("keyword_misspelling")))
    return rows.groupBy("match_type", "is_popular").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("brand").alias("n_brands"))


_CELLS = ", ' | ', ".join(f"coalesce(cast({c} as varchar), '')" for c in ("keyword_misspelling", "visits", "final_score", "match_type"))


@_query(f"""with {_BEST}, {_JOINED}, n as (select *, row_number() over (order by brand, keyword, specificity, keyword_misspelling nulls first, line) - 1 as o from
  (select brand, keyword, specificity, keyword_misspelling, concat('| ', {_CELLS}, ' |') as line from joined where brand is not null and keyword is not null and specificity is not null)),
p as (select brand, keyword, specificity, o // 1000 as p, string_agg(line, chr(10) order by o) as t from n group by all),
q as (select *, row_number() over (partition by brand, keyword, specificity order by p) as part from p)
select brand, keyword, specificity, cast(part as integer) as part, case when part = 1 then '| misspelling | visits | score | match |' || chr(10) || '|---|---|---|---|' || chr(10) else '' end || t as table from q""".replace("as table from q", 'as "table" from q'))
def grouped_markdown(spark: SparkSession, d: str) -> DataFrame:
    return report.grouped_markdown(_joined(spark, d))


# ---------------------------------------------------------------- keyword selection

_ITEMS = f"""items as (select lower({sql_strip('brand_domain')}) as brand, case when in_context = 'Yes' then 1 else 2 end as generation, lower({sql_strip('keyword')}) as keyword, min(specificity) as specificity from brand_keywords
  where brand_domain is not null and keyword is not null group by all),
posed as (select *, row_number() over (partition by brand, generation order by keyword) as pos from items),
tok as (select *, regexp_replace(keyword, '[\\s\\-_]+', '', 'g') as token from posed),
merged as (select brand, token, case when count(distinct generation) = any_value(n_all) then 'high' else 'low' end as confidence, arg_min(struct_pack(g := generation, p := pos, s := specificity), generation * 1000000 + pos) as f
  from tok join (select brand, count(distinct generation) as n_all from posed group by brand) using (brand) where token <> '' group by brand, token),
cand as (select brand, token, confidence, f.g as generation, f.p as pos, f.s as specificity from merged)"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    k = table(spark, d, "brand_keywords").filter("brand_domain IS NOT NULL AND keyword IS NOT NULL")
    rows = k.groupBy(F.lower(strip(F.col("brand_domain"))).alias("brand"), F.when(F.col("in_context") == "Yes", 1).otherwise(2).alias("generation"), F.lower(strip(F.col("keyword"))).alias("keyword")).agg(F.min("specificity").alias("specificity"))
    return rows.withColumn("pos", F.row_number().over(W.partitionBy("brand", "generation").orderBy("keyword")).cast("long"))


@_query(f"with {_ITEMS} select brand, token, confidence, generation, pos, specificity from cand")
def merge_generations(spark: SparkSession, d: str) -> DataFrame:
    return selection.merge_generations(_items(spark, d)).select("brand", "token", "confidence", "generation", "pos", "specificity")


_BLOCKED = ", ".join(f"'{w}'" for w in blocklist_words())
_REASON = f"""case when specificity = 'weak' then 'trap:weak' when specificity is null or specificity not in ('brand_core', 'branded', 'category_strong') then 'unknown_specificity:' || coalesce(specificity, '')
  when not regexp_full_match(token, '[a-z0-9]+') then 'non_ascii_or_symbols' when length(token) not between 4 and 20 then 'length:' || length(token) when token in ({_BLOCKED}) then 'blocklist' end"""


@_query(f"""with {_ITEMS}, r as (select brand, generation, pos, token, specificity, {_REASON} as reason from tok)
select brand, generation, pos, token, case when reason is null and row_number() over (partition by brand, token, reason is null order by generation * 1000000 + pos) > 1 then 'duplicate' else reason end as reason from r""")
def validate_candidates(spark: SparkSession, d: str) -> DataFrame:
    rows = _items(spark, d).select("brand", "generation", F.col("pos").alias("p"), (F.col("generation") * 1000000 + F.col("pos")).alias("pos"), selection.normalize_token(F.col("keyword")).alias("token"), "specificity", F.lit("product").alias("kind"))
    return selection.validate_candidates(rows, blocklist_words()).select("brand", "generation", F.col("p").alias("pos"), "token", "reason")


def _candidates(spark: SparkSession, d: str) -> DataFrame:
    c = selection.merge_generations(_items(spark, d))
    return selection.inject_label(c, c.select("brand").distinct())


_OWN = f"own as (select distinct brand, case when not contains({sql_domain('brand')}, '.') then {sql_domain('brand')} when ({_sql_parts(sql_domain('brand'), 2)}) <> '' then {_sql_parts(sql_domain('brand'), 2)} else split_part({sql_domain('brand')}, '.', 1) end as own from cand)"
_INJECTED = f"""{_OWN}, inj as (select c.brand, token, case when token = own then 'brand_core' else specificity end as specificity, case when token = own then 'high' else confidence end as confidence, generation * 1000000 + pos as pos from cand c join own using (brand)
  union all select brand, own, 'brand_core', 'high', -1 from own o where own <> '' and not exists (select 1 from cand c where c.brand = o.brand and c.token = o.own))"""


@_query(f"with {_ITEMS}, {_INJECTED} select brand, token, specificity, confidence, pos from inj")
def inject_label(spark: SparkSession, d: str) -> DataFrame:
    c = selection.merge_generations(_items(spark, d)).withColumn("pos", F.col("generation") * 1000000 + F.col("pos"))
    return selection.inject_label(c, c.select("brand").distinct()).select("brand", "token", "specificity", "confidence", F.col("pos").cast("long").alias("pos"))


@_query(f"""with {_ITEMS}, {_INJECTED}, o as (select *, case specificity when 'brand_core' then 0 when 'branded' then 1 when 'category_strong' then 2 else 9 end as tier, case when confidence = 'high' then 0 else 1 end as c, coalesce(specificity = 'category_strong', false) as cat from inj),
capped as (select * from (select *, row_number() over (partition by brand, cat order by tier, c, pos, token) as k from o) where not cat or k <= 4)
select brand, token, slot from (select brand, token, row_number() over (partition by brand order by tier, c, pos, token) as slot from capped) where slot <= 8""")
def fill_slots(spark: SparkSession, d: str) -> DataFrame:
    c = selection.merge_generations(_items(spark, d)).withColumn("pos", F.col("generation") * 1000000 + F.col("pos"))
    return selection.fill_slots(selection.inject_label(c, c.select("brand").distinct()), 8).select("brand", "token", F.col("slot").cast("long").alias("slot"))


@_query(f"with {_ITEMS}, {_INJECTED} select brand, count(*) filter (specificity in ('brand_core', 'branded') and pos >= 0) as n_direct from inj group by brand")
def direct_counts(spark: SparkSession, d: str) -> DataFrame:
    return selection.direct_counts(_candidates(spark, d))


# ---------------------------------------------------------------- crawl

def _sql_any(low: str, phrases: list[str]) -> str:
    return "(" + " or ".join("contains({}, '{}')".format(low, p.replace("'", "''")) for p in phrases) + ")"


_TEXT = "concat_ws(' ', coalesce(title, ''), coalesce(meta_description, ''), coalesce(main_content, ''))"
_CLASS = "case " + " ".join(f"when {_sql_any(f'lower({_TEXT})', p)} then '{n}'" for n, p in crawl.QUALITY_CLASSES) + f" when length({sql_strip(f'lower({_TEXT})')}) < 100 then 'thin' else 'ok' end"
_GATE = f"case when status is not distinct from 'success' then {_CLASS} else 'status:' || coalesce(status, '') end"


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "crawl_pages")


@_query(f"select page_id, {_GATE} as reason from crawl_pages")
def quality_gate(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).select("page_id", crawl.gate_reason().alias("reason"))


@_query(f"select source, {_GATE} as reason, count(*) as n from crawl_pages group by all")
def gate_counters(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).groupBy("source", crawl.gate_reason().alias("reason")).agg(F.count(F.lit(1)).alias("n"))


_STATUS = "case status when 'success' then 200 when 'blocked' then 403 when 'error' then 500 else null end"


@_query(f"select page_id, ({_STATUS} is null or {_STATUS} in (403, 406, 409, 429, 500, 502, 503, 520) or length({sql_strip('coalesce(main_content, chr(32))')}) < 300 or {_sql_any('lower(coalesce(main_content, chr(32)))', crawl.JS_REQUIRED + crawl.BOT_PROTECTION)}) as escalate from crawl_pages")
def escalation(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("status") == "success", 200).when(F.col("status") == "blocked", 403).when(F.col("status") == "error", 500)
    return _pages(spark, d).select("page_id", crawl.should_escalate(status, F.col("main_content")).alias("escalate"))


@_query("select page_id, date_diff('day', cast(crawled_at as date), date '2026-09-01') <= 60 as fresh from crawl_pages")
def snapshot_freshness(spark: SparkSession, d: str) -> DataFrame:
    stamp = F.date_format("crawled_at", "yyyyMMddHHmmss")
    return _pages(spark, d).select("page_id", crawl.fresh_snapshot(stamp, F.lit("2026-09-01").cast("date"), 60).alias("fresh"))


@_query(f"""select domain, source, page_id from (select {sql_domain('domain')} as domain, source, page_id, row_number() over (partition by {sql_domain('domain')} order by list_position(['plain_http', 'web_scraper', 'common_crawl', 'wayback_machine'], source), crawled_at, page_id) as r
  from crawl_pages where {_GATE} = 'ok' and source in ('plain_http', 'web_scraper', 'common_crawl', 'wayback_machine') and {sql_domain('domain')} <> '') where r = 1""")
def tier_cascade(spark: SparkSession, d: str) -> DataFrame:
    return crawl.cascade(_pages(spark, d), SOURCE_ORDER, crawl.gate_reason() == "ok", [F.col("crawled_at"), F.col("page_id")]).select("domain", "source", "page_id")


@_query(f"select domain, page_id from (select {sql_domain('domain')} as domain, page_id, row_number() over (partition by {sql_domain('domain')} order by page_id) as r from crawl_pages where {_GATE} = 'ok' and {sql_domain('domain')} <> '') where r = 1")
def first_good_page(spark: SparkSession, d: str) -> DataFrame:
    return crawl.first_good(_pages(spark, d), crawl.gate_reason() == "ok", [F.col("page_id")]).select("domain", "page_id")


@_query(f"select distinct {sql_domain('brand_domain')} as domain from brand_keywords where {sql_domain('brand_domain')} <> '' and {sql_domain('brand_domain')} not in (select {sql_domain('domain')} from crawl_pages where domain is not null and {_GATE} = 'ok')")
def unresolved_brands(spark: SparkSession, d: str) -> DataFrame:
    good = _pages(spark, d).filter(crawl.gate_reason() == "ok").select("domain")
    return crawl.pending(table(spark, d, "brand_keywords").select(F.col("brand_domain").alias("domain")), good)


_HOST = "regexp_extract(lower(url), '^[a-z]+://([^/?#]+)', 1)"


@_query(f"select host, page_id from (select regexp_replace({_HOST}, '^www\\.', '') as host, page_id, row_number() over (partition by regexp_replace({_HOST}, '^www\\.', '') order by crawled_at desc, length({_HOST}), page_id) as r from crawl_pages where status = 'success' and {_HOST} <> '') where r = 1")
def best_homepage(spark: SparkSession, d: str) -> DataFrame:
    host = F.regexp_extract(F.lower("url"), r"^[a-z]+://([^/?#]+)", 1)
    return crawl.best_homepage(_pages(spark, d).filter("status = 'success'"), F.col("crawled_at").desc(), host, F.col("page_id")).select("host", "page_id")


_LINE = lambda label, v: f"case when {sql_strip(f'coalesce({v}, {chr(39) * 2})')} <> '' then '{label}: ' || {sql_strip(f'coalesce({v}, {chr(39) * 2})')} end"
_LIST = lambda c: f"array_to_string(list_filter({c}, lambda x: x is not null and x <> ''), ', ')"
_WIKI = "case when wikidata is not null then concat(coalesce(wikidata.name, ''), ' | ', coalesce(wikidata.description, ''), ' | aliases: ', coalesce(array_to_string(wikidata.aliases, ', '), '')) end"
_SUBS = f"nullif(array_to_string([concat('subpage[', coalesce(s.title, ''), ']: ', {sql_strip("coalesce(s.text, '')[1:600]")}) for s in coalesce(subpages, [])[1:2] if {sql_strip("coalesce(s.text, '')")} <> ''], chr(10)), '')"
_CONTEXT = "concat_ws(chr(10), " + ", ".join([*(_LINE(c, c) for c in ("site_name", "title", "meta_description", "meta_keywords", "lang")), _LINE("h1", _LIST("h1_headings")), _LINE("h2", _LIST("h2_headings")), _LINE("nav", _LIST("nav_links")), _LINE("json_ld", "json_ld_summary"), _LINE("wikidata", _WIKI), _SUBS, _LINE("content", "coalesce(main_content, '')[1:2500]")]) + ")"


@_query(f"select page_id, {_CONTEXT} as context from crawl_pages where status is not distinct from 'success' and length({sql_strip(_TEXT)}) > 0")
def context_blocks(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).filter(crawl.has_context()).select("page_id", crawl.context_block().alias("context"))


@_query(f"select count(*) as n_valid from crawl_pages where status = 'success' and length({sql_strip(_TEXT)}) > 0")
def valid_contexts(spark: SparkSession, d: str) -> DataFrame:
    return _pages(spark, d).filter(crawl.has_context()).agg(F.count(F.lit(1)).alias("n_valid"))


@_query(f"""select source, count(*) as n, round(100.0 * count(*) filter (length({sql_strip("coalesce(title, '')")}) > 0) / count(*), 1) as title_pct, round(100.0 * count(*) filter (length({sql_strip("coalesce(main_content, '')")}) > 0) / count(*), 1) as main_content_pct,
  round(100.0 * count(*) filter (len(coalesce(nav_links, [])) > 0) / count(*), 1) as nav_links_pct, round(100.0 * count(*) filter (wikidata is not null) / count(*), 1) as wikidata_pct, round(avg(length(coalesce(main_content, ''))), 1) as mean_chars from crawl_pages group by source""")
def field_coverage(spark: SparkSession, d: str) -> DataFrame:
    return crawl.field_coverage(_pages(spark, d), ["title", "main_content", "nav_links", "wikidata"])


_IDENTITY = "|".join(f"(?:{p})" for p in crawl.IDENTITY_PATHS)


@_query(f"select page_id, array_to_string(links, chr(10)) as links from (select page_id, list_filter(internal_links, lambda u: regexp_matches(lower(split_part(u, '?', 1)), '{_IDENTITY}'))[1:2] as links from crawl_pages) where len(links) > 0")
def identity_links(spark: SparkSession, d: str) -> DataFrame:
    found = _pages(spark, d).select("page_id", crawl.identity_links(F.col("internal_links")).alias("links")).filter("size(links) > 0")
    return found.withColumn("links", F.array_join("links", "\n"))


@_query(f"select domain, s || '://' || w || domain || t as url from (select distinct {sql_domain('domain')} as domain from golden_base where domain is not null), (values ('https'), ('http')) a(s), (values (''), ('www.')) b(w), (values (''), ('/')) c(t)")
def url_variants(spark: SparkSession, d: str) -> DataFrame:
    g = table(spark, d, "golden_base").filter("domain IS NOT NULL").select(normalize_domain(F.col("domain")).alias("domain")).distinct()
    return g.select("domain", F.explode(crawl.url_variants(F.col("domain"))).alias("url"))


@_query()
def html_extract(spark: SparkSession, d: str) -> DataFrame:
    p = _pages(spark, d)
    esc = lambda c: F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "&", "&amp;"), "<", "&lt;")
    html = F.concat(F.lit("<html lang='"), esc(F.col("lang")), F.lit("'><head><title>"), esc(F.col("title")), F.lit("</title></head><body><nav>"), F.array_join(F.transform(F.coalesce("nav_links", F.array()), lambda x: F.concat(F.lit("<a href='/'>"), esc(x), F.lit("</a>"))), ""), F.lit("</nav><p>"), esc(F.col("main_content")), F.lit("</p></body></html>"))
    return parse_pages(p.select("page_id", F.col("domain"), F.col("url"), html.alias("html")), keep=["page_id"]).select("page_id", "lang", "title", "nav_links", "main_content")


# ---------------------------------------------------------------- evaluation and diffs

_LABEL = "case judge when 'accepted' then 'brand_direct' when 'not_judged' then case when vertical in ('books', 'food') then '' else 'category_ok' end when 'error' then 'reject' else '' end"
_LABELS = f"labels as (select lower({sql_strip('brand_domain')}) as b, lower({sql_strip('keyword')}) as k, min({_LABEL}) as label from brand_keywords where brand_domain is not null and keyword is not null and {_LABEL} <> '' and confidence = 'high' group by all)"
_GEN = f"gen as (select brand_domain, keyword, context_used, vertical, label from brand_keywords g left join labels l on l.b = lower({sql_strip('brand_domain')}) and l.k = lower({sql_strip('keyword')}))"
_METRICS = "count(*) as n, count(label) as n_labelled, {r}(count(*) filter (label in ('brand_direct', 'category_ok')) / nullif(count(label), 0){d}) as precision, {r}(count(*) filter (label = 'brand_direct') / nullif(count(label), 0){d}) as share_direct, {r}(count(label) / count(*){d}) as coverage"


def _labelled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    k = table(spark, d, "brand_keywords").withColumnRenamed("brand_domain", "brand")
    label = F.when(F.col("judge") == "accepted", "brand_direct").when(F.col("judge") == "not_judged", F.when(F.col("vertical").isin("books", "food"), "").otherwise("category_ok")).when(F.col("judge") == "error", "reject").otherwise("")
    labels = k.filter("brand IS NOT NULL AND keyword IS NOT NULL AND confidence = 'high'").select("brand", "keyword", label.alias("label"))
    return evaluate.label_pairs(k, labels), labels


@_query(f"with {_LABELS}, {_GEN} select {_METRICS.format(r='', d='')} from gen")
def eval_precision(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.metrics(_labelled(spark, d)[0], [])


@_query(f"with {_LABELS}, {_GEN} select vertical, {_METRICS.format(r='round', d=', 3')} from gen group by vertical")
def eval_per_vertical(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.metrics(_labelled(spark, d)[0], ["vertical"], 3)


@_query(f"with {_LABELS}, {_GEN} select context_used, count(*) filter (label = 'brand_direct') as n_brand_direct, count(*) filter (label = 'category_ok') as n_category_ok, count(*) filter (label = 'reject') as n_reject, count(*) filter (label is null) as n_unlabelled from gen group by context_used")
def eval_by_context(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.label_counts(_labelled(spark, d)[0], "context_used")


@_query(f"with {_LABELS} select b, k from labels where not exists (select 1 from brand_keywords g where g.in_context = 'Yes' and lower({sql_strip('g.brand_domain')}) = b and lower({sql_strip('g.keyword')}) = k)")
def eval_inactive(spark: SparkSession, d: str) -> DataFrame:
    gen = table(spark, d, "brand_keywords").filter("in_context = 'Yes'").withColumnRenamed("brand_domain", "brand")
    return evaluate.inactive_labels(gen, _labelled(spark, d)[1])


@_query("select vertical, brand from (select vertical, brand, row_number() over (partition by vertical order by md5('42' || brand), brand) as r from (select distinct vertical, brand_domain as brand from brand_keywords where brand_domain is not null)) where r <= 5")
def eval_sample(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.sample_brands(table(spark, d, "brand_keywords").select("vertical", F.col("brand_domain").alias("brand")).filter("brand IS NOT NULL"), 5)


_SLD_OF_BRAND = _SLD_OF_KW.replace("keyword", "brand_domain")


@_query(f"""with r as (select brand_domain as brand, keyword, '' as label, 0 as i, 'baseline' as source from brand_keywords where brand_domain is not null and keyword is not null
  union all select distinct brand_domain, {_SLD_OF_BRAND}, 'brand_direct', 1, 'anchor' from brand_keywords where brand_domain is not null and keyword is not null),
k as (select *, lower({sql_strip('brand')}) as b, lower({sql_strip('keyword')}) as k from r),
f as (select *, row_number() over (partition by b, k order by i, brand, keyword) as n from k)
select max(brand) filter (n = 1) as brand, max(keyword) filter (n = 1) as keyword, case when count(distinct i) = 2 then 'baseline+anchor' else min(source) end as source, max(label) as label from f group by b, k""")
def eval_upsert(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "brand_keywords").withColumnRenamed("brand_domain", "brand").filter("brand IS NOT NULL AND keyword IS NOT NULL")
    own = k.select("brand", registrable_sld(F.col("brand")).alias("keyword"), F.lit("brand_direct").alias("label")).distinct()
    return evaluate.upsert_pairs([("baseline", k.select("brand", "keyword")), ("anchor", own)])


@_query(f"select distinct lower({sql_strip('brand_domain')}) as b, lower({sql_strip('keyword')}) as k from brand_keywords n where in_context = 'No' and brand_domain is not null and keyword is not null and not exists (select 1 from brand_keywords e where e.in_context = 'Yes' and lower({sql_strip('e.brand_domain')}) = lower({sql_strip('n.brand_domain')}) and lower({sql_strip('e.keyword')}) = lower({sql_strip('n.keyword')}))")
def eval_append(spark: SparkSession, d: str) -> DataFrame:
    k = table(spark, d, "brand_keywords").withColumnRenamed("brand_domain", "brand").filter("brand IS NOT NULL AND keyword IS NOT NULL")
    return evaluate.append_new(k.filter("in_context = 'Yes'"), k.filter("in_context = 'No'")).select(*evaluate.pair_key())


_CAST = ", ".join(f"cast({c} as varchar) as {c}" for c in ("domain", "run_no", "status", "lang", "content_chars"))


@_query(f"""with b as (select {_CAST}, count(*) as n from golden_base group by all), c as (select {_CAST}, count(*) as n from golden_cand group by all),
u as (select domain, run_no, status, lang, content_chars, sum(n) as net from (select *, -n as m from b union all select *, n from c) x(domain, run_no, status, lang, content_chars, o, n) group by all)
select case when net > 0 then 'added' else 'removed' end as change, domain, run_no, status, lang, content_chars, cast(abs(net) as bigint) as copies from u where net <> 0""")
def multiset_changes(spark: SparkSession, d: str) -> DataFrame:
    cols = ["domain", "run_no", "status", "lang", "content_chars"]
    return multiset_diff(table(spark, d, "golden_base").select(cols), table(spark, d, "golden_cand").select(cols))


@_query(f"""with g as (select distinct {sql_domain('domain')} as d from golden_base where status = 'success'), c as (select distinct {sql_domain('domain')} as d from golden_cand where status = 'success')
select 'lost' as change, d as domain from g where d is not null and d not in (select d from c where d is not null) union all select 'recovered', d from c where d is not null and d not in (select d from g where d is not null)""")
def recovered_domains(spark: SparkSession, d: str) -> DataFrame:
    good = lambda t: table(spark, d, t).filter("status = 'success'").select(normalize_domain(F.col("domain")).alias("domain")).filter("domain IS NOT NULL")
    g, c = good("golden_base"), good("golden_cand")
    return g.subtract(c).select(F.lit("lost").alias("change"), "domain").unionByName(c.subtract(g).select(F.lit("recovered").alias("change"), "domain"))


@_query("select word, cast(sum(n) as bigint) as n, cast(sum(sum(n)) over (order by word rows unbounded preceding) as bigint) as running from (select status as word, count(*) as n from golden_base where status is not null group by 1) group by word")
def running_totals(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window as W

    counts = table(spark, d, "golden_base").filter("status IS NOT NULL").groupBy(F.col("status").alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("running", F.sum("n").over(W.orderBy("word").rowsBetween(W.unboundedPreceding, 0)))


@_query(f"with {_TOKENS} select a.token, cast({_QWERTY.replace('address_sld', 'other').replace('token[i]', 'a.token[i]').replace('length(token)', 'length(a.token)')} as integer) as qwerty_subs from (select token, reverse(token) as other from tokens) a")
def qwerty_subs(spark: SparkSession, d: str) -> DataFrame:
    t = _sides(spark, d)[0].select("token").distinct().filter("token != ''")
    return t.select("token", qwerty_substitutions(F.col("token"), F.reverse("token")).alias("qwerty_subs"))


@_query(f"with {_TOKENS}, x as (select token, reverse(token) as other from tokens) select token, case when len({_GRAMS('token')}) + len({_GRAMS('other')}) = 0 then 1.0 else 2.0 * len(list_intersect({_GRAMS('token')}, {_GRAMS('other')}))::double / (len({_GRAMS('token')}) + len({_GRAMS('other')}))::double end as dice from x")
def dice_scores(spark: SparkSession, d: str) -> DataFrame:
    t = _sides(spark, d)[0].select("token").distinct().filter("token != ''")
    return t.select("token", dice_bigram(F.col("token"), F.reverse("token")).alias("dice"))


def queries() -> dict:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
