"""Crawl records: quality gate, tier cascade, resume, context and coverage."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from typolens.functions.keys import normalize_domain, strip

# Phrases of the quality classes, in the order in which the classes are tested.
BOT_PROTECTION = ["cloudflare", "cf-browser-verification", "checking your browser", "just a moment", "attention required", "captcha", "verify you are human", "access denied", "robot check", "security challenge", "blocked"]
JS_REQUIRED = ["enable javascript", "javascript is disabled", "please enable js", "requires javascript", "you need to enable javascript", "this site requires javascript", "enable cookies and javascript"]
GEO_BLOCK = [
    "not available in your country", "not available in your region", "not available in your location", "access denied based on your location", "this content is not available in your location",
    "we're sorry, this service is unavailable in your region", "is unavailable in your country", "is unavailable in your location", "is not available in your country", "restricted country",
]
PARKED = ["parked domain", "this domain is for sale", "buy this domain", "domain parking", "coming soon"]
QUALITY_CLASSES = [("bot_protection", BOT_PROTECTION), ("js_required", JS_REQUIRED), ("geo_block", GEO_BLOCK), ("parked", PARKED)]
#: HTTP statuses that call for a browser. Fixed values.
ESCALATE_STATUS = [403, 406, 409, 429, 500, 502, 503, 520]
#: Paths that tell who runs a site. Fixed values.
IDENTITY_PATHS = [r"/about(-us)?/?$", r"/aboutus/?$", r"/our-story/?$", r"/who-we-are/?$", r"/company/?$", r"/brands?/?$", r"/products?/?$", r"/collections?/?$"]
MIN_CONTENT = 100


def _any(low: Column, phrases: list[str]) -> Column:
    return reduce(or_, (F.contains(low, F.lit(p)) for p in phrases))


def quality_class(text: Column, min_length: int = MIN_CONTENT) -> Column:
    """``ok`` or why a text is no content; null counts as empty."""
    def judge(low: Column) -> Column:
        out = F.when(F.lit(False), "")
        for name, phrases in QUALITY_CLASSES:
            out = out.when(_any(low, phrases), name)
        return out.when(F.length(strip(low)) < min_length, "thin").otherwise("ok")

    # A lambda binds the lower-case text, which would otherwise be made again for every phrase.
    return F.element_at(F.transform(F.array(F.lower(F.coalesce(text, F.lit("")))), judge), 1)


def page_text() -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in ("title", "meta_description", "main_content")])


def gate_reason(min_length: int = MIN_CONTENT) -> Column:
    """``status:...`` for failed records, else the quality class."""
    return F.when(F.col("status").eqNullSafe("success"), quality_class(page_text(), min_length)).otherwise(F.concat(F.lit("status:"), F.coalesce("status", F.lit(""))))


def should_escalate(status: Column, html: Column) -> Column:
    """Whether a plain fetch should be repeated in a browser."""
    shown = F.exists(F.array(F.lower(F.coalesce(html, F.lit("")))), lambda low: (F.length(strip(low)) < 300) | _any(low, JS_REQUIRED + BOT_PROTECTION))
    return status.isNull() | status.isin(ESCALATE_STATUS) | shown


def has_context() -> Column:
    """A successful record with any title, description or content."""
    return F.col("status").eqNullSafe("success") & (F.length(strip(page_text())) > 0)


def fresh_snapshot(stamp: Column, now: Column, max_days: int = 730) -> Column:
    """Whether ``yyyyMMdd...`` is a date at most ``max_days`` before ``now``; unreadable stamps are not fresh."""
    taken = F.try_to_date(F.substring(stamp, 1, 8), "yyyyMMdd")
    return F.coalesce(F.datediff(now, taken) <= max_days, F.lit(False))


def cascade(records: DataFrame, sources: list[str], good: Column, position: list[Column]) -> DataFrame:
    """Per domain the first good record by source order, then position: one ranked window instead of a pass per tier."""
    rank = F.array_position(F.array(*map(F.lit, sources)), F.col("source"))
    rows = records.withColumn("domain", normalize_domain(F.col("domain"))).withColumn("__s", rank).filter(good & (F.col("__s") > 0) & (F.col("domain") != ""))
    return rows.withColumn("__r", F.row_number().over(W.partitionBy("domain").orderBy("__s", *position))).filter("__r = 1").drop("__r", "__s")


def first_good(records: DataFrame, good: Column, position: list[Column]) -> DataFrame:
    """Per domain the first good record in order of position."""
    rows = records.withColumn("domain", normalize_domain(F.col("domain"))).filter(good & (F.col("domain") != ""))
    return rows.withColumn("__r", F.row_number().over(W.partitionBy("domain").orderBy(*position))).filter("__r = 1").drop("__r")


def pending(wanted: DataFrame, done: DataFrame) -> DataFrame:
    """Domains of ``wanted`` that ``done`` does not hold: what a resumed run still has to do."""
    w = wanted.select(normalize_domain(F.col("domain")).alias("domain")).filter("domain != ''").distinct()
    return w.join(done.select(normalize_domain(F.col("domain")).alias("domain")), "domain", "left_anti")


def best_homepage(records: DataFrame, priority: Column, url_host: Column, tie: Column) -> DataFrame:
    """Per host without ``www.`` the row of best priority, then shortest host."""
    host = F.regexp_replace(F.lower(url_host), r"^www\.", "")
    rows = records.withColumn("host", host).withColumn("__l", F.length(url_host)).filter("host != ''")
    return rows.withColumn("__r", F.row_number().over(W.partitionBy("host").orderBy(priority, "__l", tie))).filter("__r = 1").drop("__r", "__l")


def identity_links(links: Column, most: int = 2) -> Column:
    """The first links whose path, without query, tells who runs the site."""
    path = lambda u: F.lower(F.substring_index(u, "?", 1))
    return F.slice(F.filter(links, lambda u: path(u).rlike("|".join(f"(?:{p})" for p in IDENTITY_PATHS))), 1, most)


def url_variants(domain: Column) -> Column:
    """The eight spellings under which a site may be registered: scheme, ``www.`` and trailing slash."""
    d = normalize_domain(domain)
    return F.array(*[F.concat(F.lit(f"{s}://{w}"), d, F.lit(t)) for s in ("https", "http") for w in ("", "www.") for t in ("", "/")])


def context_block(max_content: int = 2500, max_subpages: int = 2, max_subpage: int = 600) -> Column:
    """Labelled, ordered lines of a record's fields; blank ones are skipped."""
    def line(label: str, value: Column) -> Column:
        v = strip(F.coalesce(value, F.lit("")))
        return F.when(v != "", F.concat(F.lit(label + ": "), v))

    joined = lambda c: F.array_join(F.filter(F.col(c), lambda x: x.isNotNull() & (x != "")), ", ")
    wiki = F.when(F.col("wikidata").isNotNull(), F.concat(F.coalesce("wikidata.name", F.lit("")), F.lit(" | "), F.coalesce("wikidata.description", F.lit("")), F.lit(" | aliases: "), F.coalesce(F.array_join("wikidata.aliases", ", "), F.lit(""))))
    sub = lambda s: F.concat(F.lit("subpage["), F.coalesce(s["title"], F.lit("")), F.lit("]: "), strip(F.substring(F.coalesce(s["text"], F.lit("")), 1, max_subpage)))
    filled = F.filter(F.slice(F.coalesce(F.col("subpages"), F.array()), 1, max_subpages), lambda s: strip(F.coalesce(s["text"], F.lit(""))) != "")
    subs = F.when(F.size(filled) > 0, F.array_join(F.transform(filled, sub), "\n"))
    return F.concat_ws(
        "\n",
        line("site_name", F.col("site_name")), line("title", F.col("title")), line("meta_description", F.col("meta_description")), line("meta_keywords", F.col("meta_keywords")), line("lang", F.col("lang")),
        line("h1", joined("h1_headings")), line("h2", joined("h2_headings")), line("nav", joined("nav_links")), line("json_ld", F.col("json_ld_summary")), line("wikidata", wiki), subs,
        line("content", F.substring(F.coalesce(F.col("main_content"), F.lit("")), 1, max_content)),
    )


def field_coverage(records: DataFrame, fields: list[str]) -> DataFrame:
    """``source, n`` and per field the percentage of records in which it is filled."""
    kinds = dict(records.dtypes)

    def filled(c: str) -> Column:
        if kinds[c].startswith("array"):
            return F.size(F.coalesce(F.col(c), F.array())) > 0
        if kinds[c].startswith("struct"):
            return F.col(c).isNotNull()
        return F.length(strip(F.coalesce(F.col(c).cast("string"), F.lit("")))) > 0

    return records.groupBy("source").agg(F.count(F.lit(1)).alias("n"), *[F.round(100.0 * F.count_if(filled(c)) / F.count(F.lit(1)), 1).alias(f"{c}_pct") for c in fields], F.round(F.avg(F.length(F.coalesce("main_content", F.lit("")))), 1).alias("mean_chars"))


def context_of_brands(brands: DataFrame, contexts: DataFrame) -> DataFrame:
    """``brands`` (``brand``) with ``context`` (the record, null: none) and ``usable``, matched by normalised domain.

    Contexts are unique by domain (``read_contexts``); a blank or null domain matches nothing.
    """
    record = F.struct(*[F.col(f"`{c}`") for c in contexts.columns]).alias("context")
    right = contexts.select(normalize_domain(F.col("domain")).alias("__d"), record, has_context().alias("__usable")).filter("__d != ''")
    left = brands.withColumn("__d", normalize_domain(F.col("brand")))
    return left.join(right, "__d", "left").withColumn("usable", F.coalesce("__usable", F.lit(False))).drop("__d", "__usable")
