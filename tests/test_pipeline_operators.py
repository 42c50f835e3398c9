from datetime import date

import pytest
from pyspark.sql import functions as F

from typolens.operators import crawl, evaluate, report, selection, targets


def test_targets(spark):
    lookup = spark.createDataFrame([(1, "﻿Kindel.com "), (2, "dup.com"), (3, "nan"), (4, None), (5, "gone.com"), (6, "kindel.com")], "pos long, address string")
    dump = spark.createDataFrame([(1, "kindel.COM", "ID1", "fA"), (2, "kindel.com", "ID2", None), (3, "dup.com", "ID1", "fC"), (4, "other.com", "ID9", "f"), (5, "dup.com", " ", "f")], "dump_pos long, address string, target_id string, feed string")
    pairs = targets.target_multimap(lookup, dump)
    assert pairs.count() == 5
    assert {tuple(r) for r in targets.first_by_id(pairs).collect()} == {("ID1", "fA"), ("ID2", "")}
    assert {tuple(r) for r in targets.unmatched_keys(lookup, dump).collect()} == {("gone.com", 1)}
    assert {tuple(r) for r in targets.multi_feed_addresses(dump).collect()} == {("kindel.com", 2)}
    ids = spark.createDataFrame([("ID1", "fA", " Domain ", 1), ("ID1", "fB", "Domain", 2), ("ID2", "x", "Keyword", 3), ("", "y", "Domain", 4)], "target_id string, feed string, traffic_type string, pos long")
    assert {tuple(r) for r in targets.feed_by_id(ids).collect()} == {("ID1", "fB")}
    rep = spark.createDataFrame([("ID1", 5), ("ID2", 1), (None, 2)], "target_id string, visits int")
    assert {(r["target_id"], r["feed"]) for r in targets.enrich_feed(rep, targets.feed_by_id(ids)).collect()} == {("ID1", "fB"), ("ID2", ""), (None, "")}


def test_ordinals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(6)
    got = targets.request_batches(df, ["k"], 300).collect()
    assert all(r["ordinal"] == r["k"] and r["batch_id"] == r["k"] // 300 for r in got) and len(got) == 1000


def test_report(spark):
    m = spark.createDataFrame(
        [(1, "a.com", "k", "branded", "Kindel.com", "misspelling", 0.9, 1, 0.9), (2, "a.com", "k2", "branded", "kindel.com", "affix", 0.95, 1, 0.9), (3, "b.com", "k", None, "kindel.com", "affix", None, 1, 0.9), (4, "b.com", "k", "x", None, "affix", None, 1, 0.9)],
        "match_id long, brand string, keyword string, specificity string, keyword_misspelling string, match_type string, final_score double, distance int, score_jarowinkler double",
    )
    best = report.best_per_brand(m)
    assert {(r["brand"], r["match_id"]) for r in best.collect()} == {("a.com", 2), ("b.com", 3), ("b.com", 4)}
    t = spark.createDataFrame([(1, " KINDEL.com", "900"), (2, "kindel.com", "n/a"), (3, None, "1")], "row_id long, target_address string, raw string").withColumn("visits", report.as_number(F.col("raw")))
    rows = report.join_traffic(best, t)
    assert sorted((r["row_id"], r["match_id"], r["visits"]) for r in rows.collect()) == [(1, 2, 900.0), (1, 3, 900.0), (2, 2, None), (2, 3, None)]
    with pytest.raises(ValueError):
        report.join_traffic(best, t.withColumnRenamed("raw", "brand"))
    ordered = rows.withColumn("tier", report.tier(F.col("specificity"))).orderBy(*report.client_order()).collect()
    assert [r["row_id"] for r in ordered] == [1, 2, 1, 2]
    flagged = report.popular_flag(rows, spark.createDataFrame([("Kindel.com",)] * 2, "domain string"), F.lower("keyword_misspelling"))
    assert flagged.count() == 4 and all(r["is_popular"] for r in flagged.collect())
    tables = report.grouped_markdown(rows.withColumn("visits", F.coalesce("visits", F.lit(0.0)))).collect()
    assert len(tables) == 1 and tables[0]["table"].count("\n") == 3


def test_selection(spark):
    items = [("b.com", g, p, k, s) for g, p, k, s in ((1, 1, "Kindle", "branded"), (1, 2, "fire tv", "branded"), (1, 3, "prime", "category_strong"), (2, 1, "kindle", "weak"), (2, 2, "FireTV", "branded"), (2, 3, " ", "branded"), (2, 4, "alexa", "brand_core"))]
    merged = selection.merge_generations(spark.createDataFrame(items, "brand string, generation int, pos long, keyword string, specificity string"))
    assert {(r["token"], r["confidence"], r["specificity"]) for r in merged.collect()} == {("kindle", "high", "branded"), ("firetv", "high", "branded"), ("prime", "low", "category_strong"), ("alexa", "low", "brand_core")}
    cand = [("nikee", "branded", "product"), ("café", "branded", "product"), ("abc", "branded", "product"), ("shipping", "branded", "product"), ("kindle", "branded", "product"), ("kindle", "branded", "product"), ("rival", "branded", "third_party_brand"), ("meh", "weak", "product"), ("odd", None, "product"), ("kindle", "weak", "product")]
    rows = spark.createDataFrame([("b.com", i, *c) for i, c in enumerate(cand)], "brand string, pos int, token string, specificity string, kind string")
    got = {r["pos"]: r["reason"] for r in selection.validate_candidates(rows, ["shipping"]).collect()}
    assert got == {0: None, 1: "non_ascii_or_symbols", 2: "length:3", 3: "blocklist", 4: None, 5: "duplicate", 6: "trap:third_party_brand", 7: "trap:weak", 8: "unknown_specificity:", 9: "trap:weak"}
    full = selection.inject_label(merged, spark.createDataFrame([("b.com",)], "brand string"))
    assert {r["token"] for r in full.filter("pos = -1").collect()} == {"b"}
    many = spark.createDataFrame([("b.com", f"t{i}", "category_strong" if i % 2 else "branded", "high", i) for i in range(20)], "brand string, token string, specificity string, confidence string, pos int")
    slots = selection.fill_slots(many, 6).orderBy("slot").collect()
    assert [r["token"] for r in slots] == ["t0", "t2", "t4", "t6", "t8", "t10"]
    few = selection.fill_slots(many.filter("specificity = 'category_strong' OR token = 't0'"), 6).orderBy("slot").collect()
    assert [r["token"] for r in few] == ["t0", "t1", "t3", "t5"]
    assert {tuple(r) for r in selection.direct_counts(full).collect()} == {("b.com", 3)}
    ctx = spark.createDataFrame([("b.com", "Buy a KINDLE here"), ("c.com", None)], "brand string, context string")
    assert {r["token"] for r in selection.in_context(merged, ctx).filter("in_context").collect()} == {"kindle"}


def test_quality(spark):
    long = "real content " * 20
    texts = {"Checking your browser": "bot_protection", "please enable JS": "js_required", "Not available in your country": "geo_block", "Buy this domain": "parked", "short": "thin", long: "ok", None: "thin", "access denied based on your location": "bot_protection"}
    got = spark.createDataFrame([(k,) for k in texts], "t string").select(crawl.quality_class(F.col("t"))).collect()
    assert [r[0] for r in got] == list(texts.values())
    esc = spark.createDataFrame([(None, long * 3), (503, long * 3), (200, None), (200, "x"), (200, long * 3), (200, long * 3 + "captcha")], "s int, h string")
    assert [r[0] for r in esc.select(crawl.should_escalate(F.col("s"), F.col("h"))).collect()] == [True, True, True, True, False, True]
    fresh = spark.createDataFrame([("20260101120000",), ("20200101",), ("2026",), (None,)], "s string").select(crawl.fresh_snapshot(F.col("s"), F.lit(date(2026, 6, 1))))
    assert [r[0] for r in fresh.collect()] == [True, False, False, False]


def test_cascade_and_resume(spark):
    rows = [("https://www.a.com/", "web", "success", 1), ("a.com", "http", "error", 2), ("b.com", "archive", "success", 3), ("b.com", "http", "success", 4), ("", "http", "success", 5), (None, "http", "success", 6), ("c.com", "other", "success", 7)]
    r = spark.createDataFrame(rows, "domain string, source string, status string, pos int")
    good = F.col("status") == "success"
    assert {(x["domain"], x["pos"]) for x in crawl.cascade(r, ["http", "web", "archive"], good, [F.col("pos")]).collect()} == {("a.com", 1), ("b.com", 4)}
    assert {(x["domain"], x["pos"]) for x in crawl.first_good(r, good, [F.col("pos")]).collect()} == {("a.com", 1), ("b.com", 3), ("c.com", 7)}
    assert {x[0] for x in crawl.pending(spark.createDataFrame([("A.com",), ("d.com",), (None,)], "domain string"), r).collect()} == {"d.com"}
    ((urls,),) = [tuple(x) for x in spark.createDataFrame([("www.x.com",)], "d string").select(crawl.url_variants(F.col("d"))).collect()]
    assert len(set(urls)) == 8 and "http://www.x.com/" in urls
    ((links,),) = [tuple(x) for x in spark.createDataFrame([(["/p/1", "/About?x=1", "/company/", "/products"],)], "l array<string>").select(crawl.identity_links(F.col("l"))).collect()]
    assert links == ["/About?x=1", "/company/"]


def test_evaluation(spark):
    gen = spark.createDataFrame([("A.com", "Kindle", "v"), ("a.com", "fire", "v"), ("a.com", "junk", "w"), ("a.com", "none", "w")], "brand string, keyword string, vertical string")
    labels = spark.createDataFrame([("a.com", "kindle", "brand_direct"), ("a.com", "fire", "category_ok"), ("a.com", "junk", "reject"), ("a.com", "gone", "reject"), ("a.com", "none", "")], "brand string, keyword string, label string")
    rows = evaluate.label_pairs(gen, labels)
    m = evaluate.metrics(rows, []).first()
    assert (m["n"], m["n_labelled"], round(m["precision"], 3), round(m["share_direct"], 3), m["coverage"]) == (4, 3, 0.667, 0.333, 0.75)
    assert {r["vertical"]: r["precision"] for r in evaluate.metrics(rows, ["vertical"], 3).collect()} == {"v": 1.0, "w": 0.0}
    assert evaluate.metrics(rows.limit(0), []).first()["precision"] is None
    assert {tuple(r) for r in evaluate.inactive_labels(gen, labels).collect()} == {("a.com", "gone")}
    up = {(r["keyword"].lower()): (r["source"], r["label"]) for r in evaluate.upsert_pairs([("base", labels), ("new", gen.select("brand", "keyword"))]).collect()}
    assert up["kindle"] == ("base+new", "brand_direct") and up["gone"] == ("base", "reject") and up["none"] == ("base+new", "")
    assert [tuple(r) for r in evaluate.append_new(labels, spark.createDataFrame([("a.com", "NEW"), ("A.com", "Fire")], "brand string, keyword string")).collect()] == [("a.com", "NEW")]
    many = spark.range(40).select(F.lit("v").alias("vertical"), F.concat(F.lit("b"), F.col("id").cast("string")).alias("brand"))
    assert {tuple(r) for r in evaluate.sample_brands(many, 5).collect()} == {tuple(r) for r in evaluate.sample_brands(many.repartition(9), 5).collect()}


def test_evaluation_sample_order_and_usage(spark):
    rows = spark.createDataFrame([("b.com", "Y", None), ("A.com", "z", "reject"), ("A.com", "q", ""), ("a.com", "x", None), ("A.com", "B", None)], "brand string, keyword string, label string")
    assert [tuple(r) for r in evaluate.unlabelled_sample(rows, 2).collect()] == [("A.com", "B"), ("a.com", "x")]
    assert [r["keyword"] for r in rows.orderBy(*evaluate.evaluation_order()).collect()] == ["B", "q", "x", "z", "Y"]
    usage = spark.createDataFrame([("a", 3, 1), ("a", None, 2), ("b", 5, 0)], "run string, prompt_tokens long, completion_tokens long")
    assert tuple(evaluate.usage_sums(usage).first()) == (8, 3)
    assert {tuple(r) for r in evaluate.usage_sums(usage, ("run",)).collect()} == {("a", 3, 3), ("b", 5, 0)}
    assert tuple(evaluate.usage_sums(usage.limit(0)).first()) == (0, 0)


def test_label_progress(spark):
    from typolens.operators import evaluate

    rows = [("a", "", "baseline_run", "No"), ("a", "brand_direct", "baseline_run+sld_anchor", "Yes"), ("b", None, "sld_anchor", None), ("c", None, "baseline_run", None), (None, "reject", "plan", "Yes")]
    got = {r["brand"]: tuple(r)[1:] for r in evaluate.label_progress(spark.createDataFrame(rows, "brand string, label string, source string, context_used string")).collect()}
    assert got == {"a": (2, 1, 1, True), "b": (1, 0, 1, False), "c": (1, 0, 1, True), None: (1, 1, 0, False)}


def test_context_of_brands(spark):
    from typolens.operators import crawl

    contexts = spark.createDataFrame([("www.a.com", "success", "A", None, None), ("b.com", "error", "B", None, None), (None, "success", "N", None, None)], "domain string, status string, title string, meta_description string, main_content string")
    brands = spark.createDataFrame([("HTTPS://A.com/",), ("b.com",), ("c.com",), (None,)], "brand string")
    got = {r["brand"]: (r["context"] and r["context"]["title"], r["usable"]) for r in crawl.context_of_brands(brands, contexts).collect()}
    assert got == {"HTTPS://A.com/": ("A", True), "b.com": ("B", False), "c.com": (None, False), None: (None, False)}


def test_steps():
    from typolens.plans.steps import STEPS, degraded, in_order, preflight

    assert [s.name for s in in_order(["report", "match", "match"])] == ["match", "report"]
    with pytest.raises(ValueError):
        in_order(["nope"])
    there = {"brands", "addresses", "target_dump"}.__contains__
    assert preflight([s.name for s in STEPS], there) == []
    assert preflight(["match"], there) == ["match: no keywords"]
    assert preflight(["generate", "match"], there, lambda x: x != "model provider") == ["generate: no model provider"]
    assert degraded(["generate"], there) == ["generate: contexts"] and degraded(["crawl", "generate"], there) == []
