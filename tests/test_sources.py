import gzip
import json
import time

import pytest
from pyspark.sql import functions as F

from typolens.sources import html, providers, readers, sinks

PAGE = """<html lang="en-GB"><head><title>Nordwal | Lamps</title><meta name="Description" content="Fine  lamps"><meta property="og:site_name" content="">
<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@graph": [{"@type": "Organization", "name": "Nordwal", "description": "Makers", "brand": {"name": "Lumo"}}]}</script></head>
<body><header><a href="/lamps">Lamps</a><a href="/x">ab</a></header><nav><a href="https://shop.nordwal.com/t#top">Tables &amp; chairs</a></nav>
<h1>Hello <b>world</b></h1><h2></h2><p>First text.<br>Second <a href="mailto:x@y.z">mail</a></p><form>hidden</form><footer>foot</footer><a href="https://other.com/">away</a><script>var x;</script></body></html>"""


def test_page():
    r = html.parse_page(PAGE, "nordwal.com", "https://www.nordwal.com/")
    assert (r["lang"], r["title"], r["meta_description"], r["site_name"], r["status"]) == ("en-GB", "Nordwal | Lamps", "Fine lamps", "Nordwal", "success")
    assert r["nav_links"] == ["Lamps", "Tables & chairs"] and r["h1_headings"] == ["Hello world"] and r["h2_headings"] == []
    assert r["internal_links"] == ["https://www.nordwal.com/lamps", "https://www.nordwal.com/x", "https://shop.nordwal.com/t"]
    assert r["json_ld_summary"] == "names: Nordwal; Lumo || desc: Makers" and "hidden" not in r["main_content"] and "First text. Second mail" in r["main_content"]
    assert html.parse_page(None, None, None)["error"] == "Empty HTML content"
    assert html.title_head("A long story - shop") == "A long story"


def test_pages_in_spark(spark):
    df = spark.createDataFrame([(1, PAGE, "nordwal.com", "https://nordwal.com/"), (2, None, None, None), (3, "<<<>", "x", "::")], "id int, html string, domain string, url string")
    got = {r["id"]: r for r in html.parse_pages(df, ["id"]).collect()}
    assert got[1]["title"] == "Nordwal | Lamps" and got[2]["status"] == "error" and got[3]["main_content"] is not None


def test_warc():
    body = gzip.compress(b"WARC/1.0\r\nx: y\r\n\r\nHTTP/1.1 200\r\na: b\r\n\r\n<html>\r\n\r\nz</html>")
    assert html.warc_body(body) == "<html>\r\n\r\nz</html>" and html.warc_body(b"no gzip") == ""


def test_readers(spark, tmp_path):
    p = tmp_path / "brands.csv"
    p.write_text("﻿Brand ,Other\n A.com ,1\nhttps://www.a.com/,2\n,3\nB.com,4\nbad,5,6,7\n", encoding="utf-8")
    assert {r["brand"] for r in readers.read_brands(spark, str(p)).collect()} == {"A.com", "B.com"}
    with pytest.raises(ValueError):
        readers.read_table(spark, str(p), ["Nope"])
    pop = tmp_path / "pop.csv"
    pop.write_text("1,Google.com\n2,books.com\nbroken\n")
    assert {r[0] for r in readers.read_popular(spark, str(pop)).collect()} == {"google.com", "books.com"}
    assert readers.read_popular(spark, str(tmp_path / "none.csv")).count() == 0
    block = tmp_path / "block.txt"
    block.write_text("# words\nShipping\n\nsale # x\n")
    assert {r[0] for r in readers.read_blocklist(spark, str(block)).collect()} == {"shipping", "sale"} and len(readers.blocklist_words()) == 77
    ctx = tmp_path / "ctx.json"
    ctx.write_text(json.dumps([{"domain": "a.com", "title": "old"}, {"domain": "www.a.com", "title": "new", "wikidata": {"name": "A"}}]))
    assert [(r["title"], r["wikidata"]["name"]) for r in readers.read_contexts(spark, str(ctx)).collect()] == [("new", "A")]
    ck = tmp_path / "ck.jsonl"
    ck.write_text('{"domain": "a.com", "status": "success"}\n\n{"domain": \nnot json\n')
    assert [r["domain"] for r in readers.read_checkpoint(spark, str(ck)).collect()] == ["a.com"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("b", True, 2), ("a", False, 1)], "brand string, ok boolean, n int")
    sinks.write_csv(df, str(tmp_path / "o"), [F.col("brand")], single=True)
    (part,) = (tmp_path / "o").glob("part-*")
    assert part.read_text().split() == ["brand,ok,n", "a,False,1", "b,True,2"]
    for k in (1, 1, 2):
        sinks.append_batch(df.withColumn("batch_id", F.lit(k)), str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 4
    sinks.write_reports(df, F.when(F.col("ok"), "").otherwise("cut"), str(tmp_path / "r"))
    assert spark.read.option("header", True).csv(str(tmp_path / "r/client")).count() == 1 and spark.read.option("header", True).csv(str(tmp_path / "r/internal")).count() == 2


def test_providers(spark):
    def fake(asks):
        if any(a == "bad" for a in asks):
            raise RuntimeError("down")
        return [None if a == "none" else {"brand_name": a, "keywords": [{"keyword": a + "1", "type": "brand", "specificity": "branded"}]} for a in asks]

    df = spark.createDataFrame([(x,) for x in ("a", "bad", "none", "b")], "request string")
    got = {r["request"]: r for r in providers.call_provider(df, fake, providers.GENERATION).collect()}
    assert got["a"]["answer"]["brand_name"] == "a" and got["b"]["error"] is None
    assert got["bad"]["error"] == "RuntimeError: down" and got["none"]["error"] == "no answer"
    calls = []

    def flaky(asks):
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return [{}]

    assert providers.with_retries(flaky, 3)(["x"]) == [{}]
    answers = iter([None, None, {"x": 1}])
    assert providers.poll(lambda: next(answers), 5) == {"x": 1}
    with pytest.raises(TimeoutError):
        providers.poll(lambda: None, 2)


def test_batch_codec(spark):
    req = providers.batch_requests(spark.createDataFrame([("a||b.com", 2, "hi")], "brand string, generation int, prompt string"), "m").first()
    assert req["custom_id"] == "a||b.com||2" and json.loads(req["body"])["messages"][0]["content"] == "hi"
    good = json.dumps({"brand_name": "b", "keywords": [{"keyword": "k", "type": "t", "specificity": "weak"}, {"keyword": "l"}]})
    rows = providers.batch_responses(spark.createDataFrame([("a||b.com||2", 200, good), ("c||1", 500, good), ("d||1", 200, "{oops")], "custom_id string, status int, content string"))
    assert [(r["brand"], r["generation"], r["pos"], r["keyword"]) for r in providers.explode_generations(rows).collect()] == [("a||b.com", 2, 0, "k"), ("a||b.com", 2, 1, "l")]


def test_stream(spark, tmp_path):
    from typolens.operators.match import keyword_dimension
    from typolens.streaming.incremental import match_stream, new_addresses

    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    k = keyword_dimension(spark.createDataFrame([("amazon.com", "amazon")], "brand_domain string, keyword string"))
    for a in ("amazom.com", "amazn.com"):
        spark.createDataFrame([(a,), ("unrelated.com",)], "address string").write.mode("append").parquet(src)
        q = match_stream(new_addresses(spark, src, "address string"), k, out, str(tmp_path / "ck"))
        end = time.time() + 60
        while q.isActive and time.time() < end:
            time.sleep(0.2)
        q.stop()
    assert sorted(r["keyword_misspelling"] for r in spark.read.parquet(out).collect()) == ["amazn.com", "amazom.com"]


def test_lines_of_a_table(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('\ufeffa, b ,c\n1,2,3\nshort,2\n"x, ""y""",2,3\n1,2,3,4\n1,2,3,\n"q,r",,"s,t",u\n\n,,\nlast\n', encoding="utf-8")
    t = readers.read_table(spark, str(p))
    assert t.columns == ["a", "b", "c", "pos"]
    assert [tuple(r)[:3] for r in t.orderBy("pos").collect()] == [("1", "2", "3"), ("short", "2", None), ('x, "y"', "2", "3"), (None, None, None), ("last", None, None)]
    assert [r["a"] for r in readers.read_table(spark, str(p), ["a"]).orderBy("pos").collect()][1] == "short"
    (tmp_path / "m.csv").write_text('a,b\n"two\nlines",1\n')
    assert readers.read_table(spark, str(tmp_path / "m.csv"), multi_line=True).first()["a"] == "two\nlines"
    (tmp_path / "e.csv").write_text("")
    with pytest.raises(ValueError):
        readers.read_table(spark, str(tmp_path / "e.csv"))


def test_large_tables_are_split(spark, tmp_path):
    p = tmp_path / "big.csv"
    p.write_text("address,x\n" + f"{'a' * 480}.com,{'y' * 20}\n" * 100_000)
    t = readers.read_table(spark, str(p), ["address"])
    assert t.rdd.getNumPartitions() > 1 and t.count() == 100_000


def test_contexts_in_brand_order(spark, tmp_path):
    brands = spark.createDataFrame([("B.com", 0), ("https://www.a.com/x", 1), ("none.com", 2), ("b.com", 3), (None, 4)], "brand string, pos long")
    contexts = spark.createDataFrame([("a.com", "A", "success"), ("www.b.com", "B", "success"), ("z.com", None, "error")], "domain string, title string, status string")
    sinks.write_contexts(brands, contexts, str(tmp_path / "o"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "o" / "contexts")).collect())
    assert [r["title"] for r in json.loads(text)] == ["B", "A"]
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "o" / "failed")).collect()] == [("none.com", "Failed all crawl methods")]
    sinks.write_contexts(brands.limit(0), contexts, str(tmp_path / "e"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "e" / "contexts")).collect()] == ["[]"]


def test_snapshot_and_manifest(spark, tmp_path):
    got = sinks.snapshot(spark, {"t": spark.range(5)}, str(tmp_path / "s")).collect()
    assert got and all(len(r["sha256"]) == 64 and r["length"] > 0 for r in got) and spark.read.parquet(str(tmp_path / "s/tables/t")).count() == 5
    assert sinks.manifest(spark, str(tmp_path / "s" / "tables")).columns == ["path", "length", "modified"]


def test_strict_schema():
    s = {"type": "object", "properties": {"properties": {"type": "array", "items": {"type": "object", "properties": {"b": {"type": "string"}, "a": {"anyOf": [{"type": "object", "properties": {"x": {}}}, {"type": "null"}]}}}}}, "$defs": {"d": {"type": "object", "properties": {"k": {}}}}}
    out = providers.strict_schema(s)
    inner = out["properties"]["properties"]["items"]
    assert out["required"] == ["properties"] and inner["required"] == ["b", "a"] and inner["additionalProperties"] is False
    assert inner["properties"]["a"]["anyOf"][0]["required"] == ["x"] and out["$defs"]["d"]["additionalProperties"] is False and "required" not in s
    assert providers.response_format({"type": "object", "properties": {}}, "n")["json_schema"]["strict"]


def test_generations_come_back_in_order(spark):
    body = json.dumps({"keywords": [{"keyword": k, "type": "t", "specificity": "branded", "rationale": ""} for k in ("z", "a", "m")]})
    rows = spark.createDataFrame([("b.com||1", 200, body), ("b.com||2", 500, body)], "custom_id string, status int, content string")
    exploded = providers.explode_generations(providers.batch_responses(rows)).repartition(5)
    got = providers.regroup_generations(exploded).collect()
    assert [(r["brand"], r["generation"], [k["keyword"] for k in r["keywords"]]) for r in got] == [("b.com", 1, ["z", "a", "m"])]
    assert providers.regroup_generations(exploded.limit(0)).collect() == []
