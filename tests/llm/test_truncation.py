import bisect
import random

import pytest
from pyspark.sql import functions as F

from typolens.llm.truncation import ending, strict_prefixes, truncated_texts, truncation_by_source

ENDS = {
    "The text stops inside a sen": "sentence", "It ends with a comma,": "sentence", "It was long.\n\nThe new one is": "sentence", "Half a tag <a hre": "markup", "An entity &am": "markup", "A link [see](https://x.o": "markup", "Half a letter caf�": "markup",
    "It goes on and on …": "omission", "It goes on [...]": "omission", "It goes on and o (more)": "omission",
    "A whole sentence.": None, "Is it so?\"": None, "Text.\n\n## A heading": None, "Text.\n- x.com (misspelling)": None, "Text.\n| a | b |": None, "Text.\nTags: a, b, c": None, "Text.\nKind regards, Anna": None, "Text.\nBest regards\nThe night team": None,
    "Text.\nAppendix B": None, "Short title": None, "Text.\nSee also: https://x.com/": None, "Text.\nNordwal desk, room 12": None, "Text.\n```\nselect 1\n```": None, "Text.\n(end of note)": None, "It is done … Yes.": None, "": None, "  \n ": None,
}


@pytest.mark.parametrize(("text", "kind"), ENDS.items())
def test_endings(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(ending(F.col("t"))).first()[0] == kind


LONG = "x" * 400
FAR = {
    f'Text <img alt="It is done. {LONG} here!': "markup", f"Text [see](https://x.org/{LONG}.": "markup", f"Text [{LONG}](https://x.org/{LONG}!": "markup", f"Text [a (b) c](https://x.org/{LONG}!": "markup", f"Text {{{{ name | default '{LONG}' and done.": "markup",
    f"Text <b>{LONG}</b> is done.": None, f"Text 3 < 4 {LONG} is done.": None, f"Text [see](https://x.org/{LONG}) is done.": None, f"Text {{{{ name }}}} {LONG} is done.": None, f"Text a](b {LONG} is done.": None, f"Text [a](b {LONG} is done.": None, f"<b open\n{LONG} is done.": None,
}


@pytest.mark.parametrize(("text", "kind"), FAR.items())
def test_markup_open_for_long(spark, text, kind):
    assert spark.createDataFrame([(text,)], "t string").select(ending(F.col("t"))).first()[0] == kind


def test_prefix_join_against_brute_force(spark):
    r = random.Random(2)
    base = ["".join(r.choice("ab ") for _ in range(120)) for _ in range(30)]
    vals = base + [b[: r.randrange(40, 119)] for b in base for _ in range(3)] + base[:5]
    got = {x["value"]: x["goes_on"] for x in strict_prefixes(spark.createDataFrame([(v,) for v in vals], "value string").repartition(5)).collect()}
    s = sorted(set(vals))
    want = {v for v in s if len(v) >= 40 and any(x != v and x.startswith(v) for x in s[bisect.bisect_left(s, v) :][:200])}
    assert set(got) == want


def test_documents(spark):
    whole = "The house on the hill was built by a farmer who wanted to see the river. It stands there still."
    rows = [(1, whole, "Web-Scraper", ""), (2, whole[:60], "web_scraper", ""), (3, whole[:60].strip() + " (more)", None, ""), (4, whole[:73], "wiki", ""), (5, None, "wiki", ""), (6, "", "wiki", ""), (7, whole, "wiki", ""), (8, "word " * 40_000 + "end.", "wiki", "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, evidence string")
    got = {r["doc_id"]: r["evidence"] for r in truncated_texts(df).collect()}
    assert set(got) == {2, 3} and got[2] == "prefix"
    assert truncated_texts(df.limit(0)).collect() == []
    by = {r["source"]: (r["n_texts"], r["n_cut"]) for r in truncation_by_source(df).collect()}
    assert by == {"web_scraper": (2, 1), None: (1, 1), "wiki": (3, 0)}


def test_short_values_with_a_longer_copy(spark):
    rows = [(1, "Brand context of Ferr"), (2, "Brand context of Ferrari shops and their names."), (3, "Whole title"), (4, "Whole title. And more."), (5, "…"), (6, "Other title")]
    got = {r["doc_id"]: r["evidence"] for r in truncated_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "prefix"}


def test_seams_meet_in_several_passes(spark, monkeypatch):
    from typolens.llm import truncation

    monkeypatch.setattr(truncation, "SEAM_TASK", 4)
    r = random.Random(4)
    base = ["".join(r.choice("ab") for _ in range(60)) for _ in range(40)] + ["a" * k for k in range(1, 40)]
    vals = sorted({*base, *(b[: r.randrange(5, 60)] for b in base)})
    # Values that share a long beginning are spread, and none is lost at a seam.
    vals += ["instruction " * 30 + v for v in vals]
    got = {x["value"] for x in strict_prefixes(spark.createDataFrame([(v,) for v in vals], "value string").repartition(8)).collect()}
    assert got == {v for v in vals if any(x != v and x.startswith(v) for x in vals)}
