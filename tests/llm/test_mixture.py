import os

import pytest
from pyspark.sql import functions as F

from typolens.llm.mixture import BINS, DEFAULT_TOKENIZER, _edge, count_tokens, mix_sources, mixture_shares, plan_budgets, quality_weight, sampling_key

pytestmark = pytest.mark.skipif(not os.path.exists(DEFAULT_TOKENIZER), reason="no tokenizer file")


def test_budgets():
    plan = plan_budgets([("a", 1000), ("b", 100), (None, 5)], [("a", 0.5, 1), ("b", 0.25, 4), ("c", 0.25, 2)])
    assert plan["b"][0] == 4 and plan["a"] == (0, 800, pytest.approx(2 / 3))
    assert plan_budgets([], [("a", 1.0, 1)]) == {} == plan_budgets([("a", 5)], [("a", 1.0, 0)])
    assert plan_budgets([("a", 100)], [("a", 1.0, 3)], total_tokens=250)["a"] == (2, 50, 1.0)


def test_mixture(spark):
    words = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), (F.col("id") % 30 + 5).cast("int")), lambda i: F.concat(F.lit("word"), i.cast("string"))))
    docs = spark.range(1200).select(F.col("id").alias("doc_id"), words.alias("text"), F.when(F.col("id") % 10 == 0, " Small-One ").when(F.col("id") % 10 == 1, None).otherwise("big").alias("source"), F.lit(1).alias("n_tokens_x"))
    docs = docs.unionByName(spark.createDataFrame([(5000, None, "big", 1), (5001, "", "big", 1), (5002, "x", "unknown", 1)], "doc_id long, text string, source string, n_tokens_x int"))
    goals = spark.createDataFrame([("big", 0.5, 1), ("small_one", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mix = mix_sources(docs, goals)
    rows = mix.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) and {r["source"] for r in rows} == {"big", "small_one"}
    assert max(r["n_uses"] for r in rows if r["source"] == "big") == 1 and {r["n_uses"] for r in rows if r["source"] == "small_one"} == {3}
    shares = {r["source"]: r for r in mixture_shares(mix, goals).collect()}
    assert shares["big"]["share"] == pytest.approx(5 / 9, abs=0.01) and shares["none"]["n_tokens"] == 0
    assert {tuple(r) for r in mix_sources(docs.repartition(7), goals).collect()} == {tuple(r) for r in rows}
    assert mix_sources(docs.limit(0), goals).collect() == []


def test_token_counts(spark):
    import base64

    import tiktoken

    from typolens.llm.mixture import PATTERN

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(DEFAULT_TOKENIZER, "rb"))}
    enc = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello there, world!", None, "", "<|endoftext|> ünï"]
    got = count_tokens(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string"), "text").collect()
    assert [r["n_tokens"] for r in sorted(got)] == [len(enc.encode_ordinary(t)) if t else 0 for t in texts]
    assert enc.decode(enc.encode_ordinary(texts[0])) == texts[0]


def test_selection_is_a_prefix_by_key_whatever_the_weights(spark):
    """Texts of figures have the least weight, and their keys still spread over the bins."""
    text = F.when(F.col("id") % 2 == 0, F.concat(F.lit("1 2 3 "), F.col("id").cast("string"))).otherwise(F.concat(F.lit("a longer text of words "), F.col("id").cast("string")))
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"), F.when(F.col("id") < 2900, "a").otherwise("b").alias("source"))
    goals = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2)], "source string, target_share double, max_repeats int")
    used = {r["doc_id"] for r in mix_sources(docs, goals, total_tokens=2000).collect() if r["source"] == "a"}
    keyed = docs.filter("source = 'a'").select("doc_id", sampling_key(F.col("doc_id"), quality_weight(F.col("text")), 1).alias("key"), "text")
    rows = sorted((r["key"], r["doc_id"], r["n_tokens"]) for r in count_tokens(keyed, "text").collect())
    want, total = set(), 0
    for _, i, n in rows:
        total += n
        if total > 1000:
            break
        want.add(i)
    assert used == want and 0 < len(want) < 2900


def test_edges():
    assert _edge([(3, 10), (7, 5)], 0) == (3, 0) and _edge([(3, 10), (7, 5)], 10) == (7, 0) and _edge([(3, 10), (7, 5)], 12) == (7, 2) and _edge([(3, 10), (7, 5)], 15) == (8, 0)
    assert BINS == 4096
