import random

import pytest
from pyspark.sql import functions as F

from typolens.llm.group_topn import top_n_per_group

SCHEMA = "g string, m string, s double, i long, rank string"


def brute(rows, n, distinct):
    out = set()
    for g in {r[0] for r in rows} - {None}:
        seen, k = set(), 0
        for r in sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[3])):
            if distinct and r[1] in seen:
                continue
            seen.add(r[1])
            if (k := k + 1) > n:
                break
            out.add((g, r[3], k))
    return out


@pytest.mark.parametrize("distinct", [None, "m"])
@pytest.mark.parametrize("light", [50, 400, 10_000])
def test_against_brute_force(spark, distinct, light):
    r = random.Random(1)
    rows = [("hot" if r.random() < 0.4 else r.choice(["a", "b", "c", None]), f"m{r.randrange(40)}", r.choice([0.5, 0.7, 0.9]), i, "x") for i in range(1500)]
    df = spark.createDataFrame(rows, SCHEMA).drop("rank")
    order = [F.col("s").desc(), F.col("i").asc()]
    for parts in (1, 7):
        got = top_n_per_group(df.repartition(parts), "g", 10, order, distinct, light_rows=light)
        assert {(x["g"], x["i"], x["rank"]) for x in got.collect()} == brute(rows, 10, distinct)


def test_empty_and_small(spark):
    df = spark.createDataFrame([], SCHEMA).drop("rank")
    order = [F.col("i").asc()]
    assert top_n_per_group(df, "g", 10, order).collect() == []
    one = spark.createDataFrame([("a", None, 1.0, 1, "")], SCHEMA).drop("rank")
    assert len(top_n_per_group(one, "g", 10, order, "m").collect()) == 1
    assert top_n_per_group(one, "g", 0, order).collect() == []


def test_only_the_largest_heavy_groups_are_salted(spark, monkeypatch):
    from typolens.llm import group_topn

    monkeypatch.setattr(group_topn, "MOST_HEAVY", 1)
    rows = [(g, f"m{i % 30}", i % 7 / 10, i, "") for i, g in enumerate("aaabbc" * 100)]
    got = top_n_per_group(spark.createDataFrame(rows, SCHEMA).drop("rank"), "g", 5, [F.col("s").desc(), F.col("i").asc()], "m", light_rows=90)
    assert {(x["g"], x["i"], x["rank"]) for x in got.collect()} == brute(rows, 5, "m")
