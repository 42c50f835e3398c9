import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from typolens.operators import hot_keys
from typolens.operators.hot_keys import heavy_keys, key_quantiles, key_results

SCHEMA = "brand string, keyword string, m string, score double, field_name string"


def fields():
    return {"brand": F.col("brand"), "keyword": F.col("keyword")}


def data(n=3000, seed=5):
    r = random.Random(seed)
    return [("hot" if r.random() < 0.4 else r.choice([f"b{i}" for i in range(60)] + [None]), r.choice("uvwxyz"), r.choice(["m1", "m2", "m3", None]), r.choice([None, float("nan"), r.random(), 0.5, -3.0, 1e300, -1e300]), "clash") for _ in range(n)]


def test_heavy_keys_are_exact(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA)
    for share in (0.02, 0.1, 0.5, 0.0003):
        want = set()
        for f, i in (("brand", 0), ("keyword", 1)):
            c = defaultdict(int)
            for x in rows:
                if x[i] is not None:
                    c[x[i]] += 1
            want |= {(f, k, n) for k, n in c.items() if n >= share * len(rows)}
        assert {tuple(r) for r in heavy_keys(df, fields(), share).collect()} == want


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert heavy_keys(df, fields(), 0.02).collect() == []
    assert key_results(df, fields(), F.col("m"), F.col("score")).collect() == []


@pytest.mark.parametrize("cold", [2_000, 20, 0])
def test_results_and_quantiles(spark, monkeypatch, cold):
    # All keys are cold, some are, none is.
    monkeypatch.setattr(hot_keys.key_quantiles, "__defaults__", (64, cold))
    rows = data(1500)
    got = {(r["field_name"], r["key_value"]): r for r in key_results(spark.createDataFrame(rows, SCHEMA), fields(), F.col("m"), F.col("score"), (0.5, 0.9)).collect()}
    for f, i in (("brand", 0), ("keyword", 1)):
        by = defaultdict(list)
        for x in rows:
            if x[i] is not None:
                by[x[i]].append(x)
        for k, xs in by.items():
            r = got.pop((f, k))
            v = sorted(x[3] for x in xs if x[3] is not None and not math.isnan(x[3]))
            assert (r["n_rows"], r["n_members"]) == (len(xs), len({x[2] for x in xs} - {None}))
            assert r["best_score"] == (v[-1] if v else None)
            assert r["score_p50"] == (v[math.ceil(0.5 * len(v)) - 1] if v else None)
            assert r["score_p90"] == (v[max(1, math.ceil(0.9 * len(v))) - 1] if v else None)
    assert not got


def test_quantile_of_far_apart_values(spark):
    rows = [("k", float(2.0**i), 1) for i in range(-60, 61)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    assert key_quantiles(df, ["k"], "v", "n", (0.0, 0.5, 1.0)).filter("quantile = 0.5").collect()[0]["value"] == 1.0
    got = key_quantiles(df, ["k"], "v", "n", (0.0, 0.5, 1.0), cold_values=0).collect()
    assert {r["quantile"]: r["value"] for r in got} == {0.0: 2.0**-60, 0.5: 1.0, 1.0: 2.0**60}


def test_many_open_keys_are_salted(spark, monkeypatch):
    monkeypatch.setattr(hot_keys, "BROADCAST_KEYS", 0)
    rows = [(f"k{i % 3}", float(i), 1 + i % 2) for i in range(300)] + [("one", 1.0, 5), (None, 2.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    got = {(r["k"], r["value"]) for r in key_quantiles(df, ["k"], "v", "n", (0.5,), cold_values=10).collect()}
    want = set()
    for k in ("k0", "k1", "k2", "one"):
        v = sorted(x for key, x, n in rows if key == k for _ in range(n))
        want.add((k, v[math.ceil(0.5 * len(v)) - 1]))
    assert got == want
