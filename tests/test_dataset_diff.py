from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from typolens.functions.keys import normalize_domain
from typolens.operators.dataset_diff import _Merge, diff_copies, multiset_diff, schema_difference

SCHEMA = "domain string, run_no int, status string, n double"
FIELDS = ["domain", "status", "n"]


def run(spark, base, cand):
    b, c = spark.createDataFrame(base, SCHEMA), spark.createDataFrame(cand, SCHEMA)
    out = diff_copies(b, c, {"domain": normalize_domain(F.col("domain")), "run_no": F.col("run_no")}, FIELDS)
    return sorted(map(tuple, out.collect()), key=str)


def test_findings(spark):
    base = [("https://www.A.com/x", 1, "ok", 1.0), ("b.com", 1, "ok", 1.0), ("b.com", 1, "ok", 1.0), ("c.com", 1, None, 1.0), (None, 1, "ok", float("nan"))]
    cand = [("a.com", 1, "ok", 1.0), ("b.com", 1, "ok", 1.0), ("c.com", 1, "", 1.0), ("d.com", None, "ok", 1.0), (None, 1, "ok", float("nan"))]
    got = {(a, b, c) for a, b, c in run(spark, base, cand)}
    assert {(x[0], x[2]) for x in got} == {("a.com", "domain"), ("b.com", "copies"), ("c.com", "status"), ("d.com", "missing_in_baseline")}


def test_empty_copies(spark):
    rows = [("a.com", 1, "ok", 1.0)]
    assert run(spark, [], []) == []
    assert [x[2] for x in run(spark, rows, [])] == ["missing_in_candidate"]
    assert [x[2] for x in run(spark, [], rows)] == ["missing_in_baseline"]


def test_hot_key_and_clashing_columns(spark):
    b = spark.range(5000).selectExpr("'hot.com' AS domain", "1 AS run_no", "'x' AS status", "1.0D AS n", "id AS finding", "id AS __n")
    c = b.limit(4999)
    out = diff_copies(b, c, {"domain": F.col("domain"), "run_no": F.col("run_no")}, FIELDS).collect()
    assert [tuple(r) for r in out] == [("hot.com", "1", "copies")]


def findings_of(rows, size, splits):
    """Findings of the merge over ranges cut at ``splits`` and batches of ``size`` rows; seam states are summed."""
    spots = {v: (k + 1) ** 3 for k, v in enumerate(sorted({r[2:] for r in rows}, key=str))}
    rows = sorted([(k, spots[v], s, *v) for k, s, *v in ((r[0], r[1], r[2:]) for r in rows) for v in v])
    pdf = pd.DataFrame(rows, columns=["__k0", "__h", "__side", "__f0", "__f1"]).assign(__n=1)
    pdf["__f0"] = pdf["__f0"].replace("", None)
    parts = np.array([sum((r[0], r[1]) >= s for s in splits) for r in rows], dtype=int)
    got, seams = set(), {}
    for part in range(len(splits) + 1):
        m = _Merge(1, ["f", "g"])
        mine = pdf[parts == part]
        done = [d for i in range(0, len(mine), size) for d in m.rows(mine.iloc[i : i + size])] + m.end()
        for d in done:
            for k, finding, state in d[["__k0", "finding", "state"]].itertuples(index=False):
                if state is None:
                    assert (k, finding) not in got
                    got.add((k, finding))
                else:
                    seams[k] = seams.get(k, 0) + np.array(state)
    for k, state in seams.items():
        got |= {(k, name) for at, name in _Merge(1, ["f", "g"]).findings(state[None]) if len(at)}
    return got


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from([0, 1]), st.sampled_from(["x", "y", ""]), st.sampled_from("pq")), max_size=30), st.integers(1, 7), st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 220)), max_size=4))
def test_merge_in_any_batches_and_ranges(rows, size, splits):
    want = set()
    for k in {r[0] for r in rows}:
        a, b = ([r[2:] for r in rows if r[0] == k and r[1] == s] for s in (0, 1))
        if not a or not b:
            want.add((k, "missing_in_candidate" if a else "missing_in_baseline"))
            continue
        fields = {(k, name) for j, name in enumerate("fg") if Counter(x[j] for x in set(a)) != Counter(x[j] for x in set(b))}
        want |= fields | ({(k, "copies")} if len(a) != len(b) else set()) | ({(k, "rows")} if not fields and set(a) != set(b) else set())
    assert findings_of(rows, size, splits) == want


def test_repeats_that_are_not_identical(spark):
    x, y, z = (("a.com", 1, s, 1.0) for s in "xyz")
    assert run(spark, [x, y], [x, z]) == [("a.com", "1", "status")]
    assert run(spark, [x, y], [y, x]) == []
    assert {f for _, _, f in run(spark, [x, y], [x])} == {"domain", "status", "n", "copies"}
    swapped = [("a.com", 1, "x", 2.0), ("a.com", 1, "y", 1.0)]
    assert run(spark, [("a.com", 1, "x", 1.0), ("a.com", 1, "y", 2.0)], swapped) == [("a.com", "1", "rows")]


def test_key_of_very_many_rows_spreads(spark):
    b = spark.range(30_000).selectExpr("IF(id % 3 = 0, 'hot.com', concat(id, '.com')) AS domain", "1 AS run_no", "concat('s', id % 5000) AS status", "double(id) AS n")
    c = b.withColumn("status", F.expr("IF(n = 3333, 'other', status)"))
    out = diff_copies(b.repartition(6), c.repartition(3), {"domain": F.col("domain"), "run_no": F.col("run_no")}, FIELDS).collect()
    assert [tuple(r) for r in out] == [("hot.com", "1", "status")]


def test_multiset_and_schema(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("y", None)], "p string, q int")
    b = spark.createDataFrame([("x", 1), ("z", 2)], "p string, q int")
    assert {tuple(r) for r in multiset_diff(a, b).collect()} == {("removed", "x", "1", 1), ("removed", "y", None, 1), ("added", "z", "2", 1)}
    assert schema_difference(a, b.select("q", "p")) == {"only_base": [], "only_cand": [], "reordered": ["p", "q"]}
