import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from typolens.functions.keys import reference_key
from typolens.operators.orphans import compress_runs, orphan_references, orphans_by_period

T0 = datetime(2026, 1, 1)
REFS = "table_name string, row_id long, ref_field string, parent string, key string, ref_at timestamp_ntz"
PARENTS = "parent string, key string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def day(n):
    return T0 + timedelta(days=n)


def brute(refs, parents):
    out = set()
    for t, i, f, p, k, at in refs:
        if k is None:
            continue
        own = [x for x in parents if x[0] == p and x[1] == k]
        if not own:
            out.add((i, f, "missing"))
        elif at is not None and not any(a <= at and (b is None or b > at) for _, _, a, b in own):
            out.add((i, f, "late" if all(a > at for _, _, a, _ in own) else "deleted"))
    return out


def run(spark, refs, parents, **kw):
    got = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame(parents, PARENTS), **kw).collect()
    return {(r["row_id"], r["ref_field"], r["reason"]) for r in got}


def test_reasons_and_edges(spark):
    parents = [("a", "k", day(10), day(20)), ("a", "k", day(20), day(30)), ("a", "k", day(40), None), ("b", "k", day(0), None), ("a", "z", day(5), day(5))]
    refs = [("t", i, "f", "a", "k", day(d)) for i, d in enumerate((9, 10, 19, 20, 29, 30, 39, 40, 900))] + [("t", 50, "f", "a", "z", day(5)), ("t", 51, "f", "a", None, day(5)), ("t", 52, "f", "a", "k", None), ("t", 53, "f", "a", "none", None)]
    got = run(spark, refs, parents)
    assert got == {(0, "f", "late"), (5, "f", "deleted"), (6, "f", "deleted"), (50, "f", "deleted"), (53, "f", "missing")} == brute(refs, parents)


def test_random_against_brute_force(spark):
    r = random.Random(3)
    parents = [(r.choice("ab"), r.choice("klmn"), day(a := r.randrange(60)), None if r.random() < 0.2 else day(a + r.randrange(8))) for _ in range(60)]
    refs = [("t", i, "f", r.choice("ab"), "k" if r.random() < 0.5 else r.choice("klmnopq"), day(r.randrange(-3, 70))) for i in range(400)]
    want = brute(refs, parents)
    assert run(spark, refs, parents) == want
    assert run(spark, refs, parents, rows_per_salt=3) == want


def test_empty_and_repeated(spark):
    refs = [("t", 1, "f", "a", "k", day(1))] * 2
    assert run(spark, refs, []) == {(1, "f", "missing")}
    assert run(spark, [], [("a", "k", day(1), None)]) == set()
    found = orphan_references(spark.createDataFrame(refs, REFS), spark.createDataFrame([], PARENTS))
    assert [tuple(x) for x in orphans_by_period(found).collect()] == [("t", "f", "2026-01", "missing", 2)]


def test_runs_are_contiguous(spark):
    rows = [("a", "k", day(0), day(5)), ("a", "k", day(3), day(9)), ("a", "k", day(9), day(40)), ("a", "k", day(50), None), ("a", "k", None, None)]
    got = sorted((x["run_no"], x["run_start"], x["run_end"].year) for x in compress_runs(spark.createDataFrame(rows, PARENTS)).collect())
    assert [(n, s) for n, s, _ in got][:2] == [(1, day(0)), (2, day(50))] and len(got) == 2


def test_key_spellings(spark):
    rows = [("﻿ Www.X.com ",), ("nan",), ("  ",), (None,), (" y.COM\t",)]
    got = [r[0] for r in spark.createDataFrame(rows, "c string").select(reference_key(F.col("c"))).collect()]
    assert got == ["www.x.com", None, None, None, "y.com"]


def test_integer_runs_and_orphans(spark):
    from typolens.operators.orphans import integer_orphans, integer_runs

    r = random.Random(3)
    parents = [r.randrange(-300, 300) for _ in range(400)] + list(range(60_000, 70_000)) + [2**40, None]
    refs = [(i, r.choice([r.randrange(-400, 400), r.randrange(59_990, 70_010), 2**40, 2**40 + 1, None]), "x") for i in range(800)]
    p = spark.createDataFrame([(k,) for k in parents], "key long").repartition(5)
    d = spark.createDataFrame(refs, "row_id long, key long, run_end string")
    runs = sorted(tuple(x) for x in integer_runs(p).collect())
    keys = sorted({k for k in parents if k is not None})
    assert {k for a, b in runs for k in range(a, b + 1)} == set(keys) and all(b + 1 < c for (_, b), (c, _) in zip(runs, runs[1:]))
    got = sorted(x["row_id"] for x in integer_orphans(d, p).collect())
    assert got == [i for i, k, _ in refs if k is not None and k not in set(keys)]
    assert integer_orphans(d, p.limit(0)).count() == sum(k is not None for _, k, _ in refs) and integer_orphans(d.limit(0), p).collect() == []
