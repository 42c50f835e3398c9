import importlib
import os
import subprocess
import sys

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_does_not_need_the_llm_subpackage():
    code = "import sys; sys.modules['typolens.llm'] = None; import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('p7') for q in e.queries()))"
    root = os.path.dirname(os.path.abspath(entry.__file__))
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True)
    assert out.stdout.split()[-1] == "False", out.stderr
    for base, _, files in os.walk(os.path.join(root, "typolens")):
        if "llm" not in base.split(os.sep):
            for f in files:
                if f.endswith(".py"):
                    assert "typolens.llm" not in open(os.path.join(base, f), encoding="utf-8").read()


@pytest.mark.skipif(not os.path.exists(SMALL), reason="no test tables")
def test_flagship(spark):
    df = importlib.import_module("__spark_entry__").entry(spark)
    assert df.limit(5).count() == 5 and "final_score" in df.columns
