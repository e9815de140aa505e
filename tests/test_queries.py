"""Every registered query against its SQL oracle (DuckDB) on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from quarry.operators.steps import apply_steps
from quarry.plans.catalogue import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v.isoformat() if hasattr(v, "isoformat") else v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    assert df.count() == 10


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_the_corpus_operators(tmp_path):
    """They are an optional part: without their folder and the pipeline, or
    without a library they import, the entry still imports and has the other
    queries. What is missing is said; any other error is not swallowed."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(f"{root}/quarry", tmp_path / "quarry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    ask = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    run = lambda: subprocess.run([sys.executable, "-c", ask], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert run().stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
    (tmp_path / "quarry/llm").mkdir()
    (tmp_path / "quarry/llm/__init__.py").write_text("")
    (tmp_path / "quarry/llm/queries.py").write_text("import no_such_module")
    missing = run()
    assert "no_such_module" in missing.stderr and missing.stdout.split() == [str(len(QUERIES)), str(len(ORACLE))]
    (tmp_path / "quarry/llm/queries.py").write_text("1 / 0")
    assert "ZeroDivisionError" in run().stderr


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert canon(df.columns, got) == canon(cols, want)


def test_sample_is_a_seeded_subset_of_the_right_size(spark):
    # No other engine reproduces Spark's random stream, so the sample is
    # checked by its properties: repeatable for a seed, a subset of the
    # table, and of the expected size (within five standard deviations).
    step = {"orders": [{"op": "sample", "args": {"fraction": 0.1, "seed": 42}}]}
    source = {"orders": spark.read.parquet(f"{SF}/orders.parquet")}
    a, b = (apply_steps(spark, source, step)["orders"] for _ in range(2))
    keys = [r.o_orderkey for r in a.select("o_orderkey").collect()]
    assert sorted(keys) == sorted(r.o_orderkey for r in b.select("o_orderkey").collect())
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    n = orders.count()
    assert a.join(orders, "o_orderkey", "left_anti").count() == 0
    assert len(set(keys)) == len(keys)
    mean, sd = 0.1 * n, math.sqrt(n * 0.1 * 0.9)
    assert abs(len(keys) - mean) <= 5 * sd
