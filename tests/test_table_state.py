"""The table on storage decides: lost registrations, readers, re-runs,
upserts by files, widened schemas, replace by condition, batches."""

import datetime as dt
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.schemas import fit, reconcile
from quarry.plans import reports  # noqa: F401  (registers the transforms)
from quarry.plans.job import run
from quarry.sinks import versions, write_output
from quarry.sinks import tables as tables_module
from quarry.sinks.tables import TableSink, table_location, view_base
from quarry.sources import read_files, read_table
from tests.test_versions import frame, rows, sink, upsert

KVP = "k int, v string, p int"


def failing_registration(monkeypatch):
    def fail(*args, **kwargs):
        raise RuntimeError("the metastore timed out")

    monkeypatch.setattr(tables_module, "register_table", fail)


# ------------------------------------------------- registrations that were lost
@pytest.mark.parametrize("scope", ["partitions", "table"])
def test_upsert_keeps_rows_whose_registration_failed(spark, workdir, monkeypatch, scope):
    name = f"fr{scope}"
    cfg = sink(workdir, name, "append", partition_by=["p"])
    write_output(spark, frame(spark, [(1, "a", 1)], KVP), cfg)
    failing_registration(monkeypatch)
    with pytest.raises(RuntimeError):
        write_output(spark, frame(spark, [(2, "b", 2), (3, "c", 2)], KVP), cfg)
    monkeypatch.undo()
    write_output(spark, frame(spark, [(4, "d", 2)], KVP), {**upsert(workdir, name, upsert_scope=scope), "partition_by": ["p"], "primary_key": ["k", "p"]})
    want = [(1, "a", 1), (2, "b", 2), (3, "c", 2), (4, "d", 2)]
    assert rows(spark.table(f"db_{name}.t")) == want
    assert rows(read_files(spark, {"path": cfg["path"]}).select("k", "v", "p")) == want


def test_upsert_with_an_entry_of_another_session(spark, workdir):
    """Each session has its own catalog: this one's entry knows neither the
    partition nor the column that another one added."""
    cfg = sink(workdir, "fs", "append", partition_by=["p"], merge_schema=True)
    write_output(spark, frame(spark, [(1, "a", 1)], KVP), cfg)
    other = {**cfg, "table_name": "db_fs.other"}  # another entry of the same folder
    write_output(spark, spark.createDataFrame([(2, "b", "w", 2)], "k int, v string, w string, p int"), other)
    write_output(spark, frame(spark, [(1, "A", 1)], KVP), {**upsert(workdir, "fs", upsert_scope="table"), "partition_by": ["p"], "primary_key": ["k", "p"]})
    got = read_table(spark, {"table": "db_fs.t"}).select("k", "v", "p", "w")
    assert rows(got) == [(1, "A", 1, None), (2, "b", 2, "w")]


def test_a_batch_is_appended_once(spark, workdir, monkeypatch):
    cfg = sink(workdir, "fb", "append", partition_by=["p"], batch_id="load ${run_date}")
    write_output(spark, frame(spark, [(1, "a", 1)], KVP), cfg, "2024-01-01")
    failing_registration(monkeypatch)
    with pytest.raises(RuntimeError):
        write_output(spark, frame(spark, [(2, "b", 2)], KVP), cfg, "2024-01-02")
    monkeypatch.undo()
    for _ in range(2):  # tried again
        write_output(spark, frame(spark, [(2, "b", 2)], KVP), cfg, "2024-01-02")
    assert rows(spark.table("db_fb.t")) == [(1, "a", 1), (2, "b", 2)]


# ---------------------------------------------------------------- readers
def test_readers_follow_the_version(spark, workdir):
    cfg = sink(workdir, "rv", "append")
    write_output(spark, frame(spark, [(1, "a"), (2, "b")]), cfg)
    assert rows(read_files(spark, {"path": cfg["path"]})) == [(1, "a"), (2, "b")]
    write_output(spark, frame(spark, [(2, "B"), (3, "c")]), upsert(workdir, "rv"))
    want = [(1, "a"), (2, "B"), (3, "c")]
    assert rows(read_files(spark, {"path": cfg["path"]})) == want
    assert rows(read_table(spark, {"table": "db_rv.t"})) == want
    spark.sql("DROP TABLE db_rv.t")  # as in a fresh session
    assert rows(read_table(spark, {"table": "db_rv.t", "path": cfg["path"]})) == want
    # An entry that stayed behind, as after a failed change of it.
    spark.sql(f"CREATE TABLE db_rv.t (k int, v string) USING parquet LOCATION '{cfg['path']}'")
    assert rows(read_table(spark, {"table": "db_rv.t"})) == want


def test_a_table_that_began_with_an_upsert_is_read_by_path(spark, workdir):
    write_output(spark, frame(spark, [(1, "a")]), upsert(workdir, "rb"))
    assert rows(read_files(spark, {"path": f"{workdir}/rb"})) == [(1, "a")]


def test_reading_what_is_not_there_fails(spark, workdir):
    with pytest.raises(Exception, match="cannot be found"):
        read_table(spark, {"table": "no_such_db.t"})
    spark.range(2).createOrReplaceTempView("just_a_view")
    assert read_table(spark, {"table": "just_a_view"}).count() == 2


# ------------------------------------------------------------ upsert by files
def by_files(spark, workdir, name, n=400, files=8):
    cfg = sink(workdir, name, "overwrite")
    write_output(spark, spark.range(n).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")).repartitionByRange(files, "k"), cfg)
    return {**cfg, "mode": "upsert", "upsert_scope": "files", "primary_key": ["k"], "change_tracking_column": ["v"]}


def stamps(path):
    found = {}
    for d, _, names in os.walk(path.removeprefix("file:")):
        for n in names:
            if n.endswith(".parquet"):
                s = os.stat(f"{d}/{n}")
                found[n] = (s.st_ino, s.st_mtime_ns, s.st_size)
    return found


def test_untouched_files_are_the_same_files(spark, workdir, monkeypatch):
    cfg = by_files(spark, workdir, "uf")
    before = stamps(cfg["path"])
    names = set(before)
    puts = []
    real = versions._put_text
    monkeypatch.setattr(versions, "_put_text", lambda *a: (puts.append(a[2]), real(*a)))
    write_output(spark, frame(spark, [(5, "A"), (1000, "n")]), cfg)
    assert puts == ["_current"]  # one rename
    after = stamps(cfg["path"])
    assert {n: after[n] for n in names} == before  # carried over as they are
    state = versions.state(spark, cfg["path"])
    assert [len(p.dead) for p in state.parts] == [1, 0]
    want = sorted([(i, "A" if i == 5 else "a") for i in range(400)] + [(1000, "n")], key=repr)
    assert rows(spark.table("db_uf.t")) == want
    assert rows(read_files(spark, {"path": cfg["path"]})) == want
    used = {f.rpartition("/")[2] for f in spark.table("db_uf.t").inputFiles()}
    assert len(used & names) >= 7
    # Again: a file of the second part, another of the first; then inserts only.
    write_output(spark, frame(spark, [(1000, "N"), (399, "Z")]), cfg)
    write_output(spark, frame(spark, [(2000, "n")]), cfg)
    got = dict(rows(spark.table("db_uf.t")))
    assert len(got) == 402 and (got[5], got[399], got[1000], got[2000]) == ("A", "Z", "N", "n")


def test_a_table_in_parts_takes_every_other_write(spark, workdir):
    cfg = by_files(spark, workdir, "up")
    write_output(spark, frame(spark, [(5, "A")]), cfg)
    assert view_base(spark, "`db_up`.`t`") and table_location(spark, "`db_up`.`t`") is None
    write_output(spark, frame(spark, [(500, "x")]), {**cfg, "mode": "append"})
    assert rows(spark.table("db_up.t").where("k IN (5, 500) OR k = 6")) == [(5, "A"), (500, "x"), (6, "a")]
    spark.sql("DROP VIEW db_up.t")
    assert read_table(spark, {"table": "db_up.t", "path": cfg["path"]}).count() == 401
    write_output(spark, spark.createDataFrame([(501, "y", 1)], "k int, v string, w int"), {**cfg, "mode": "append", "merge_schema": True})
    assert rows(spark.table("db_up.t").where("k > 499")) == [(500, "x", None), (501, "y", 1)]
    # A whole rewrite makes it one folder and a plain table again.
    write_output(spark, spark.createDataFrame([(7, "S", 2)], "k int, v string, w int"), {**cfg, "upsert_scope": "table"})
    assert versions.state(spark, cfg["path"]).whole and table_location(spark, "`db_up`.`t`")
    assert spark.table("db_up.t").count() == 402
    write_output(spark, frame(spark, [(8, "E")]), {**cfg, "merge_schema": True})
    write_output(spark, frame(spark, [(1, "o")]), {**cfg, "mode": "overwrite"})
    assert rows(spark.table("db_up.t")) == [(1, "o")]
    assert rows(read_files(spark, {"path": cfg["path"]})) == [(1, "o")]


def test_many_touched_files_are_a_whole_rewrite(spark, workdir):
    cfg = by_files(spark, workdir, "uw")
    write_output(spark, spark.range(0, 400, 10).select(F.col("id").cast("int").alias("k"), F.lit("b").alias("v")), cfg)
    assert versions.state(spark, cfg["path"]).whole
    assert spark.table("db_uw.t").groupBy("v").count().orderBy("v").collect() == [("a", 360), ("b", 40)]


def test_upsert_by_files_checks_duplicates_and_nulls(spark, workdir):
    cfg = by_files(spark, workdir, "ud")
    with pytest.raises(ValueError, match="several source rows"):
        write_output(spark, frame(spark, [(5, "A"), (5, "B")]), cfg)
    write_output(spark, frame(spark, [(None, "n"), (None, "n"), (900, "x"), (900, "x")]), cfg)
    assert spark.table("db_ud.t").count() == 404


# ----------------------------------------------------- replace by condition
def test_replace_where(spark, workdir):
    schema = "k int, d date"
    cfg = sink(workdir, "rw", "overwrite", partition_by=["d"])
    day = lambda i: dt.date(2024, 1, i)
    write_output(spark, frame(spark, [(i, day(i)) for i in range(1, 8)] + [(9, None)], schema), cfg)
    cond = {"column": "d", "from": "2024-01-03", "to": "2024-01-05"}
    part = {**cfg, "mode": "overwrite_partition", "replace_where": cond}
    with pytest.raises(ValueError, match="outside"):
        write_output(spark, frame(spark, [(0, day(6))], schema), part)
    assert spark.table("db_rw.t").count() == 8
    write_output(spark, frame(spark, [(40, day(4)), (41, day(4))], schema), part)
    want = [(1, day(1)), (2, day(2)), (6, day(6)), (7, day(7)), (9, None), (40, day(4)), (41, day(4))]
    assert rows(spark.table("db_rw.t")) == rows(frame(spark, want, schema))
    assert rows(read_files(spark, {"path": cfg["path"]}).select("k", F.col("d").cast("date"))) == rows(frame(spark, want, schema))
    write_output(spark, frame(spark, [], schema), {**part, "replace_where": {"column": "d", "values": ["2024-01-04", "2024-01-01"]}})
    assert sorted(r.k for r in spark.table("db_rw.t").collect()) == [2, 6, 7, 9]
    with pytest.raises(ValueError, match="first partition column"):
        write_output(spark, frame(spark, [], schema), {**part, "replace_where": {"column": "k", "values": [1]}})


def test_a_replacement_that_died_is_finished(spark, workdir, monkeypatch):
    schema = "k int, p int"
    cfg = sink(workdir, "rd", "overwrite", partition_by=["p"])
    write_output(spark, frame(spark, [(i, i) for i in range(4)], schema), cfg)
    part = {**cfg, "mode": "overwrite_partition", "replace_where": {"column": "p", "from": 1, "to": 2}}
    monkeypatch.setattr(versions, "finish_replacing", lambda *a: (_ for _ in ()).throw(RuntimeError("the driver died")) if versions._read_text(*a[:1], f"{a[1]}/_versions/_replacing") else False)
    with pytest.raises(RuntimeError):
        write_output(spark, frame(spark, [(10, 1)], schema), part)
    monkeypatch.undo()
    write_output(spark, frame(spark, [(30, 3)], schema), {**cfg, "mode": "append"})
    assert sorted(map(tuple, spark.table("db_rd.t").select("k", "p").collect())) == [(0, 0), (3, 3), (10, 1), (30, 3)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(1, 3), st.integers(1, 10), st.integers(0, 6)), max_size=5), min_size=2, max_size=2))
def test_set_backfill_equals_the_loop(spark, workdir, sources):
    """Run twice over two sources: the second run replaces all its dates."""
    tag = f"{workdir}/{abs(hash(str(sources)))}"
    day = lambda i: dt.datetime(2024, 1, i)
    schema = "id long, customer_id long, status string, created_at timestamp_ntz, updated_at timestamp_ntz"
    results = []
    for form in (False, True):
        table = f"h{abs(hash((tag, form)))}"
        for source in sources:
            spark.createDataFrame([(i, c, "Completed", day(a), day(a + n)) for i, (c, a, n) in enumerate(source)], schema).createOrReplaceTempView("h_orders")
            run(spark, {
                "run_mode": {"name": "back_fill", "start": "2024-01-02", "end": "2024-01-12", "step": 2, "set_based": form},
                "extract": {"orders": {"reader": "TableReader", "table": "h_orders"}},
                "transform": {"transformer": "PyTransformer", "transformation": "daily_order_counts"},
                "load": {"daily_order_counts": {**sink(tag, table, "overwrite_partition"), "partition_by": ["run_date"]}},
            })
        results.append(rows(spark.table(f"db_{table}.t")))
    assert results[0] == results[1]


# ------------------------------------------------------------ schema growth
def test_reconcile():
    a = T._parse_datatype_string("s struct<x:int,y:array<struct<p:float>>>, m map<string,smallint>, d decimal(5,2)")
    b = T._parse_datatype_string("S struct<X:bigint,z:string,y:array<struct<p:double,q:int>>>, m map<string,int>, d decimal(8,4), n date")
    want = T._parse_datatype_string("s struct<x:bigint,y:array<struct<p:double,q:int>>,z:string>, m map<string,int>, d decimal(8,4), n date")
    assert reconcile(a, b) == want
    for old, new in (("string", "int"), ("bigint", "double"), ("map<int,int>", "map<bigint,int>"), ("decimal(38,0)", "decimal(38,9)"), ("struct<a:int>", "array<int>")):
        with pytest.raises(ValueError):
            reconcile(T._parse_datatype_string(old), T._parse_datatype_string(new))
    with pytest.raises(ValueError):
        reconcile(T.IntegerType(), T.LongType(), widen=False)


def test_fit(spark):
    df = spark.sql("SELECT named_struct('x', 1, 'y', array(named_struct('p', 1.5F))) AS s UNION ALL SELECT NULL")
    want = T._parse_datatype_string("struct<z:string,y:array<struct<q:int,p:double>>,x:bigint>")
    got = df.select(fit(F.col("s"), df.schema["s"].dataType, want).alias("s"))
    assert got.schema["s"].dataType.simpleString() == want.simpleString()
    assert sorted(map(repr, (r.s for r in got.collect()))) == ["None", "Row(z=None, y=[Row(q=None, p=1.5)], x=1)"]


def test_widened_and_nested_appends(spark, workdir):
    cfg = sink(workdir, "sw", "append", partition_by=["p"])
    old = spark.sql("SELECT 1 AS k, named_struct('a', 1, 'l', array(1)) AS s, 1.5F AS f, 1 AS p")
    new = spark.sql("SELECT 5000000000 AS k, named_struct('l', array(7000000000), 'a', 2, 'b', 'x') AS s, 2.5D AS f, 2 AS p")
    write_output(spark, old, cfg)
    for missing in ({}, {"merge_schema": True}, {"widen_types": True}):
        with pytest.raises(ValueError, match="types differ"):
            write_output(spark, new, {**cfg, **missing})
    with pytest.raises(ValueError, match="types differ"):  # folder names have no type to widen
        write_output(spark, old.withColumn("p", F.col("p").cast("long")), {**cfg, "widen_types": True})
    write_output(spark, new, {**cfg, "merge_schema": True, "widen_types": True})
    want = ["Row(k=1, s=Row(a=1, l=[1], b=None), f=1.5, p=1)", "Row(k=5000000000, s=Row(a=2, l=[7000000000], b='x'), f=2.5, p=2)"]
    assert sorted(map(repr, spark.table("db_sw.t").collect())) == want
    # Narrow data still fits, and a session without the entry reads the same.
    write_output(spark, old, {**cfg, "merge_schema": True, "widen_types": True})
    spark.sql("DROP TABLE db_sw.t")
    assert sorted({*map(repr, read_table(spark, {"table": "db_sw.t", "path": cfg["path"]}).collect())}) == want
    write_output(spark, new, {**cfg, "mode": "upsert", "primary_key": ["k", "p"], "change_tracking_column": ["f"]})
    assert sorted({*map(repr, spark.table("db_sw.t").collect())}) == want


def test_sink_reads_its_declared_schema(spark, workdir):
    cfg = sink(workdir, "sd", "append")
    write_output(spark, frame(spark, [(1, "a")]), cfg)
    stored = TableSink(spark, cfg)._stored(T.StructType())
    assert stored.schema.simpleString() == "struct<k:int,v:string>"
