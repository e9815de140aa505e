"""What must survive upserts, registration, lost catalog entries and
overwrites of a table's own input."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.merge import plan_merge
from quarry.sinks import versions, write_output
from quarry.sinks.tables import TableSink, table_location

KV = "k int, v string"


def sink(workdir, name, mode, **extra):
    return {"writer": "ParquetWriter", "mode": mode, "table_name": f"db_{name}.t", "path": f"{workdir}/{name}",
            "database_location": f"{workdir}/{name}.db", **extra}


def upsert(workdir, name, **extra):
    return sink(workdir, name, "upsert", primary_key=["k"], change_tracking_column=["v"], **extra)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def frame(spark, data, schema=KV):
    return spark.createDataFrame(data, schema)


def test_first_does_not_undo_an_upsert(spark, workdir):
    write_output(spark, frame(spark, [(1, "a"), (2, "b")]), sink(workdir, "vf", "append", first=True))
    write_output(spark, frame(spark, [(1, "A"), (3, "c")]), upsert(workdir, "vf"))
    write_output(spark, frame(spark, [(9, "z")]), sink(workdir, "vf", "append", first=True))
    assert rows(spark.table("db_vf.t")) == [(1, "A"), (2, "b"), (3, "c"), (9, "z")]


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_upsert_without_a_catalog_entry(spark, workdir, partition_by):
    name, schema = "vn" + "p" * len(partition_by), "k int, v string, p string"
    more = {"partition_by": partition_by, "upsert_scope": "table"}
    write_output(spark, frame(spark, [(1, "a", "007"), (2, "b", "x")], schema), sink(workdir, name, "append", partition_by=partition_by))
    for k, v, p in ((1, "A", "007"), (3, "c", "1")):
        spark.sql(f"DROP TABLE db_{name}.t")
        write_output(spark, frame(spark, [(k, v, p)], schema), upsert(workdir, name, **more))
    assert rows(spark.table(f"db_{name}.t").select("k", "v", "p")) == [(1, "A", "007"), (2, "b", "x"), (3, "c", "1")]


def test_files_that_cannot_be_read_are_not_taken_for_an_empty_table(spark, workdir):
    spark.range(3).write.json(f"{workdir}/vb")
    with pytest.raises(Exception):
        write_output(spark, frame(spark, [(1, "a")]), upsert(workdir, "vb"))


@pytest.mark.parametrize("step", ["RENAME", "SET LOCATION", "CREATE TABLE"])
def test_a_failed_repointing_leaves_a_readable_table(spark, workdir, monkeypatch, step):
    name = "vq" + step[0].lower()
    partition_by = ["v"] if step != "SET LOCATION" else []
    write_output(spark, frame(spark, [(1, "a")]), sink(workdir, name, "append", partition_by=partition_by))
    real, failed = spark.sql, []

    def failing(text, *args, **kwargs):
        if f"db_{name}" in text and step in text and "DATABASE" not in text:
            if step != "RENAME" or text.endswith("TO `db_" + name + "`.`t`") and not failed:
                failed.append(text)
                raise RuntimeError("the metastore is away")
        return real(text, *args, **kwargs)

    cfg = upsert(workdir, name, partition_by=partition_by, upsert_scope="table")
    cfg["change_tracking_column"] = []
    monkeypatch.setattr(spark, "sql", failing)
    with pytest.raises(RuntimeError):
        write_output(spark, frame(spark, [(2, "b")]), cfg)
    monkeypatch.undo()
    assert failed
    assert rows(spark.table(f"db_{name}.t")) == [(1, "a")]  # the old version
    write_output(spark, frame(spark, [(3, "c")]), cfg)  # starts from the version named on storage
    assert rows(spark.table(f"db_{name}.t")) == [(1, "a"), (2, "b"), (3, "c")]


def test_appends_keep_the_schema(spark, workdir):
    write_output(spark, frame(spark, [(1, "a")]), sink(workdir, "vs", "append"))
    write_output(spark, frame(spark, [(2,)], "K int"), sink(workdir, "vs", "append", first=True))
    assert rows(spark.table("db_vs.t")) == [(1, "a"), (2, None)]
    for data, schema, text in (([(3, "w", 1)], "k int, v string, w int", "no columns"), ([(3, 4)], "k int, v int", "types differ")):
        for mode in ("append", "overwrite_partition"):
            with pytest.raises(ValueError, match=text):
                write_output(spark, frame(spark, data, schema), sink(workdir, "vs", mode))
    assert rows(spark.table("db_vs.t")) == [(1, "a"), (2, None)]
    write_output(spark, frame(spark, [(3, 7)], "k int, w int"), sink(workdir, "vs", "append", merge_schema=True))
    assert rows(spark.table("db_vs.t")) == sorted([(1, "a", None), (2, None, None), (3, None, 7)], key=repr)


def test_schema_is_kept_without_a_table_name(spark, workdir):
    cfg = {"writer": "ParquetWriter", "mode": "append", "path": f"{workdir}/bare"}
    write_output(spark, frame(spark, [(1, "a")]), cfg)
    with pytest.raises(ValueError, match="types differ"):
        write_output(spark, frame(spark, [("x", "a")], "k string, v string"), cfg)


@pytest.mark.parametrize("folder", ["with space", "größe'q", "a%20b", "p=1"])
def test_overwrite_of_its_own_input(spark, workdir, folder):
    cfg = {**sink(workdir, "vo" + folder.encode().hex(), "overwrite"), "path": f"{workdir}/{folder}"}
    write_output(spark, frame(spark, [(1, "a"), (2, "b")]), cfg)
    name = cfg["table_name"]
    write_output(spark, spark.table(name).filter("k = 1"), cfg)
    assert rows(spark.table(name)) == [(1, "a")]
    write_output(spark, spark.read.parquet(TableSink(spark, cfg).path()).withColumn("v", F.upper("v")), cfg)
    assert rows(spark.table(name)) == [(1, "A")]
    bare = {k: v for k, v in cfg.items() if k != "table_name"}
    with pytest.raises(ValueError, match="read from it"):
        write_output(spark, spark.read.parquet(TableSink(spark, bare).path()), bare)
    assert rows(spark.table(name)) == [(1, "A")]


def test_roots_are_found_without_listing_files(spark, workdir, monkeypatch):
    write_output(spark, frame(spark, [(i, str(i)) for i in range(40)]).repartition(20), sink(workdir, "vr", "overwrite"))
    df = spark.table("db_vr.t").join(spark.range(5), F.col("k") == F.col("id"))
    monkeypatch.setattr(type(df), "inputFiles", lambda self: pytest.fail("lists every file"))
    assert len(versions.root_paths(df)) == 1
    assert versions.reads_path(df, f"{workdir}/vr") and not versions.reads_path(df, f"{workdir}/v")


def test_partitioned_upsert_reads_only_touched_partitions(spark, workdir):
    schema = "k int, v string, p int"
    cfg = {**upsert(workdir, "vp"), "partition_by": ["p"], "primary_key": ["k", "p"]}
    write_output(spark, frame(spark, [(i, "a", i % 10) for i in range(100)], schema), {**cfg, "mode": "overwrite"})
    read = []
    real = TableSink._layout

    def spying(self, df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        read.append(plan)
        return real(self, df)

    TableSink._layout = spying
    try:
        write_output(spark, frame(spark, [(3, "A", 3), (103, "n", 3), (7, "A", 7)], schema), cfg)
    finally:
        TableSink._layout = real
    assert "PartitionFilters: [" in read[0] and "p#" in read[0].split("PartitionFilters: [")[1].split("]")[0]
    files = spark.table("db_vp.t").filter(F.col("p").isin([3, 7])).inputFiles()
    assert {f.split("p=")[1].split("/")[0] for f in files} == {"3", "7"}
    got = rows(spark.table("db_vp.t"))
    assert len(got) == 101 and (3, "A", 3) in got and (103, "n", 3) in got and (7, "A", 7) in got and (13, "a", 3) in got


def test_merge_reads_the_target_once(spark, workdir):
    spark.range(500).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v")).write.parquet(f"{workdir}/once")
    target = spark.read.parquet(f"{workdir}/once")
    source = spark.range(250, 900).select(F.col("id").cast("int").alias("K"), F.lit("b").alias("V"))  # keys compare without case
    merged = plan_merge(target, source, ["k"], ["v"], broadcast_bytes=0)
    plan = merged._jdf.queryExecution().optimizedPlan()
    leaves = [plan.collectLeaves().apply(i).getClass().getSimpleName() for i in range(plan.collectLeaves().length())]
    assert leaves.count("LogicalRelation") == 1
    assert merged.groupBy("v").count().orderBy("v").collect() == [("a", 250), ("b", 650)]


def test_null_keys_are_spread(spark):
    target = frame(spark, [(None, str(i)) for i in range(50)] + [(1, "a")])
    source = frame(spark, [(None, "n"), (1, "b"), (2, "c")])
    got = plan_merge(target, source, ["k"], ["v"], broadcast_bytes=0)
    assert rows(got) == rows(frame(spark, [(None, str(i)) for i in range(50)] + [(1, "b"), (None, "n"), (2, "c")]))


def test_bucketed_overwrite_writes_a_file_per_bucket(spark, workdir):
    cfg = {**sink(workdir, "vk", "overwrite"), "bucket_by": {"columns": ["k"], "buckets": 4}}
    write_output(spark, frame(spark, [(i, "a") for i in range(400)]).repartition(16), cfg)
    assert len(spark.table("db_vk.t").inputFiles()) <= 4


def test_bucketed_upsert_through_the_sink_keeps_the_buckets(spark, workdir, monkeypatch):
    cfg = {**upsert(workdir, "vz", broadcast_bytes=0), "bucket_by": {"columns": ["k"], "buckets": 4}}
    write_output(spark, frame(spark, [(i, "a") for i in range(400)]), {**cfg, "mode": "overwrite"})
    plans = []
    real = TableSink._save_bucketed_version

    def spying(self, df, aligned=False):
        plans.append((aligned, df._jdf.queryExecution().executedPlan().toString()))
        return real(self, df, aligned)

    monkeypatch.setattr(TableSink, "_save_bucketed_version", spying)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write_output(spark, frame(spark, [(i, "b") for i in range(350, 450)]), cfg)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    (aligned, plan), = plans
    # Exchanges stand over the source's files only.
    assert aligned and "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 2
    assert spark.table("db_vz.t").groupBy("v").count().orderBy("v").collect() == [("a", 350), ("b", 100)]
    assert len(spark.table("db_vz.t").inputFiles()) <= 8


def test_empty_rerun_of_a_date_clears_it(spark, workdir):
    schema = "k int, run_date date"
    cfg = {**sink(workdir, "vd", "overwrite_partition"), "partition_by": ["run_date"]}
    for d in ("2024-01-01", "2024-01-02"):
        write_output(spark, spark.sql(f"SELECT 1 AS k, DATE '{d}' AS run_date"), cfg, d)
    write_output(spark, frame(spark, [], schema), cfg, "2024-01-01")
    assert [str(r.run_date) for r in spark.table("db_vd.t").collect()] == ["2024-01-02"]
    assert [str(r.run_date) for r in spark.read.parquet(f"{workdir}/vd").collect()] == ["2024-01-02"]


def test_upsert_leaves_no_source_copy(spark, workdir):
    import glob

    from quarry.session import scratch_root

    copies = lambda: set(glob.glob(f"{scratch_root(spark).removeprefix('file:')}/quarry/upsert_source-*"))
    before = copies()
    write_output(spark, frame(spark, [(1, "a")]), upsert(workdir, "vc"))
    assert copies() == before


def test_pointer_is_one_rename(spark, workdir):
    base = f"{workdir}/ptr"
    assert versions.current(spark, base) is None
    for _ in range(3):
        version = versions.new_version(base)
        versions.set_current(spark, version)
        assert versions.current(spark, base) == version
    assert table_location(spark, "no_such_table") is None
