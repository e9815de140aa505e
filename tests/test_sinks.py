import pytest

from quarry.sinks import write_output
from quarry.sinks.tables import split_table_name, table_location


def sink(workdir, name, mode, **kw):
    return {"writer": "ParquetWriter", "mode": mode, "table_name": f"db_{name}.t", "path": f"{workdir}/{name}",
            "database_location": f"{workdir}/db_{name}.db", **kw}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_split_table_name():
    assert split_table_name("t") == (None, "t")
    assert split_table_name("db.t") == ("db", "t")
    assert split_table_name("spark_catalog.db.t") == ("db", "t")
    with pytest.raises(ValueError):
        split_table_name("a.b.c.d")


def test_append_then_overwrite(spark, workdir):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, "y")], "k int, v string")
    cfg = sink(workdir, "ao", "append", first=True)
    write_output(spark, a, cfg)
    write_output(spark, b, {**cfg, "first": False})
    assert rows(spark.table("db_ao.t")) == [(1, "x"), (2, "y")]
    write_output(spark, b, {**cfg, "mode": "overwrite", "first": False})
    assert rows(spark.table("db_ao.t")) == [(2, "y")]


def test_partition_overwrite_keeps_other_partitions_and_full_overwrite_drops_them(spark, workdir):
    df = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], "k int, v string, y int")
    cfg = sink(workdir, "po", "overwrite", partition_by=["y"], first=True)
    write_output(spark, df, cfg)
    new = spark.createDataFrame([(3, "c", 2021)], "k int, v string, y int")
    write_output(spark, new, {**cfg, "mode": "overwrite_partition", "first": False})
    assert rows(spark.table("db_po.t")) == [(1, "a", 2020), (3, "c", 2021)]
    write_output(spark, new, {**cfg, "mode": "overwrite", "first": False})
    assert rows(spark.table("db_po.t")) == [(3, "c", 2021)]


def test_upsert_creates_then_merges_and_repoints(spark, workdir):
    cfg = sink(workdir, "up", "upsert", primary_key=["k"], change_tracking_column=["v"])
    write_output(spark, spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int"), cfg)
    first = table_location(spark, "db_up.t")
    assert rows(spark.table("db_up.t")) == [(1, "a", 10), (2, "b", 20)]
    write_output(spark, spark.createDataFrame([(2, "z", 99), (3, "c", 30)], "k int, v string, n int"), cfg)
    assert rows(spark.table("db_up.t")) == [(1, "a", 10), (2, "z", 20), (3, "c", 30)]
    assert table_location(spark, "db_up.t") != first
    # the previous version is still intact on disk
    assert rows(spark.read.parquet(first)) == [(1, "a", 10), (2, "b", 20)]


def test_upsert_with_empty_source_leaves_table(spark, workdir):
    cfg = sink(workdir, "ue", "upsert", primary_key=["k"], change_tracking_column=["v"])
    write_output(spark, spark.createDataFrame([(1, "a")], "k int, v string"), cfg)
    write_output(spark, spark.createDataFrame([], "k int, v string"), cfg)
    assert rows(spark.table("db_ue.t")) == [(1, "a")]


def test_schema_merge_on_append(spark, workdir):
    cfg = sink(workdir, "sm", "append", merge_schema=True)
    write_output(spark, spark.createDataFrame([(1,)], "k int"), {**cfg, "first": True})
    write_output(spark, spark.createDataFrame([(2, "b")], "k int, v string"), cfg)
    assert rows(spark.table("db_sm.t")) == [(1, None), (2, "b")]


def test_console_and_unknown_writer(spark, capsys):
    df = spark.createDataFrame([(1, "a" * 40)], "k int, v string")
    write_output(spark, df, {"writer": "ConsoleWriter", "mode": "append"})
    with pytest.raises(NotImplementedError):
        write_output(spark, df, {"writer": "ConsoleWriter", "mode": "upsert"})
    with pytest.raises(ValueError):
        write_output(spark, df, {"writer": "Nope", "mode": "append"})
    with pytest.raises(ValueError):
        write_output(spark, df, {"writer": "ConsoleWriter", "mode": "merge"})


def test_delta_writer_needs_delta_or_another_format(spark, workdir):
    cfg = {**sink(workdir, "dw", "overwrite", first=True), "writer": "DeltaWriter"}
    with pytest.raises(ValueError, match="delta is not configured"):
        write_output(spark, spark.createDataFrame([(1,)], "k int"), cfg)
    write_output(spark, spark.createDataFrame([(1,)], "k int"), {**cfg, "format": "parquet"})
    assert rows(spark.read.parquet(f"{workdir}/dw")) == [(1,)]


def test_json_events_round_trip(spark, workdir):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(7, "click", 1.5)], "user_id long, kind string, v double")
    write_output(spark, df, {"writer": "JsonWriter", "mode": "overwrite", "path": f"{workdir}/ev",
                             "key_columns": ["user_id"]})
    back = spark.read.schema("key string, value string").json(f"{workdir}/ev")
    r = back.select("key", F.get_json_object("value", "$.kind").alias("kind")).first()
    assert (r.key, r.kind) == ("7", "click")


def test_overwrite_of_a_table_from_itself_keeps_data(spark, workdir):
    from pyspark.sql import functions as F

    cfg = sink(workdir, "self", "overwrite", first=True)
    write_output(spark, spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), cfg)
    current = spark.table("db_self.t")
    write_output(spark, current.withColumn("v", F.upper("v")), {**cfg, "first": False})
    assert rows(spark.table("db_self.t")) == [(1, "A"), (2, "B")]


def test_partition_scoped_upsert_touches_only_source_partitions(spark, workdir):
    schema = "k int, y int, v string"
    cfg = sink(workdir, "pu", "overwrite", partition_by=["y"], first=True)
    write_output(spark, spark.createDataFrame([(1, 2020, "a"), (2, 2021, "b"), (3, None, "n")], schema), cfg)
    up = {**cfg, "mode": "upsert", "first": False, "primary_key": ["k", "y"], "change_tracking_column": ["v"]}
    write_output(spark, spark.createDataFrame([(2, 2021, "z"), (4, 2021, "d"), (5, None, "m")], schema), up)
    assert sorted(rows(spark.table("db_pu.t")), key=repr) == sorted(
        [(1, "a", 2020), (2, "z", 2021), (4, "d", 2021), (3, "n", None), (5, "m", None)], key=repr)


def test_catalog_sees_partitions_each_write_adds_or_removes(spark, workdir):
    # Partitions new to a registered table must be visible through the
    # catalog after append, partition overwrite and upsert; a full
    # overwrite must drop the partitions it deleted.
    schema = "k int, v string, y int"
    cfg = sink(workdir, "np", "append", partition_by=["y"], first=True)
    write_output(spark, spark.createDataFrame([(1, "a", 2020)], schema), cfg)
    cfg = {**cfg, "first": False}
    write_output(spark, spark.createDataFrame([(2, "b", 2021)], schema), cfg)
    assert rows(spark.table("db_np.t")) == [(1, "a", 2020), (2, "b", 2021)]
    write_output(spark, spark.createDataFrame([(3, "c", 2022)], schema), {**cfg, "mode": "overwrite_partition"})
    assert rows(spark.table("db_np.t")) == [(1, "a", 2020), (2, "b", 2021), (3, "c", 2022)]
    up = {**cfg, "mode": "upsert", "primary_key": ["k", "y"], "change_tracking_column": ["v"]}
    write_output(spark, spark.createDataFrame([(3, "d", 2022), (4, "e", 2023)], schema), up)
    assert rows(spark.table("db_np.t")) == [(1, "a", 2020), (2, "b", 2021), (3, "d", 2022), (4, "e", 2023)]
    write_output(spark, spark.createDataFrame([(5, "f", 2024)], schema), {**cfg, "mode": "overwrite"})
    assert rows(spark.table("db_np.t")) == [(5, "f", 2024)]
    assert [r[0] for r in spark.sql("SHOW PARTITIONS db_np.t").collect()] == ["y=2024"]


def test_partitioned_writes_are_rebalanced_per_value(spark, workdir):
    import os

    df = spark.range(0, 4000, numPartitions=8).selectExpr("id AS k", "CAST(id % 4 AS INT) AS y")
    for rebalance, most in ((True, 2), (False, 8)):
        cfg = sink(workdir, f"rb{int(rebalance)}", "overwrite", partition_by=["y"], first=True, rebalance=rebalance)
        write_output(spark, df, cfg)
        per_value = [len([f for f in os.listdir(f"{cfg['path']}/y={v}") if f.endswith(".parquet")]) for v in range(4)]
        assert max(per_value) <= most and (rebalance or max(per_value) == 8)
        assert spark.table(f"db_rb{int(rebalance)}.t").count() == 4000


def test_bucketed_table_append_overwrite_upsert(spark, workdir):
    schema = "k int, v string"
    cfg = sink(workdir, "bk", "overwrite", bucket_by={"columns": ["k"], "buckets": 4})
    write_output(spark, spark.createDataFrame([(1, "a"), (2, "b")], schema), cfg)
    write_output(spark, spark.createDataFrame([(3, "c")], schema), {**cfg, "mode": "append"})
    assert rows(spark.table("db_bk.t")) == [(1, "a"), (2, "b"), (3, "c")]
    up = {**cfg, "mode": "upsert", "primary_key": ["k"], "change_tracking_column": ["v"], "broadcast_bytes": 0}
    write_output(spark, spark.createDataFrame([(2, "B"), (4, "d")], schema), up)
    assert rows(spark.table("db_bk.t")) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    meta = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED db_bk.t").collect()}
    assert meta["Num Buckets"] == "4" and "/_versions/" in meta["Location"]
    write_output(spark, spark.createDataFrame([(9, "z")], schema), cfg)  # overwrite reading nothing of the table
    assert rows(spark.table("db_bk.t")) == [(9, "z")]
    write_output(spark, spark.createDataFrame([(8, "y")], schema), {**cfg, "mode": "overwrite_partition"})
    assert rows(spark.table("db_bk.t")) == [(8, "y")]  # unpartitioned: the whole table


def test_bucketed_upsert_never_shuffles_the_target(spark, workdir):
    from quarry.operators.merge import merge_changes

    o = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").select("o_orderkey", "o_orderstatus")
    cfg = sink(workdir, "bkp", "overwrite", bucket_by={"columns": ["o_orderkey"], "buckets": 8})
    write_output(spark, o, cfg)
    source = o.filter("o_orderstatus = 'O'").selectExpr("o_orderkey", "'X' AS o_orderstatus")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_changes(spark.table("db_bkp.t"), source, ["o_orderkey"], ["o_orderstatus"])
        text = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert text.count("Bucketed: true") == 2
    # the only shuffles are of the source (once per branch)
    assert text.count("Exchange hashpartitioning") == 2
    for block in text.split("Exchange hashpartitioning")[1:]:
        scan = block[block.index("FileScan"):].split("\n")[0]
        assert "orders.parquet" in scan


@pytest.mark.parametrize("schema,first,later", [
    ("k int, p string", [(1, "plain")], [(2, "a b"), (3, "x/y"), (4, "it's"), (5, "k=v"), (6, "50%"), (7, "é")]),
    ("k int, p string", [(1, "007")], [(2, "08"), (3, "1e3")]),  # codes that look like numbers stay text
    ("k int, p date", [(1, "2024-01-01")], [(2, "2024-01-02"), (3, "2024-12-31")]),
    ("k int, p bigint", [(1, 1)], [(2, -5), (3, 10**12)]),
])
def test_added_partitions_are_named_like_the_folders_written(spark, workdir, schema, first, later):
    import datetime as dt

    def frame(data):
        if "date" in schema:
            data = [(k, dt.date.fromisoformat(p)) for k, p in data]
        return spark.createDataFrame(data, schema)

    name = f"ap{abs(hash((schema, str(first)))) % 10**6}"
    cfg = sink(workdir, name, "append", partition_by=["p"], first=True)
    write_output(spark, frame(first), cfg)
    write_output(spark, frame(later), {**cfg, "first": False})
    write_output(spark, frame(later[:1]), {**cfg, "first": False, "mode": "overwrite_partition"})
    back = spark.table(f"db_{name}.t")
    assert back.schema["p"].dataType == frame(first).schema["p"].dataType
    assert sorted(r.k for r in back.collect()) == sorted([k for k, _ in first] + [k for k, _ in later])
    if "string" in schema:
        assert sorted(r.p for r in back.collect()) == sorted(str(p) for _, p in first + later)
    assert len(spark.sql(f"SHOW PARTITIONS db_{name}.t").collect()) == 1 + len(later)


def test_empty_writes_to_a_partitioned_table(spark, workdir):
    schema = "k int, p string"
    cfg = sink(workdir, "ew", "append", partition_by=["p"], first=True)
    write_output(spark, spark.createDataFrame([(1, "a")], schema), cfg)
    cfg = {**cfg, "first": False}
    write_output(spark, spark.createDataFrame([], schema), cfg)
    write_output(spark, spark.range(0).selectExpr("CAST(id AS INT) AS k", "'q' AS p"), {**cfg, "mode": "overwrite_partition"})
    assert rows(spark.table("db_ew.t")) == [(1, "a")]


def test_bucketed_and_partitioned_table(spark, workdir):
    schema = "k int, v string, y int"
    cfg = sink(workdir, "bkpart", "overwrite", partition_by=["y"], bucket_by={"columns": ["k"], "buckets": 2})
    write_output(spark, spark.createDataFrame([(1, "a", 2020), (2, "b", 2021)], schema), cfg)
    up = {**cfg, "mode": "upsert", "primary_key": ["k", "y"], "change_tracking_column": ["v"]}
    write_output(spark, spark.createDataFrame([(2, "B", 2021), (3, "c", 2022)], schema), up)
    write_output(spark, spark.createDataFrame([(4, "d", 2022)], schema), {**cfg, "mode": "append"})
    assert rows(spark.table("db_bkpart.t")) == [(1, "a", 2020), (2, "B", 2021), (3, "c", 2022), (4, "d", 2022)]
    assert spark.table("db_bkpart.t").filter("y = 2022").count() == 2
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    write_output(spark, spark.createDataFrame([(5, "e", 2021)], schema), {**cfg, "mode": "overwrite_partition"})
    assert rows(spark.table("db_bkpart.t")) == [(1, "a", 2020), (3, "c", 2022), (4, "d", 2022), (5, "e", 2021)]
    meta = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED db_bkpart.t").collect()}
    assert meta["Num Buckets"] == "2"


def test_registered_schema_with_awkward_names(spark, workdir):
    df = spark.createDataFrame([(1, (2, "x"), "p q")], "`a b` int, s struct<`x y`: int, z: string>, `part col` string")
    cfg = sink(workdir, "awk", "append", partition_by=["part col"], first=True)
    write_output(spark, df, cfg)
    write_output(spark, df, {**cfg, "first": False})
    back = spark.table("db_awk.t")
    assert back.schema["s"].dataType == df.schema["s"].dataType and back.count() == 2


def test_first_registers_once_unless_the_shape_changes(spark, workdir, monkeypatch):
    ddl = []
    real_sql = spark.sql

    def recording(text, *args, **kwargs):
        if "CREATE TABLE" in text or "DROP TABLE" in text or "ADD COLUMNS" in text:
            ddl.append(text.split("(")[0].strip())
        return real_sql(text, *args, **kwargs)

    monkeypatch.setattr(spark, "sql", recording)
    schema = "k int, p string"
    cfg = sink(workdir, "fo", "append", partition_by=["p"], first=True)
    write_output(spark, spark.createDataFrame([(1, "a")], schema), cfg)
    created = len(ddl)
    for k, p in ((2, "b"), (3, "c")):  # same path, same shape: no re-registration
        write_output(spark, spark.createDataFrame([(k, p)], schema), cfg)
    assert len(ddl) == created
    assert rows(spark.table("db_fo.t")) == [(1, "a"), (2, "b"), (3, "c")]
    # a new column is a new shape: the entry learns it
    write_output(spark, spark.createDataFrame([(4, "x", "d")], "k int, extra string, p string"),
                 {**cfg, "merge_schema": True})
    assert len(ddl) > created
    assert spark.table("db_fo.t").filter("extra = 'x'").count() == 1


def test_event_keys_of_several_columns_never_collide(spark):
    from quarry.sinks import json_events

    pairs = [("a", None), (None, "a"), ("a", "b"), ("a|b", None), ("a", "|b"), (None, None), ('a","b', None)]
    df = spark.createDataFrame(pairs, "x string, y string")
    keys = [r.key for r in json_events(df, ["x", "y"]).collect()]
    assert len(set(keys)) == len(pairs) and None not in keys
    assert [r.key for r in json_events(df.limit(2), ["x"]).collect()] == ["a", None]
