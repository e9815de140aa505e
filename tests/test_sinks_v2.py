"""Table formats with their own transactions (Iceberg, Delta) need jars that
are not installed here, so these tests record the DataFrame API calls a
sink makes instead of running them."""

import pytest

from quarry.sinks import write_output


class Recorder:
    """Stands in for DataFrames, writers and merge builders: every method
    call is logged and returns the recorder itself."""

    def __init__(self, log, label):
        self.log, self.label = log, label

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.log.append((self.label, name, args, kwargs))
            return self

        return call


class FakeCatalog:
    def __init__(self, exists):
        self.exists = exists

    def tableExists(self, name):
        return self.exists


class FakeConf:
    def __init__(self, extensions):
        self.extensions = extensions

    def get(self, key, default=None):
        return self.extensions if key == "spark.sql.extensions" else default


class FakeSpark:
    def __init__(self, log, exists, extensions):
        self.log, self.catalog, self.conf = log, FakeCatalog(exists), FakeConf(extensions)

    def sql(self, text, *args, **kwargs):
        self.log.append(("spark", "sql", (text,), {}))


def calls(log, label=None):
    return [name for who, name, _, _ in log if label is None or who == label]


ICEBERG = "org.apache.iceberg.spark.extensions.IcebergSparkSessionExtensions"


@pytest.mark.parametrize("mode,final", [("append", "append"), ("overwrite", "overwrite"),
                                        ("overwrite_partition", "overwritePartitions")])
def test_iceberg_modes_go_through_its_catalog(spark, mode, final):
    log = []
    fake = FakeSpark(log, exists=False, extensions=ICEBERG)
    df = Recorder(log, "df")
    write_output(fake, df, {"writer": "IcebergWriter", "mode": mode, "table_name": "cat.db.t", "partition_by": ["d"]})
    names = calls(log, "df")
    # created empty (schema only) with its partitioning, then written in one commit
    assert names[:5] == ["limit", "writeTo", "using", "partitionedBy", "create"]
    assert names[5:] == ["writeTo", final]
    # the catalog part of the name is kept throughout
    assert any("CREATE DATABASE IF NOT EXISTS `cat`.`db`" in args[0] for who, _, args, _ in log if who == "spark")
    assert [args[0] for who, name, args, _ in log if name == "writeTo"] == ["`cat`.`db`.`t`"] * 2


def test_iceberg_is_recognised_by_the_table_s_catalog(spark):
    log = []
    fake = FakeSpark(log, exists=True, extensions="")
    fake.conf.get = lambda key, default=None: "org.apache.iceberg.spark.SparkCatalog" if key == "spark.sql.catalog.cat" else default
    write_output(fake, Recorder(log, "df"), {"writer": "IcebergWriter", "mode": "append", "table_name": "cat.db.t"})
    assert calls(log, "df") == ["writeTo", "append"]
    with pytest.raises(ValueError, match="iceberg is not configured"):
        write_output(fake, Recorder(log, "df"), {"writer": "IcebergWriter", "mode": "append", "table_name": "other.db.t"})


@pytest.mark.parametrize("null_safe,changed", [(False, "=("), (True, "<=>(")])
def test_iceberg_upsert_is_one_merge(spark, null_safe, changed):
    log = []
    fake = FakeSpark(log, exists=True, extensions=ICEBERG)
    df = Recorder(log, "df")
    write_output(fake, df, {"writer": "IcebergWriter", "mode": "upsert", "table_name": "db.t",
                            "primary_key": ["k1", "k2"], "change_tracking_column": ["v"], "null_safe": null_safe})
    names = calls(log, "df")
    assert names[-7:] == ["alias", "mergeInto", "whenMatched", "update", "whenNotMatched", "insertAll", "merge"]
    merge_args = next(args for who, name, args, _ in log if name == "mergeInto")
    cond = str(merge_args[1])
    assert "k1" in cond and "k2" in cond and "and(" in cond.lower()
    matched = next(args for who, name, args, _ in log if name == "whenMatched")
    assert changed in str(matched[0])
    update = next(args for who, name, args, _ in log if name == "update")
    assert list(update[0]) == ["v"]


def test_delta_without_its_extension_is_an_error(spark, workdir):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    cfg = {"writer": "DeltaWriter", "mode": "overwrite", "table_name": "spark_catalog.dlt.t",
           "path": f"{workdir}/dlt", "database_location": f"{workdir}/dlt.db", "first": True}
    with pytest.raises(ValueError, match="delta is not configured"):
        write_output(spark, df, cfg)
    write_output(spark, df, {**cfg, "format": "parquet"})
    assert sorted(map(tuple, spark.table("dlt.t").collect())) == [(1, "a")]
