"""Session defaults and cluster sizing."""


def test_cluster_cores_uses_the_dynamic_allocation_maximum():
    from quarry.session import cluster_cores

    conf = {"spark.executor.cores": "8", "spark.dynamicAllocation.enabled": "true",
            "spark.dynamicAllocation.maxExecutors": "1000", "spark.executor.instances": "2"}
    assert cluster_cores(conf.get) == 8000
    conf["spark.dynamicAllocation.enabled"] = "false"
    assert cluster_cores(conf.get) == 16
    assert cluster_cores({}.get) == 0


def test_local_sessions_keep_their_shuffle_setting(spark):
    from quarry.session import INITIAL_PARTITIONS

    assert spark.conf.get(INITIAL_PARTITIONS, None) is None


def test_materialize_cuts_lineage_into_the_scratch_folder(spark):
    from quarry.session import materialize, scratch_root

    src = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("o_orderstatus = 'F'")
    copy = materialize(spark, src, "t")
    files = copy.inputFiles()
    assert files and all(scratch_root(spark).removeprefix("file:") in f for f in files)
    assert not any("testdata" in f for f in files)
    assert copy.schema == src.schema and copy.count() == src.count()


def test_a_machine_s_own_folder_is_no_scratch_on_a_cluster():
    import pytest

    from quarry.session import is_shared, scratch_root

    assert is_shared("hdfs://n/x") and is_shared("s3a://b/x") and not is_shared("file:/x") and not is_shared("/x")

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, root):
            self.root = root

    class Session:
        sparkContext = Context()

    Session.conf = Conf(**{"spark.sql.warehouse.dir": "file:/work/spark-warehouse"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_root(Session())
    Session.conf = Conf(**{"spark.sql.warehouse.dir": "hdfs://n/warehouse"})
    assert scratch_root(Session()) == "hdfs://n/warehouse/_checkpoints"
