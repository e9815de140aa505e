"""Session construction and the shared scratch folder."""

from __future__ import annotations

import uuid
import warnings

from pyspark.sql import SparkSession

# Settings every job wants regardless of cluster size. Shuffle partition
# counts are left to AQE (coalesce + skew split) rather than fixed here.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions are sized by AQE towards this; on a cluster set
    # spark.sql.shuffle.partitions to about (largest shuffle bytes / 256 MB)
    # and AQE coalesces what turns out smaller.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "quarry",
    conf: dict[str, str] | None = None,
    hive: bool = False,
) -> SparkSession:
    """Get or create a session with the defaults above.

    ``master`` is only for local runs and tests; on a cluster the launcher
    sets it. ``conf`` overrides the defaults. ``hive`` keeps the catalog in
    the metastore the deployment configures; without it a session's catalog
    is its own, and tables are found again by the version named on storage.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if hive:
        builder = builder.enableHiveSupport()
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    _size_initial_shuffles(spark)
    return spark


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PARALLELISM_FIRST = "spark.sql.adaptive.coalescePartitions.parallelismFirst"


def cluster_cores(get) -> int:
    """Cores the cluster can reach, from its settings (``get(key)`` returns
    a string or None). With dynamic allocation this is the maximum, since
    few executors may be up when the session starts."""
    per_executor = int(get("spark.executor.cores") or 1)
    if (get("spark.dynamicAllocation.enabled") or "").lower() == "true":
        executors = get("spark.dynamicAllocation.maxExecutors")
    else:
        executors = get("spark.executor.instances")
    return int(executors or 0) * per_executor


def _size_initial_shuffles(spark: SparkSession) -> None:
    """On a cluster, let AQE start every shuffle from about four
    partitions per core and coalesce towards the advisory size, unless the
    deployment chose otherwise. A fixed 200 would make 100 TB shuffles
    spill in tasks of hundreds of GB; AQE can merge small partitions but
    splits only skewed join and rebalance partitions. Local sessions keep their own
    setting."""
    sc = spark.sparkContext
    if sc.master.startswith("local"):
        return
    conf = sc.getConf()
    if not conf.get(PARALLELISM_FIRST, None):
        # Coalesce towards the advisory size rather than keeping as many
        # (possibly tiny) partitions as there are cores.
        spark.conf.set(PARALLELISM_FIRST, "false")
    if spark.conf.get(INITIAL_PARTITIONS, None):
        return
    cores = max(sc.defaultParallelism, cluster_cores(lambda k: conf.get(k, None)))
    base = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set(INITIAL_PARTITIONS, str(max(base, 4 * cores)))


def is_shared(path: str) -> bool:
    """Whether a folder is named with the scheme of a shared store."""
    scheme, colon, _ = path.partition(":")
    return bool(colon) and "/" not in scheme and scheme != "file"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (the folder the cluster names). Only
    when the session has none is one set, under the warehouse directory,
    which is shared storage on a cluster. A folder without a scheme is on
    Spark's default file system. A local folder that the cluster itself
    names (``file:``, as for a mount that all machines share) is taken, with
    a warning, as nothing tells a shared mount from a machine's own disk; one
    that nobody named is refused on a cluster.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    cluster = not spark.sparkContext.master.startswith("local")
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        if cluster and not is_shared(root):
            raise ValueError(
                f"{root} is a folder of each machine: name a shared one in spark.checkpoint.dir, "
                "where executors find each other's intermediate tables"
            )
        spark.sparkContext.setCheckpointDir(root)
    else:
        if cluster and root.startswith("file:"):
            warnings.warn(f"{root} must be a folder that all machines share, such as a network mount", stacklevel=2)
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the scratch root; never reused between runs."""
    return f"{scratch_root(spark)}/quarry/{tag}-{uuid.uuid4().hex[:12]}"


def materialize(spark: SparkSession, df, tag: str):
    """Write ``df`` once as a Parquet table under the shared scratch folder
    and read it back: lineage is cut (a lost executor's part is read from
    files, never recomputed from a source that may have changed), and
    readers get column pruning and filter push-down that an RDD
    checkpoint would not offer."""
    path = new_work_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_work_dir`` named, once nothing reads it."""
    if not path.startswith(f"{scratch_root(spark)}/quarry/"):
        raise ValueError(f"{path} is no intermediate folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
