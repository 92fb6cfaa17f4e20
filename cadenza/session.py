"""SparkSession construction and the few session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the plans this library builds. Everything else is
# left to the cluster's defaults.
RECOMMENDED_CONF: dict[str, str] = {
    # Runtime re-planning: coalesce small shuffle partitions, turn sort-merge
    # joins into broadcast joins once the real size of a side is known, and
    # split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Static broadcasts stay at Spark's conservative 10 MB (file-size
    # estimates of compressed Parquet understate memory); AQE broadcasts
    # from measured shuffle sizes at run time, and the library's own hints
    # sit behind explicit row bounds (plans.keys.bounded_broadcast).
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    *,
    app_name: str = "cadenza",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or return) a SparkSession with the recommended settings.

    On a cluster pass ``master=None`` so spark-submit decides; locally pass
    ``local[N]``. ``shuffle_partitions`` defaults to 2x the cores in local mode
    and is left to the cluster (AQE coalesces) otherwise.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if master and master.startswith("local") and shuffle_partitions is None:
        n = master[len("local[") : -1] if master.startswith("local[") else "1"
        cores = (os.cpu_count() or 1) if n in ("*", "") else int(n)
        shuffle_partitions = max(2 * cores, 2)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster (``spark.checkpoint.dir``).

    The session setting wins. Only a local session (tests) without one gets
    a private temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
    path = tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def reliable_checkpoint(df):
    """Materialise ``df`` into the shared checkpoint folder and cut its lineage.

    Used where several outputs must see exactly one evaluation of an input
    (e.g. one acceptance set for three write targets). Never a local
    checkpoint: those die with the executor that holds them.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written_table(df, name: str):
    """Write ``df`` once below the shared checkpoint folder and read it back.

    Cuts the lineage as a reliable checkpoint does, and the size of the files
    tells the planner whether the table can be broadcast.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


SCRATCH = "cadenza-tables"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{SCRATCH}/{name}-{uuid.uuid4().hex[:12]}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete the written tables of this session's checkpoint folder, once nothing reads them any more."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/{SCRATCH}")
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files under ``path`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(hpath).getLength())


def size_shuffles(spark: SparkSession, total_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Set the shuffle partition count from the data size.

    AQE only merges small shuffle partitions; it never splits large ones
    (outside skewed joins). So the initial count must be large enough for
    the biggest shuffle: one partition per ``target_bytes`` of input, at
    least the cluster's default parallelism. AQE then coalesces the
    shuffles that turn out small (aggregates, top-k inputs).
    """
    default = spark.sparkContext.defaultParallelism
    n = max(default, -(-total_bytes // target_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_bytes, 128 * 1024 * 1024)))
    return n
