"""Session helpers: runtime configuration and the shared work directory."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL confs every job relies on. They are session-scoped and can be set on a
# running session, so queries handed an existing session apply them too.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, app: str = "soukline",
                  shuffle_partitions: int | None = None,
                  event_log_dir: str | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the library expects.

    On a cluster ``master`` stays None and the launcher decides; locally it defaults
    to ``local[*]``.
    """
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or "local[*]")
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # a stack trace for every column expression costs more than analysis itself
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if event_log_dir:       # stage/task timings without the web UI
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    for k, v in RUNTIME_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def cluster_conf(input_bytes: int, total_cores: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a large cluster run (pass to ``SparkSession.builder.config``).

    * scan splits of ``target_partition_bytes`` (256 MB) - e.g. 100 TB -> ~400k tasks;
    * the initial shuffle partition count is about one per GB of input, at least 3
      waves of the cluster's cores and at most 65,536 (maps x reducers is the number of
      shuffle blocks; beyond that the block metadata itself becomes the bottleneck);
      AQE then coalesces small partitions to the advisory size and splits skewed ones;
    The 65,536 cap is physical only: it changes the number of partitions, never the rows.
    * a partition counts as skewed above 4x the median and 1 GB.
    """
    parts = min(65536, max(3 * total_cores, input_bytes // (1 << 30)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        **RUNTIME_CONF,
    }


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime confs to a session created elsewhere (idempotent)."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and intermediate tables.

    It is read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only a
    local session without one gets a fresh folder of its own; a cluster session without
    one is a configuration error, because a machine-local folder would not survive the
    loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = jdir.get() if jdir.isDefined() else None
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS)")
        d = tempfile.mkdtemp(prefix="soukline-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return d.rstrip("/")


def run_dir(spark: SparkSession, tag: str) -> str:
    """A fresh, unique folder under the shared dir for one run of one job."""
    return f"{shared_dir(spark)}/soukline/{tag}-{uuid.uuid4().hex[:12]}"


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(df, path: str):
    """Write ``df`` once and read it back: later uses share the rows, not the work."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
