"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. Time zone is pinned because month keys,
# `trunc` and the midnight end-date rule all follow the session zone.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_settings(input_bytes: int, cores: int, scan_split_mb: int = 512,
                     shuffle_target_mb: int = 256, shuffled_share: float = 0.1,
                     max_partitions: int = 40_000) -> dict[str, str]:
    """Settings for a large cluster, sized from the bytes that are shuffled.

    * Scan tasks of ``scan_split_mb`` (100 TB -> ~200k tasks) keep per-task
      memory flat.
    * ``shuffled_share`` is the part of the input that reaches an exchange:
      aggregates combine before it and scans are pruned to a few columns. Give
      1.0 for a job that windows raw rows. The width is at least 2 x cores, and
      bounded: map tasks x partitions is the number of shuffle blocks that the
      driver tracks, and partitions larger than the target spill, which is the
      lesser evil. Adaptive execution joins small partitions.
    """
    mb = 1024 * 1024
    shuffled = input_bytes * shuffled_share
    shuffle = min(max_partitions, max(2 * cores, int(shuffled // (shuffle_target_mb * mb)) + 1))
    return {
        "spark.sql.files.maxPartitionBytes": f"{scan_split_mb}m",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{shuffle_target_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * shuffle_target_mb}m",
    }


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tickforge", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to the
    data (roughly input bytes / 128 MB); AQE coalesces small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there. Where it is unset a local session
    (tests) gets a fresh temporary folder; on a cluster that is an error, as a
    folder of one machine would lose what the others write.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # no SparkContext (remote session): use the setting as is
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path:
            raise RuntimeError("spark.checkpoint.dir is not set")
        return path
    current = sc.getCheckpointDir()
    if current:
        return current
    path = sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tickforge-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back: cuts the lineage with a
    table that survives lost executors, and settles rows whose place depends on how they were dealt."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def remove(df: DataFrame) -> None:
    """Delete the table of :func:`written` once nothing reads it any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
