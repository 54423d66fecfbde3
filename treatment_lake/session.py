"""Session construction and the shared working folder.

Jobs that must write intermediate tables (round trips, streaming
checkpoints, upsert versions) write under the folder the cluster names
in ``spark.checkpoint.dir``. Only when that setting is absent (local
tests) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "treatment_lake", extra: dict | None = None) -> SparkSession:
    """A session tuned for this workload.

    AQE re-plans joins from runtime sizes (a dimension becomes a broadcast
    only when its measured size is below the threshold), coalesces small
    shuffle partitions and splits skewed ones.

    ``master`` and ``shuffle_partitions`` are applied only when given: on a
    cluster the submitter's master and partition count stay in force (a
    large initial count that AQE coalesces by ``advisoryPartitionSizeInBytes``
    is the right shape at scale); tests and the bench pass ``local[N]``.
    """
    builder = SparkSession.builder
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf_get(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf access differs between session kinds
        value = None
    return value or None


def wide_rows(spark: SparkSession) -> dict[str, str]:
    """Settings for steps that parse, unwrap or cast whole items. Their rows pack to a tenth or less and cost much per byte, so a task gets less
    than Spark's 128 MB, and there are several tasks per core (else one task more than there are cores takes a second
    wave). Generated functions beyond 8000 bytes are never compiled by the JVM: such a step runs faster without whole-stage codegen."""
    return {"spark.sql.files.maxPartitionBytes": "32m",
            "spark.sql.files.minPartitionNum": str(4 * spark.sparkContext.defaultParallelism),
            "spark.sql.codegen.hugeMethodLimit": "8000"}


#: a query's shuffle files go when it ends; else they stay on the executors' disks until the driver happens to collect its garbage
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    Read from the session; set a local one only when the session has none
    (tests and single-machine runs).
    """
    root = _conf_get(spark, _CHECKPOINT_KEY)
    if root is None:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover
            root = None
    if root is None and not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, intermediate tables need a folder that "
                           "the driver and all executors share")
    if root is None:
        root = tempfile.mkdtemp(prefix="treatment_lake-ckpt-")
        spark.conf.set(_CHECKPOINT_KEY, root)
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:  # pragma: no cover
            pass
    return root.rstrip("/")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


_HANDED_OUT: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the checkpoint root."""
    path = f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _HANDED_OUT.append(path)
    return path


def clear_scratch(spark: SparkSession) -> None:
    """Removes the intermediate tables of this process (frames that read them can no longer be evaluated)."""
    while _HANDED_OUT:
        remove(spark, _HANDED_OUT[-1])


def remove(spark: SparkSession, path: str) -> None:
    """Removes one intermediate table of this process."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _HANDED_OUT.remove(path)
