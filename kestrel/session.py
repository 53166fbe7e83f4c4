"""Session helpers.

Lineage is cut only in the shared folder named by ``spark.checkpoint.dir``. A session with a local master and no
such setting (tests, bench) gets a temporary folder; a cluster without the setting raises.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark import StorageLevel


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster job over ``input_bytes`` of input on ``cores`` executor cores.

    Shuffle partitions are sized so one partition is about ``target_partition_bytes`` (AQE coalesces smaller ones
    and splits skewed ones), never fewer than twice the cores; scan splits use the same size. Broadcasts stay at
    Spark's size-checked threshold; this library only hints broadcasts for tables with a proven row bound.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(10 << 20),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``, or None. This is the configured
    value, never the per-application subfolder Spark makes inside it, so reading it twice gives the same folder."""
    conf = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    return conf or _LOCAL_DIRS.get(spark.sparkContext.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """A folder every executor can read; raises when the session names none."""
    path = checkpoint_dir(spark)
    if path is None:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    return path


_LOCAL_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Activate the configured checkpoint folder, once per application. Only a local master without the setting
    (tests, bench) gets a temporary folder; a cluster without the setting raises."""
    if checkpoint_dir(spark) is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        _LOCAL_DIRS[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    path = checkpoint_dir(spark)
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():  # noqa: SLF001 - no public accessor
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared folder of ``spark.checkpoint.dir``.

    Every derived column in this library is a deterministic function of the input (md5 draws, no rand()),
    so a lost executor recomputes exactly the same rows.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


ROWS_PER_FIT_PARTITION = 1 << 20


def fit_frame(df: DataFrame, rows_per_partition: int = ROWS_PER_FIT_PARTITION) -> tuple[DataFrame, DataFrame, int]:
    """Cache a frame that iterative learners read many times and size its partitions for them.

    Returns (cached frame to unpersist later, view to fit on, row count). A cached plan keeps the partition count
    of its last shuffle (e.g. 200 by default even for a few thousand rows), and every boosting level or L-BFGS step
    then runs that many near-empty tasks. The view coalesces (no shuffle) to max(cores, rows / rows_per_partition)
    partitions, so small data uses every core with little overhead and large data keeps ~1M-row tasks.
    """
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    n = cached.count()
    target = max(default_parallelism(df.sparkSession), -(-n // rows_per_partition))
    try:
        too_many = cached.rdd.getNumPartitions() > target
    except Exception:  # noqa: BLE001 - sessions without RDD access
        too_many = False
    return cached, (cached.coalesce(target) if too_many else cached), n


def default_parallelism(spark: SparkSession) -> int:
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # pragma: no cover - remote sessions
        return int(os.cpu_count() or 8)
