"""Session helpers: partition sizing for a run, building a session, the shared
checkpoint folder, size-checked broadcasting, and partition counts for
CPU-heavy stages."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SHUFFLE_PARTITIONS = 200_000


def scale_conf(input_bytes: int, executors: int, cores_per_executor: int,
               executor_memory_gb: float = 16.0, expansion: float = 1.5) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of (compressed) input.

    Scan splits are sized so every core gets several, between 128 MB and 1 GB.
    Shuffle partitions are sized from the expected shuffle volume
    (``expansion`` x input: the encode and BLEU plans shuffle the input rows
    once, the aggregates shuffle pre-summed rows) so that one partition is at
    most a quarter of a core's share of executor memory, with at least three
    waves of tasks and at most ``MAX_SHUFFLE_PARTITIONS`` reducers (beyond
    that, map-output tracking costs more than larger, spilling partitions).
    """
    cores = max(executors * cores_per_executor, 1)
    split = min(max(input_bytes // (cores * 4), 128 << 20), 1 << 30)
    per_core_mem = executor_memory_gb * (1 << 30) / max(cores_per_executor, 1)
    target = int(per_core_mem / 4)
    shuffle = min(max(int(input_bytes * expansion) // max(target, 1), cores * 3), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.files.maxPartitionBytes": str(int(split)),
        "spark.sql.shuffle.partitions": str(int(shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app_name: str = "parallex", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A session with these settings, each only where the submitted application
    has none: under ``spark-submit`` the cluster's master, sizes and partition
    counts stand."""
    settings = {
        "spark.master": master,
        "spark.app.name": app_name,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "16g",
        # checkpoint files of frames no longer referenced are removed
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    } | (extra_conf or {})
    if os.environ.get("PYSPARK_GATEWAY_PORT"):  # started by spark-submit
        spark = SparkSession.builder.getOrCreate()
        given = spark.sparkContext.getConf()
        for k, v in settings.items():
            # partition counts come with the cluster; other SQL settings only fill gaps
            mine = k != "spark.sql.shuffle.partitions" or k in (extra_conf or {})
            if k.startswith("spark.sql.") and mine and not given.contains(k):
                spark.conf.set(k, v)
    else:
        spark = SparkSession.builder.config(map=settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    The session's ``spark.checkpoint.dir`` wins. Only a local-mode session
    without one (tests) gets a fresh private folder; a cluster session without
    one is an error, because a machine-local folder would not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="parallex-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError("set spark.checkpoint.dir to a shared folder")


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to a new folder in the shared checkpoint folder and
    read it back: like ``pin``, but columnar, for large tables of few small columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# Largest table we hand to a broadcast join, in bytes, judged from a row count
# times a per-row size bound given by the caller.
MAX_BROADCAST_BYTES = 256 << 20
# Rows of the small tables we broadcast by default (vocabulary, partition
# offsets, best-next table) are below 128 bytes.
DEFAULT_ROW_BYTES = 128


def broadcast_limit(row_bytes: int = DEFAULT_ROW_BYTES) -> int:
    return max(MAX_BROADCAST_BYTES // max(row_bytes, 1), 1)


def is_broadcastable(n_rows: int, row_bytes: int = DEFAULT_ROW_BYTES) -> bool:
    return n_rows <= broadcast_limit(row_bytes)


def broadcast_checked(df: DataFrame, max_rows: int | None = None,
                      known_rows: int | None = None, row_bytes: int = DEFAULT_ROW_BYTES) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven to be small.

    Above the bound the frame is returned unhinted and the join falls back to a
    shuffle join (AQE splits skewed partitions).
    """
    limit = max_rows if max_rows is not None else broadcast_limit(row_bytes)
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= limit else df


def work_partitions(spark: SparkSession) -> int:
    """Partition count for CPU-heavy keyed stages: the shuffle setting, but
    never below the cluster's task slots."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               spark.sparkContext.defaultParallelism)


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin a freshly read table over the task slots when the files give
    fewer partitions than slots (e.g. a small file with a single row group), so
    the CPU-heavy per-row work downstream (tokenizing, edit distances) uses
    every core. A large input already has more partitions than slots and is
    returned unchanged, without a shuffle.

    Use it on scans only: counting the partitions of a plan with exchanges
    would run those exchanges.
    """
    slots = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(slots) if scan.rdd.getNumPartitions() < slots else scan


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Hash-partition on ``key`` into ``work_partitions`` partitions (an explicit
    count, so the CPU-heavy stage that follows is not merged into few tasks)."""
    return df.repartition(work_partitions(df.sparkSession), key)
