"""Session construction and the shared folder used for lineage cuts, models and streams."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tonestream",
                  input_bytes: int | None = None) -> SparkSession:
    """A session tuned for this library: AQE on, UI off, UTC, Arrow transfer.

    On a cluster the caller's own session is used as is; this helper is for
    local runs, tests and the bench. With ``input_bytes`` the scan, shuffle,
    skew and broadcast settings of ``recommended_conf`` are applied for the
    session's cores (all are runtime SQL settings).
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    if input_bytes is not None:
        for key, value in recommended_conf(input_bytes, spark.sparkContext.defaultParallelism).items():
            spark.conf.set(key, value)
    return spark


MB = 1 << 20


def recommended_conf(input_bytes: int, total_cores: int, shuffle_fraction: float = 0.5,
                     target_partition_bytes: int = 200 * MB) -> dict[str, str]:
    """Session settings sized for a cluster run over ``input_bytes`` of text.

    * Scans split at 128 MB: cleaning is CPU-bound, so splits stay small enough
      that every core has work and a task's rows fit comfortably in memory.
    * Initial shuffle partitions sized so each holds about
      ``target_partition_bytes`` of the largest shuffle (term statistics and
      model counts after map-side partial aggregation, estimated as
      ``shuffle_fraction`` of the input), at least two per core; AQE then
      coalesces small ones towards the 128 MB advisory size.
    * Skew join on, with a partition counted as skewed above 256 MB and five
      times the median, so one hot term or key is split across tasks.
    * Runtime broadcast only for join sides measured below 64 MB.
    """
    import math

    shuffle_bytes = max(1, int(input_bytes * shuffle_fraction))
    partitions = max(2 * total_cores, math.ceil(shuffle_bytes / target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(128 * MB),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * MB),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder for checkpoints and written intermediate tables.

    Order: the folder already set on the context (``setCheckpointDir``), then
    ``spark.checkpoint.dir``. Only where both are unset and the session runs in
    one local process is a fresh scratch folder made; on a cluster that would be
    a different disk on every executor, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    path = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if current.isDefined():
        # the context appends a folder of its own below a configured path
        return path if path and path.split(":", 1)[-1].strip("/") in current.get() else current.get()
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tonestream-ckpt-")
    sc.setCheckpointDir(path)
    return path


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
