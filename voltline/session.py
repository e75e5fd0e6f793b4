"""SparkSession construction and session-level settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every voltline job relies on.  UTC pins the meaning of
# ``date_format`` / ``to_date`` on event timestamps; AQE re-plans joins and
# coalesces shuffle partitions from runtime statistics, and splits skewed
# join partitions (a single hot device can own a large share of the rows).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Key lookups push up to this many keys into the scan, where Bloom filters tell them apart.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # Streaming session windows: merge each input partition's events into
    # partial sessions before the shuffle, so a hot device reaches its state
    # task as a few partial sessions instead of all of its raw events.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Streaming state store.  RocksDB keeps state off the JVM heap and is the
# choice for cluster runs (minutes of telemetry per device in join and
# aggregation state).  Each store instance has a fixed open/commit cost that
# dominates when state is tiny, so local runs use Spark's default in-memory
# (HDFS-backed) provider.  VOLTLINE_STATE_STORE = rocksdb | memory overrides
# the choice.
STATE_STORES = {
    "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "memory": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
}
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

# A query that holds raw events keeps them in RocksDB, whose stores share this
# memory in an executor; without the bound each store takes its own buffers.
# In-process sessions do so only for a table of this size.
ROCKSDB_BOUND = {"spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
                 "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64"}
LARGE_TABLE_BYTES = 64 * 1024 * 1024


def get_spark(master: str | None = None, app: str = "voltline",
              shuffle_partitions: int | None = None,
              extra_conf: dict | None = None) -> SparkSession:
    """Return (or create) a session with voltline's settings applied.

    ``master`` defaults to ``local[N]`` only when no master is configured in
    the environment, so the same entry point works under spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        builder = builder.master(master or f"local[{os.cpu_count() or 4}]")
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    conf.setdefault("spark.driver.memory", os.environ.get("VOLTLINE_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    local = (master or os.environ.get("SPARK_MASTER") or "local").startswith("local")
    store = os.environ.get("VOLTLINE_STATE_STORE") or ("memory" if local else "rocksdb")
    conf[PROVIDER] = STATE_STORES[store]
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Apply the runtime-modifiable settings to an existing session."""
    for key in ("spark.sql.session.timeZone",
                "spark.sql.adaptive.enabled",
                "spark.sql.adaptive.skewJoin.enabled",
                "spark.sql.parquet.pushdown.inFilterThreshold",
                "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"):
        spark.conf.set(key, SESSION_CONF[key])


def _context(spark: SparkSession):
    """The SparkContext when the session has one (not under Spark Connect)."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions raise here
        return None


def is_local(spark: SparkSession) -> bool:
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "local")
    return master.startswith("local")


def event_state_conf(spark: SparkSession, table_bytes: int) -> dict:
    """State store settings for a query that holds the events of a table of
    ``table_bytes`` until their windows close.  A store that the session names
    stays as it is, with RocksDB's memory bounded."""
    sc = _context(spark)
    in_process = sc is not None and sc.master.split("[")[0] == "local"
    named = spark.conf.get(PROVIDER, None) or STATE_STORES.get(os.environ.get("VOLTLINE_STATE_STORE", ""))
    store = named or STATE_STORES["memory" if in_process and table_bytes < LARGE_TABLE_BYTES else "rocksdb"]
    bound = {k: spark.conf.get(k, None) or v for k, v in ROCKSDB_BOUND.items()}
    return {PROVIDER: store} | (bound if store == STATE_STORES["rocksdb"] else {})


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", str(os.cpu_count() or 8)))


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session (on a cluster this names
    shared storage).  Only when it is unset -- local runs and tests -- a
    fresh scratch folder is created and registered.
    """
    sc = _context(spark)
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and sc is not None:
        current = sc.getCheckpointDir()
    if not current:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: executors and "
                               "restarted drivers must see checkpoints and scratch tables")
        current = tempfile.mkdtemp(prefix="voltline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
        if sc is not None:
            sc.setCheckpointDir(current)
    return current.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def scale_conf(input_bytes: int, total_cores: int,
               target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of Parquet.

    * file splits of ``target_partition_bytes`` (scan tasks that fit in
      executor memory with room for decompression);
    * initial shuffle partitions = max(2 x cores, input / target) so the
      largest stage gets ~target-sized partitions; AQE then coalesces small
      ones toward the advisory size and splits skewed ones (a partition 5x
      the median and over 512 MiB);
    * for streaming queries the shuffle-partition count is frozen in the
      checkpoint at first start, so it is sized from the hub throughput by
      the caller, not from this function.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }
