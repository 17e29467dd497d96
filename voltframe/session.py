"""Session helpers: defaults that matter for correctness and scale."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. UTC session time so that wall-clock parts of
# UTC instants are UTC; AQE so joins pick broadcast from runtime sizes and
# skewed partitions are split.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "voltframe", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
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


def use_utc(spark: SparkSession) -> None:
    """Wall-clock parts of reading timestamps are UTC parts."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    *and* the master is local (tests, local runs) is a private folder created;
    on a cluster an unset setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                               "(e.g. on the cluster file system) for checkpoints")
        configured = tempfile.mkdtemp(prefix="voltframe-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder, for tables that a
    run writes and reads again. Nothing is created; the folder is scratch space."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024 * 1024,
               max_partitions: int = 100_000) -> dict:
    """Shuffle sizing for a run over ``input_bytes`` of input: enough shuffle
    partitions that each holds about ``target_partition_bytes`` before AQE
    coalesces small ones, and file splits of the same size, so tasks fit in
    executor memory and spill rarely."""
    parts = max(1, min(max_partitions, -(-input_bytes // target_partition_bytes)))
    return {"spark.sql.shuffle.partitions": str(parts),
            "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 4)}


def apply_conf(spark: SparkSession, conf: dict) -> None:
    for k, v in conf.items():
        spark.conf.set(k, v)


def size_for(spark: SparkSession, *paths: str) -> None:
    """Size the session's shuffles and splits for the files under ``paths``:
    Spark lists them and adds up their lengths, without opening one."""
    total = 0
    for path in paths:
        total += (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                  .agg({"length": "sum"}).first()[0] or 0)
    conf = scale_conf(total)
    conf["spark.sql.shuffle.partitions"] = str(max(int(conf["spark.sql.shuffle.partitions"]),
                                                   spark.sparkContext.defaultParallelism))
    apply_conf(spark, conf)
