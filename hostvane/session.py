"""Session defaults and the shared folder for everything a job writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_LOCAL_ROOT: str | None = None


def get_session(app_name: str = "hostvane", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on.

    Naive wall-clock timestamps are read as UTC. Joins carry no broadcast hints: the planner broadcasts a
    dimension only when its size is below ``autoBroadcastJoinThreshold`` and otherwise sort-merges, with
    AQE splitting hot partitions. Agents upload files of 60 rows, so opening a file is priced low and one task reads
    hundreds of them. Stream state goes to RocksDB, outside the Java heap.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.files.openCostInBytes": str(256 * 1024),
        STATE_STORE: ROCKSDB,
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names that folder. A machine-local folder is used only for a local master
    (tests); on a cluster a missing setting is an error, because executors could not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/hostvane/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a table in the shared folder, for results that several parts of a plan read."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _local_root() -> str:
    global _LOCAL_ROOT
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="hostvane-")
    return _LOCAL_ROOT
