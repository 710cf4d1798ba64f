"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job here assumes.  Partition counts and memory belong to the
# cluster, so they are left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    STATE_STORE: ROCKSDB,
}


def build_session(app: str = "plumbline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root() -> tempfile.TemporaryDirectory:
    return tempfile.TemporaryDirectory(prefix="plumbline-")  # goes when the process ends


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``.

    Every executor must see it, so only a session that runs on one machine (local
    mode) may do without the setting; it gets a folder that ends with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_root().name
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written to the shared folder and read back.  Later plans start
    from files that outlive any executor instead of repeating the work."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
