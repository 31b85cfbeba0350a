"""Settings and shared working folders; operators never build or reconfigure a session."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Keeps the unbounded state of a streaming dedup on local disk instead of the JVM heap, and
# uploads changes instead of whole snapshots.
STATE_STORE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings a job submitter passes at session start.  AQE splits skewed join partitions and picks
# broadcast joins from measured sizes.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    **STATE_STORE_CONF,
}


@contextmanager
def scoped_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Runtime settings for one step; the session's own values come back afterwards."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, else one of our own.

    A cluster names the folder, and without one this raises an error: executors would write to
    disks of their own.  In local mode (tests, a laptop) a temporary folder is made once and
    remembered in the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.wardflow.localRoot", None
    )
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
        root = tempfile.mkdtemp(prefix="wardflow-")
        spark.conf.set("spark.wardflow.localRoot", root)
    return root.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`shared_root` for one run of one job."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a derived frame to the shared folder once and read it back.

    For lookups and features that several jobs or micro-batches use: they are computed once,
    survive the loss of an executor, and their size on disk is known, so Spark broadcasts them
    only if they are below its threshold.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
