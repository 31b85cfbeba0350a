"""Batch sinks: files, relational tables, insert-if-absent, table registry."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import dedup
from ..schemas import split_ddl


def write_table(
    df: DataFrame,
    target: str,
    mode: str = "append",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    **options,
) -> None:
    """Write a batch frame; a streaming frame is refused with a hint instead of failing inside."""
    if df.isStreaming:
        raise ValueError("write_table takes a batch frame; use sinks.streams.write_stream")
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)


def jdbc_options(
    url: str, table: str, user: str, password: str, driver: str, batch_size: int = 1000,
    connections: int = 8,
) -> dict[str, str]:
    """Options of a relational target; ``connections`` bounds the parallel writers."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(batch_size),
        "numPartitions": str(connections),
    }


def write_relational(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()


def replace_folder(df: DataFrame, target: str) -> None:
    """Write beside ``target`` and swap: a run that fails leaves the folder as it was."""
    spark = df.sparkSession
    fresh, old = (f"{target.rstrip('/')}-{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    df.write.parquet(fresh)
    path = spark._jvm.org.apache.hadoop.fs.Path
    store = path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    if store.exists(path(target)):
        store.rename(path(target), path(old))
    if not store.rename(path(fresh), path(target)):
        raise OSError(f"cannot move {fresh} to {target}")
    store.delete(path(old), True)


def insert_absent(
    new: DataFrame,
    existing: DataFrame,
    pk: Sequence[str],
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Rows of ``new`` whose key is not in ``existing`` yet; stored rows are never replaced.

    Of several new rows with one key the first by ``order_by`` is kept.  Both sides are reduced
    to one row per key before the join, so a hot key joins 1:1.
    """
    fresh = dedup(new.dropna(subset=list(pk)), pk, order_by)
    return fresh.join(existing.select(*pk).distinct(), list(pk), "left_anti")


def create_tables(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet") -> None:
    """``CREATE TABLE IF NOT EXISTS`` for every ``name -> DDL``."""
    for name, ddl in tables.items():
        columns = ", ".join(f"`{c}` {t}" for c, t in split_ddl(ddl))
        spark.sql(f"CREATE TABLE IF NOT EXISTS {_stored(spark, name)} ({columns}) USING {fmt}")


def drop_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop facts before dimensions."""
    for name in sorted(names, key=lambda n: (not n.startswith("fact"), n)):
        spark.sql(f"DROP TABLE IF EXISTS {_stored(spark, name)}")


def _stored(spark: SparkSession, name: str) -> str:
    """Name with its database, so that a session view of the same name is left alone."""
    return name if "." in name else f"{spark.catalog.currentDatabase()}.{name}"


def table_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Name, column count and row count of each table, one row per table, counted by Spark."""
    rows = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).cast("bigint").alias("column_count"),
            "row_count",
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def stored_bytes(spark: SparkSession, location: str) -> DataFrame:
    """Total size of the files below a folder, from file metadata only."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(location)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"))


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Store a frame as a catalog table bucketed and sorted by ``keys``, one file per bucket.

    Tables of equal buckets join and group by those keys without a shuffle.  Rows are dealt to the
    buckets before they are written, so no task writes a file per bucket.
    """
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.mode("overwrite").saveAsTable(_stored(df.sparkSession, table))
    return df.sparkSession.table(_stored(df.sparkSession, table))


def write_by_month(df: DataFrame, date_key: str, target: str) -> None:
    """Store a fact partitioned by the month of a date key (column ``month``, YYYYMM; NULL for none).

    Rows are rebalanced by month first: a heavy month is split over files, light ones are whole.
    """
    monthly = df.withColumn("month", (F.col(date_key) / 100).cast("int")).hint("rebalance", "month")
    monthly.write.mode("overwrite").partitionBy("month").parquet(target)


def catalog_inventory(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Managed tables of a database with column count and size on disk; no data is read."""
    found = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary:
            continue
        full = f"{database}.{table.name}" if database else table.name
        detail = spark.sql(f"DESCRIBE TABLE EXTENDED {full}").filter("col_name = 'Location'")
        size = stored_bytes(spark, detail.first()["data_type"]).first()["size_bytes"]
        found.append((table.name, len(spark.catalog.listColumns(full)), size))
    ddl = "table_name STRING, column_count INT, size_bytes BIGINT"
    return spark.createDataFrame(found, ddl).orderBy("table_name")
