"""Batch and streaming readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import nan_to_null


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options
) -> DataFrame:
    """Read files of any Spark format; CSV is read by header and fails on a wrong column order."""
    if fmt == "csv":
        options = {"header": True, "enforceSchema": False, **options}
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def null_normalised(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL, so that every missing value looks the same."""
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[nan_to_null(F.col(c)).alias(c) if c in floating else F.col(c) for c in df.columns]
    )


def read_query(
    spark: SparkSession, query: str, fmt: str | None = None, args: dict | None = None, **options
) -> DataFrame:
    """Result of a SQL query: on the session's views, or pushed to a connector.

    Without ``fmt`` the query runs on registered views with named ``args``.  With ``fmt``
    (``jdbc``, ``bigquery``) the text goes to the remote side; pass ``partitionColumn`` and its
    bounds with ``dbtable`` through :func:`read_table` for a parallel JDBC read of a big table.
    """
    if fmt is None:
        return spark.sql(query, args=args or {})
    reader = spark.read.format(fmt).option("query", query).options(**options)
    return null_normalised(reader.load())


def kafka_options(
    brokers: str,
    topic: str,
    start: str = "earliest",
    end: str | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of a Kafka source; ``end`` only for a bounded batch read."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if end is not None:
        options["endingOffsets"] = end
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    start: str = "earliest",
    max_per_trigger: int | None = None,
) -> DataFrame:
    options = kafka_options(brokers, topic, start, None, max_per_trigger)
    return _key_value(spark.readStream.format("kafka").options(**options).load())


def read_kafka_batch(spark: SparkSession, brokers: str, topic: str) -> DataFrame:
    """The whole topic as a bounded lookup table."""
    options = kafka_options(brokers, topic, "earliest", "latest")
    return _key_value(spark.read.format("kafka").options(**options).load())


def _key_value(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string"), F.col("value").cast("string"))


def read_stream(
    spark: SparkSession,
    path: str,
    schema,
    fmt: str = "parquet",
    max_files: int | None = 10,
    **options,
) -> DataFrame:
    """Files as a stream with an explicit schema and a cap on files per trigger.

    The checkpoint of the query that reads it is the replay position: files already read are
    not read again after a restart.
    """
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, non-null count, smallest and largest value as text.

    One aggregation over the whole table in one pass; the transposition works on one row.  Of the
    two zeros of a floating column -0.0 is the smaller, whichever is met first.
    """
    columns = [c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))]
    types = dict(df.dtypes)

    def end(c: str, pick: Callable) -> Column:
        if types[c] not in ("float", "double"):
            return pick(c).cast("string")
        value = F.col(c)
        # The text tells the zeros apart, which compare as equal; "-" sorts before digits.
        ranked = F.struct(value.alias("value"), F.when(value == 0, value.cast("string")).alias("zero"))
        best = pick(F.when(value.isNotNull(), ranked))
        return F.coalesce(best["zero"], best["value"].cast("string"))

    aggregated = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.count(c).alias("non_null"),
                end(c, F.min).alias("min_value"),
                end(c, F.max).alias("max_value"),
            ).alias(f"c{i}")
            for i, c in enumerate(columns)
        ]
    )
    cells = F.array(*[F.col(f"c{i}") for i in range(len(columns))])
    return aggregated.select(F.inline(cells))


def preview(spark: SparkSession, path: str, n: int = 1000, sampling: float = 0.01) -> DataFrame:
    """First ``n`` rows of a CSV file; types are inferred from a fraction of the lines."""
    options = {"header": True, "inferSchema": True, "samplingRatio": sampling}
    return spark.read.options(**options).csv(path).limit(n)


def open_warehouse(spark: SparkSession, root: str, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Stored tables below a folder as frames, also registered as views for SQL users."""
    frames = {}
    for name in tables:
        frames[name] = spark.read.parquet(f"{root.rstrip('/')}/{name}")
        frames[name].createOrReplaceTempView(name)
    return frames
