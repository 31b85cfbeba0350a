"""Append-only Parquet tables whose rows count once a commit names their folder.

A batch is staged in a folder of its own.  A small file named after the next version then adds the
folder to the table; that file is made by a rename that fails if the version exists, so of several
writers the first wins and the others look again at what is now in the table.  A batch that is
repeated after a crash finds its own name in the log and adds nothing.  Readers take the folders of
one version; compaction replaces folders in one commit and deletes nothing, so they are not disturbed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.dedup import dedup

LOG_DDL = "version BIGINT, batch STRING, added ARRAY<STRING>, removed ARRAY<STRING>"
KEY_HASH = "key_hash"


@dataclass
class Version:
    """What the log says: the current folders and the batches that were ever committed."""

    number: int = 0
    folders: list[str] = field(default_factory=list)
    batches: set[str] = field(default_factory=set)


class CommittedTable:
    """One table below ``path``; ``ddl`` names its columns without those of ``partition_by``.

    Partition columns are numbers or text that rows carry besides the columns of ``ddl``.
    """

    def __init__(self, path: str, ddl: str, partition_by: Sequence[str] = ()):
        self.path, self.ddl, self.partition_by = path.rstrip("/"), ddl, list(partition_by)
        self.data, self.log = f"{self.path}/data", f"{self.path}/commits"

    # --- log -----------------------------------------------------------------------------

    def version(self, spark: SparkSession) -> Version:
        """The newest version; the log has one line per commit, and nothing else is read."""
        try:
            lines = spark.read.schema(LOG_DDL).json(self.log).orderBy("version").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return Version()
        now = Version()
        for line in lines:
            now.number = line["version"]
            gone = set(line["removed"])
            now.folders = [f for f in now.folders if f not in gone] + line["added"]
            now.batches.add(line["batch"])
        return now

    def _commit(
        self, spark: SparkSession, number: int, batch: str, added: list[str], removed: list[str]
    ) -> bool:
        """Make version ``number``; False if another writer has made it."""
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        draft = path(f"{self.log}/_{uuid.uuid4().hex}")
        store = draft.getFileSystem(conf)
        line = {"version": number, "batch": batch, "added": added, "removed": removed}
        out = store.create(draft, False)
        out.write(bytearray(json.dumps(line).encode()))
        out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), conf)
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = spark.sparkContext._gateway.new_array(kind, 0)
        try:
            context.rename(draft, path(f"{self.log}/{number:020d}.json"), none)
            return True
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in error.java_exception.getClass().getName():
                raise
            store.delete(draft, False)
            return False

    def _delete(self, spark: SparkSession, folder: str) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    # --- rows ----------------------------------------------------------------------------

    def _folder(self, token: str) -> str:
        return f"{self.data}/part={token}"

    def _rows(self, spark: SparkSession, folders: Sequence[str]) -> DataFrame:
        ddl = ", ".join([self.ddl, *[f"{c} STRING" for c in self.partition_by]])
        if not folders:
            return spark.createDataFrame([], f"{ddl}, {KEY_HASH} BIGINT")
        reader = spark.read.schema(f"{ddl}, part STRING, {KEY_HASH} BIGINT")
        reader = reader.option("basePath", self.data)
        return reader.parquet(*[self._folder(t) for t in folders]).drop("part")

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows of the newest version."""
        return self._rows(spark, self.version(spark).folders).drop(KEY_HASH)

    def _stage(self, rows: DataFrame) -> str:
        token = f"p-{uuid.uuid4().hex}"
        writer = rows.write.partitionBy(*self.partition_by) if self.partition_by else rows.write
        writer.parquet(self._folder(token))
        return token

    def _append(
        self, spark: SparkSession, batch: str, fresh: Callable[[Version], DataFrame]
    ) -> bool:
        while True:
            now = self.version(spark)
            if batch in now.batches:
                return False
            token = self._stage(fresh(now))
            if self._commit(spark, now.number + 1, batch, [token], []):
                return True
            self._delete(spark, self._folder(token))

    def append(self, rows: DataFrame, batch: str) -> bool:
        """Add all rows under the name of their batch; False if that batch is in the table."""
        keyed = rows.withColumn(KEY_HASH, F.lit(None).cast("long"))
        return self._append(rows.sparkSession, batch, lambda now: keyed)

    def append_new(
        self,
        rows: DataFrame,
        keys: Sequence[str],
        batch: str,
        order_by: Sequence[Column] | None = None,
        unique: bool = False,
    ) -> bool:
        """Add the rows whose key the table lacks, one per key; False if the batch is in the table.

        ``unique`` tells that no two rows share a key, so that they need not be compared again.
        NULLs in keys count as equal.  Only partitions that the batch has rows in are looked at, so
        equal keys must have equal partition columns.  Their stored key hashes are read first: rows
        without a match there are new, and only the others meet the stored keys themselves.
        """
        spark = rows.sparkSession
        name = f"{self.path}/staging-{uuid.uuid4().hex}"
        once = rows if unique else dedup(rows, keys, order_by)
        once.withColumn(KEY_HASH, F.xxhash64(*keys)).write.parquet(name)
        try:
            staged = spark.read.parquet(name)
            places = staged.select(*[F.col(c).cast("string") for c in self.partition_by]).distinct()
            places = [tuple(r) for r in places.collect()] if self.partition_by else []

            def fresh(now: Version) -> DataFrame:
                if not now.folders:
                    return staged
                stored = self._rows(spark, now.folders)
                for i, column in enumerate(self.partition_by):
                    stored = stored.filter(F.col(column).isin(sorted({p[i] for p in places})))
                hashes = stored.select(KEY_HASH)
                suspects = staged.join(hashes, KEY_HASH, "left_semi")
                known = stored.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
                same = [suspects[k].eqNullSafe(known[f"_known_{k}"]) for k in keys]
                really = suspects.join(known, reduce(lambda a, b: a & b, same), "left_anti")
                return staged.join(hashes, KEY_HASH, "left_anti").unionByName(really)

            return self._append(spark, batch, fresh)
        finally:
            self._delete(spark, name)

    # --- compaction ----------------------------------------------------------------------

    def files(self, spark: SparkSession, folders: Sequence[str] | None = None) -> DataFrame:
        """``file`` (below the data folder), its ``folder``, ``place`` and ``length``; no data is read."""
        folders = self.version(spark).folders if folders is None else folders
        if not folders:
            return spark.createDataFrame([], "file STRING, folder STRING, place STRING, length BIGINT")
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        found = reader.option("pathGlobFilter", "*.parquet").load([self._folder(t) for t in folders])
        file = F.substring_index("path", "/data/", -1)
        return found.select(
            file.alias("file"),
            F.regexp_extract(file, "^part=([^/]+)/", 1).alias("folder"),
            F.regexp_extract(file, "^[^/]+/(?:(.*)/)?[^/]+$", 1).alias("place"),
            "length",
        )

    def compact(self, spark: SparkSession, target_bytes: int = 256 << 20) -> int:
        """Rewrite the folders whose files are small into files of about ``target_bytes``.

        Small means less than half the target on average.  The files of a partition are packed in
        order of size into bins, and every bin becomes one file by one task.  Returns the number of
        folders replaced; a concurrent append does not disturb, a concurrent compaction wins or loses.
        """
        now = self.version(spark)
        files = self.files(spark, now.folders)
        small = files.groupBy("folder").agg(F.avg("length").alias("mean"))
        small = [r["folder"] for r in small.filter(F.col("mean") < target_bytes / 2).collect()]
        if not small:
            return 0
        # One row per file: metadata, so a window over all of them is small.
        fill = Window.partitionBy("place").orderBy(F.desc("length"), "file")
        before = F.sum("length").over(fill) - F.col("length")
        bins = files.filter(F.col("folder").isin(small)).select(
            "file", "place", F.floor(before / target_bytes).alias("bin")
        )
        number = F.dense_rank().over(Window.orderBy("place", "bin")) - 1
        bins = bins.select("file", number.cast("int").alias("bin"))
        n = bins.agg(F.max("bin")).first()[0] + 1
        rows = self._rows(spark, small)
        columns = rows.columns
        rows = rows.select("*", F.substring_index("_metadata.file_path", "/data/", -1).alias("file"))
        packed = rows.join(bins, "file").repartitionById(n, F.col("bin")).select(*columns)
        token = self._stage(packed)
        while not set(small) - set(now.folders):
            if self._commit(spark, now.number + 1, f"compact-{token}", [token], small):
                return len(small)
            now = self.version(spark)
        self._delete(spark, self._folder(token))
        return 0

    def vacuum(self, spark: SparkSession, keep: Sequence[str] = ()) -> list[str]:
        """Delete the folders that compaction replaced, but for ``keep``; for when no reader has them."""
        now = self.version(spark)
        lines = spark.read.schema(LOG_DDL).json(self.log)
        removed = [r[0] for r in lines.select(F.explode("removed")).distinct().collect()]
        gone = [t for t in removed if t not in now.folders and t not in keep]
        for token in gone:
            self._delete(spark, self._folder(token))
        return gone
