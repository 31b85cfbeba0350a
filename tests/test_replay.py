"""Ordered replay: positions, ranges, restart; stored layouts in plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wardflow.operators.enrich import with_pruned_months
from wardflow.plans import stored
from wardflow.sinks.committed import CommittedTable
from wardflow.sinks.streams import for_each_batch
from wardflow.sinks.tables import drop_tables, write_bucketed, write_by_month
from wardflow.sources import generators, replay
from wardflow.streaming import jobs

FILES = {
    "a.csv": b"k,v\n1,one\n2,\xc3\xa9\xc3\xa9\n\n3,three\n",
    "b.csv": b"k,v\r\n4,four\r\n5,\"f,i\"\r\n6,six",  # no line end at the end
    "c.csv": b"k,v\n",
    "d.csv": b"k,v\n7," + b"x" * 300 + b"\n8,eight\n",
    "_hidden": b"no\n",
}
KEYS = list(range(1, 9))


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "csv"
    path.mkdir()
    for name, data in FILES.items():
        (path / name).write_bytes(data)
    return str(path)


def reader(folder, tmp_path, batch, size):
    return replay.ReplayReader({"path": folder, "positions": str(tmp_path / "pos"), "batchbytes": str(batch), "rangebytes": str(size)})


@pytest.mark.parametrize("batch,size", [(1, 1), (7, 3), (20, 1000), (50, 7), (10_000, 5)])
def test_every_line_once_at_any_cut(folder, tmp_path, batch, size):
    want = []
    for name in sorted(FILES):
        if name != "_hidden":
            want += [(name, line.rstrip("\r\n")) for line in FILES[name].decode().split("\n") if line or name != "_hidden"]
    want = [(n, x) for n, x in want]
    got, at, rounds = [], reader(folder, tmp_path, batch, size).initialOffset(), 0
    while True:
        one = reader(folder, tmp_path, batch, size)  # a restart before every batch
        end = one.latestOffset()
        if end == at:
            break
        for _ in range(2):  # a batch that is planned again reads the same
            lines = [r for p in one.partitions(at, end) for b in one.read(p) for r in b.to_pylist()]
        got += [(r["file"], r["line"]) for r in lines]
        one.commit(end)
        at, rounds = end, rounds + 1
    assert [(n, x) for n, x in got if x] == [(n, x) for n, x in want if x]
    assert rounds >= 3 or batch > 100


def test_restart_reads_on_at_the_exact_line(spark, tmp_path, folder):
    table = CommittedTable(str(tmp_path / "t"), "k INT, v STRING, replay_file STRING, replay_byte BIGINT")
    fail = [True]

    def add(batch, batch_id):
        if batch_id == 1 and fail:
            fail.pop()
            batch.limit(1).collect()
            raise RuntimeError("half-way")
        table.append(batch, f"b{batch_id}")

    for last in (False, True, True):
        if last and not (tmp_path / "csv" / "e.csv").exists():
            (tmp_path / "csv" / "e.csv").write_bytes(b"k,v\n9,new\n")
        lines = replay.replay_lines(spark, folder, str(tmp_path / "pos"), 30, 8)
        rows = replay.replay_csv(lines, "k INT, v STRING")
        query = for_each_batch(rows, add, str(tmp_path / "ck"), every=None)
        if last:
            jobs.drain_source(query)
        else:
            with pytest.raises(Exception, match="half-way"):
                jobs.drain_source(query)
            spark.streams.resetTerminated()
    got = table.read(spark).orderBy("replay_file", "replay_byte").collect()
    assert [r["k"] for r in got] == [*KEYS, 9]
    assert [r["v"] for r in got][1:5] == ["éé", "three", "four", "f,i"]


def test_bucketed_tables_join_without_shuffle(spark, tmp_path, plan_of):
    left = spark.range(500).select(F.col("id").alias("stay_id"), F.lit(1.0).alias("los"))
    right = spark.range(0, 500, 2).select(F.col("id").alias("stay_id"), F.lit(80).alias("heartrate"), F.lit(2).alias("acuity"))
    one = write_bucketed(left, "t_left", ["stay_id"], 4, str(tmp_path / "l"))
    two = write_bucketed(right, "t_right", ["stay_id"], 4, str(tmp_path / "r"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.join_bucketed(one, two)
        assert "Exchange" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)
        assert "Exchange" not in plan_of(one.groupBy("stay_id").count())
        assert joined.count() == 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        drop_tables(spark, ["t_left", "t_right"])
    import os

    files = [f for f in os.listdir(tmp_path / "l") if f.endswith(".parquet")]
    assert len(files) <= 4


def test_filtered_dates_prune_months(spark, tmp_path, plan_of):
    start = dt.date(2150, 1, 1)
    days = [start + dt.timedelta(days=7 * i) for i in range(100)]
    fact = spark.createDataFrame([(i, int(d.strftime("%Y%m%d"))) for i, d in enumerate(days)] + [(100, None)], "id INT, day INT")
    path = str(tmp_path / "fact")
    write_by_month(fact, "day", path)
    dates = generators.date_dim(spark, "2150-01-01", "2151-12-31") if hasattr(generators, "date_dim") else None
    dates = dates if dates is not None else generators.date_dim_over(spark.createDataFrame([(d,) for d in days], "d DATE"), "d")
    wanted = dates.filter((F.col("year") == 2150) & (F.col("month") == 3))
    joined = with_pruned_months(spark.read.parquet(path), wanted, "day")
    assert "dynamicpruning" in plan_of(joined)
    got = sorted(r["id"] for r in joined.collect())
    assert got == [i for i, d in enumerate(days) if (d.year, d.month) == (2150, 3)]
