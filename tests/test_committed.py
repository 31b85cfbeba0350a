"""Committed tables, exact streaming dedup and counters per micro-batch."""

import threading

import pytest
from pyspark.sql import functions as F

from wardflow.plans.catalog import EVENT_SPEC, MESSAGE_DDL
from wardflow.sinks import committed
from wardflow.sinks.committed import CommittedTable
from wardflow.sinks.streams import for_each_batch, write_stream
from wardflow.sources.readers import read_stream
from wardflow.streaming import counters, jobs

DDL = "k INT, v STRING"


def frame(spark, rows, ddl=DDL):
    return spark.createDataFrame(rows, ddl)


def test_a_batch_counts_once(spark, tmp_path, rows):
    table = CommittedTable(str(tmp_path / "t"), DDL)
    assert rows(table.read(spark)) == []
    assert table.append_new(frame(spark, [(1, "a"), (1, "a"), (None, "n")]), ["k"], "b0")
    more = frame(spark, [(1, "late"), (2, "b"), (None, "again")])
    assert table.append_new(more, ["k"], "b1")
    assert not table.append_new(more, ["k"], "b1")
    assert not table.append(frame(spark, [(9, "x")]), "b0")
    assert rows(table.read(spark)) == [(1, "a"), (2, "b"), (None, "n")]
    assert table.append(frame(spark, [(2, "b")]), "plain") and table.read(spark).count() == 4
    assert table.version(spark).number == 3


def test_crash_before_the_commit_leaves_nothing(spark, tmp_path, monkeypatch, rows):
    table = CommittedTable(str(tmp_path / "t"), DDL)
    table.append_new(frame(spark, [(1, "a")]), ["k"], "b0")

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.append_new(frame(spark, [(2, "b")]), ["k"], "b1")
    assert rows(table.read(spark)) == [(1, "a")]
    assert table.append_new(frame(spark, [(2, "b")]), ["k"], "b1")
    assert rows(table.read(spark)) == [(1, "a"), (2, "b")]


def test_writers_at_once_add_each_key_once(spark, tmp_path):
    table, results = CommittedTable(str(tmp_path / "t"), DDL), []

    def write(i):
        data = frame(spark, [(k, f"w{i}") for k in range(i, i + 6)])
        results.append(table.append_new(data, ["k"], f"w{i}"))

    writers = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert results == [True] * 4
    keys = [r["k"] for r in table.read(spark).collect()]
    assert sorted(keys) == list(range(9)) and table.version(spark).number == 4


def test_hash_collisions_are_told_apart(spark, tmp_path, monkeypatch, rows):
    table = CommittedTable(str(tmp_path / "t"), DDL)
    monkeypatch.setattr("wardflow.sinks.committed.F.xxhash64", lambda *_: F.lit(7).cast("long"))
    table.append_new(frame(spark, [(1, "a"), (2, "b")]), ["k"], "b0")
    table.append_new(frame(spark, [(2, "x"), (3, "c")]), ["k"], "b1")
    assert rows(table.read(spark)) == [(1, "a"), (2, "b"), (3, "c")]


def test_only_partitions_of_the_batch_are_read(spark, tmp_path, rows):
    table = CommittedTable(str(tmp_path / "t"), DDL, ["month"])
    ddl = DDL + ", month STRING"
    table.append_new(frame(spark, [(1, "a", "202401"), (2, "b", "202402")], ddl), ["k"], "b0")
    table.append_new(frame(spark, [(1, "z", "202401"), (3, "c", "202402")], ddl), ["k"], "b1")
    assert rows(table.read(spark)) == [(1, "a", "202401"), (2, "b", "202402"), (3, "c", "202402")]


def test_compaction_keeps_rows_and_readers(spark, tmp_path, rows):
    table = CommittedTable(str(tmp_path / "t"), DDL, ["month"])
    data = [(i, "x" * 50 + str(i), f"20240{1 + i % 2}") for i in range(400)]
    for b in range(4):
        table.append_new(frame(spark, data[b::4], DDL + ", month STRING").repartition(4), ["k"], f"b{b}")
    before, old = table.version(spark), table.read(spark)
    n, size = table.files(spark).agg(F.count("*"), F.sum("length")).first()
    assert table.compact(spark, size) == 4
    assert table.files(spark).count() == 2  # one file per month
    assert rows(table.read(spark)) == sorted(data, key=repr)
    assert rows(old) == sorted(data, key=repr)  # a reader of the old version
    assert table.compact(spark, 1) == 0  # nothing is small now
    assert not table.append_new(frame(spark, data[:9], DDL + ", month STRING"), ["k"], "b0")
    assert table.append_new(frame(spark, [*data[:9], (999, "n", "202401")], DDL + ", month STRING"), ["k"], "b9")
    assert table.read(spark).count() == 401
    assert sorted(table.vacuum(spark)) == sorted(before.folders)
    assert table.read(spark).count() == 401


def test_stream_appends_once_when_a_batch_repeats(spark, tmp_path):
    src = str(tmp_path / "src")
    frame(spark, [(i % 7, "a") for i in range(50)]).write.parquet(src)
    table = CommittedTable(str(tmp_path / "t"), DDL)
    fail = [True]

    def add(batch, batch_id):
        table.append_new(batch, ["k"], f"s-{batch_id}")
        if fail.pop() if fail else False:
            raise RuntimeError("after the commit, before the checkpoint")

    for last in (False, True):
        stream = read_stream(spark, src, DDL, max_files=1000)
        query = for_each_batch(stream, add, str(tmp_path / "ck"), available_now=True)
        if last:
            jobs.drain([query])
        else:
            with pytest.raises(Exception, match="before the checkpoint"):
                query.awaitTermination()
            spark.streams.resetTerminated()
    assert table.read(spark).count() == 7 and table.version(spark).number == 1


def messages_of(spark, ids, day):
    data = [(i, 1, 1, i % 3, f"2024-0{1 + i % 2}-{day:02d}T00:00:{i % 60:02d}.000000", "NaT", f"it{i}", "v", 1.0, "u", "0.0") for i in ids]
    return spark.createDataFrame(data, MESSAGE_DDL)


def test_exact_dedup_has_bounded_state(spark, tmp_path):
    bronze = str(tmp_path / "bronze")
    silver = jobs.exact_silver_table(EVENT_SPEC, str(tmp_path / "silver"))
    states = []
    # Days go back and forth: no row is late, and copies come many runs after their first.
    for ids, day in ((range(40), 20), (range(40, 80), 2), (range(40), 20), (range(80, 120), 28), (range(40, 80), 2)):
        messages_of(spark, ids, day).write.mode("append").parquet(bronze)
        query = jobs.bronze_to_silver_exact(
            spark, EVENT_SPEC, bronze, silver, str(tmp_path / "ck"), "s",
            recent="0 seconds", max_files=1000, available_now=True,
        )
        jobs.drain([query])
        states.append(max(op.numRowsTotal for p in query.recentProgress for op in p.stateOperators))
    got = [r["event_id"] for r in silver.read(spark).collect()]
    assert sorted(got) == list(range(120))
    assert max(states) <= 80  # of 200 messages, those of the last two runs at most


def test_exact_stream_compares_the_rows_of_a_batch_once(spark, tmp_path, monkeypatch):
    """The state has left one row per key, so the table does not group the batch again."""
    grouped, dedup = [], committed.dedup
    monkeypatch.setattr(committed, "dedup", lambda *given: grouped.append(1) or dedup(*given))
    silver = jobs.exact_silver_table(EVENT_SPEC, str(tmp_path / "silver"))
    for _ in range(2):
        messages_of(spark, [*range(20), *range(20)], 5).repartition(3).write.mode("append").parquet(str(tmp_path / "bronze"))
        query = jobs.bronze_to_silver_exact(
            spark, EVENT_SPEC, str(tmp_path / "bronze"), silver, str(tmp_path / "ck"), "s",
            recent="0 seconds", max_files=1000, available_now=True,
        )
        jobs.drain([query])
    assert not grouped and silver.read(spark).count() == 20


def test_counters_of_each_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    rows = [[("a", "é", True), ("b", "xyz", False)], [("c", None, True), ("d", "12", None)]]
    seen = counters.DeliveryCounters(spark, "d", str(tmp_path / "counters"))
    for data in rows:
        frame(spark, data, "key STRING, value STRING, ok BOOLEAN").write.mode("append").parquet(src)
        stream = read_stream(spark, src, "key STRING, value STRING, ok BOOLEAN", max_files=1000)
        with seen:
            query = write_stream(
                counters.observe_delivery(stream, "d", F.col("ok")), str(tmp_path / "out"), str(tmp_path / "ck"),
                available_now=True,
            )
            jobs.drain([query])
            assert seen.wait([query])
    found = counters.read_counters(spark, str(tmp_path / "counters"))
    assert sorted(tuple(r)[1:] for r in found.collect()) == [(0, 1, 1, 2), (1, 1, 1, 0)]
    again = found.withColumn("query_id", F.col("query_id"))
    again.write.mode("append").parquet(str(tmp_path / "counters"))
    assert counters.read_counters(spark, str(tmp_path / "counters")).count() == 2
