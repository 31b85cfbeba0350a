import gzip
import hashlib
import io

from pyspark.sql import functions as F
from wardflow.llm import warc
from wardflow.session import scoped_conf


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as HTML", "2 as id")


def test_round_trip(spark):
    big, small = "<p>ü</p>" * 40, "ab"
    rows = [(7, "u1", big), (3, "u2\r\nX: y", big), (9, None, big), (4, "u", small), (5, "u", small)]
    rows += [(6, "u", None), (8, "u", ""), (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "x" * 99), (13, "u", "x" * 99)]
    rows += [(14, "u", "long" * 200_000)]
    got = {r["page_id"]: r for r in warc.archive_round_trip(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    revisits = {7: 3, 9: 3, 11: 10}
    for i, _, h in rows:
        data = (h or "").encode()
        assert got[i]["payload_bytes"] == len(data) and got[i]["payload_digest"] == hashlib.sha256(data).hexdigest()
        assert got[i]["record_type"] == ("revisit" if i in revisits else "response")
        assert got[i]["refers_to"] == revisits.get(i)


def test_edges(spark):
    assert warc.archive_round_trip(pages(spark, [])).count() == 0
    same = "q" * 200
    rows = [(1, "a", same), (1, "b", same), (None, "c", same), (None, "d", "w" * 150), (None, "e", "w" * 150)]
    got = sorted((r["page_id"] is None, r["record_type"], r["refers_to"]) for r in warc.archive_round_trip(pages(spark, rows)).collect() if r["refers_to"] is None)
    assert got == [(False, "response", None)] * 2 + [(True, "response", None)] * 2
    assert warc.archive_round_trip(pages(spark, rows)).filter("refers_to = 1 and page_id is null").count() == 1


def test_payloads_are_not_shuffled_for_few_copies(spark, plan_of):
    """Nor are archives read twice; many copies are joined by a shuffle, with the same result."""
    same = "q" * 200
    df = pages(spark, [(i, "u", same if i % 3 == 0 else f"{i:03d}" * 50) for i in range(30)])
    assert "Exchange hashpartitioning" not in plan_of(warc.as_records(df))
    got = warc.archive_round_trip(df)
    assert plan_of(got).count("BatchScan") == 1
    with scoped_conf(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        records = warc.as_records(df)
        assert "Exchange hashpartitioning" in plan_of(records)
        many = warc.archive_round_trip(df).collect()
    few = got.collect()
    assert sorted(map(tuple, few)) == sorted(map(tuple, many)) and len(few) == 30
    assert {r["page_id"]: r["refers_to"] for r in few} == {i: 0 if i and i % 3 == 0 else None for i in range(30)}


def test_pushdown_and_skipping(spark, tmp_path):
    warc.register(spark)
    rows = [(i, f"http://h/{i}", "x" * (50 + i)) for i in range(40)]
    path = str(tmp_path / "w")
    warc.as_records(pages(spark, rows).coalesce(1)).write.format("warc").option("rollBytes", 1500).mode("append").save(path)
    df = spark.read.format("warc").load(path)
    assert df.rdd.getNumPartitions() > 1
    one = df.filter((F.col("target_uri") == "http://h/7") & F.col("record_type").isin("response", "revisit"))
    assert [bytes(r["payload"]) for r in one.collect()] == [b"x" * 57]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "target_uri" not in [line for line in plan.splitlines() if "Filter" in line][0].replace("isnotnull(target_uri", "")
    assert df.filter(F.col("target_uri").startswith("http://h/3")).count() == 11
    lean = spark.read.format("warc").schema("target_uri string, payload_length long").load(path)
    assert lean.agg(F.sum("payload_length")).first()[0] == sum(50 + i for i in range(40))


class Counting(io.BytesIO):
    taken = 0

    def read(self, n=-1):
        out = super().read(min(n, 4096) if n > 0 else n)
        self.taken += len(out)
        return out


def test_payloads_not_wanted_are_not_read():
    import random

    noise = random.Random(1).randbytes(300_000)
    row = {"record_type": "response", "record_id": "<urn:page:1>", "payload": noise, "payload_digest": "d"}
    records = [warc.format_record(row | {"record_id": f"<urn:page:{i}>"}) for i in range(5)]
    for data, packed in ((b"".join(records), False), (b"".join(map(warc.gzip_member, records)), True)):
        stream = Counting(data)
        found = list(warc.read_records(stream, packed, lambda h: True, False))
        assert [r["record_id"] for r in found] == [f"<urn:page:{i}>" for i in range(5)]
        assert {r["payload_length"] for r in found} == {300_000} and stream.taken < 200_000
        full = list(warc.read_records(io.BytesIO(data), packed, lambda h: h["WARC-Record-ID"].endswith("3>"), True))
        assert [r["payload"] for r in full] == [noise]


def test_foreign_archives(tmp_path, spark):
    """Members without skip lengths, plain records, a warcinfo without HTTP block."""
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 4\r\n\r\na: b\r\n\r\n"
    row = {"record_type": "response", "record_id": "<r>", "payload": b"<html>", "target_uri": "http://x"}
    data = [info, warc.format_record(row), info]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(d) for d in data))
    (tmp_path / "b.warc").write_bytes(b"".join(data))
    assert gzip.decompress(warc.gzip_member(data[1])) == data[1]
    warc.register(spark)
    got = spark.read.format("warc").load(str(tmp_path)).collect()
    assert sorted((r["record_type"], bytes(r["payload"])) for r in got) == sorted([("warcinfo", b"a: b")] * 4 + [("response", b"<html>")] * 2)
