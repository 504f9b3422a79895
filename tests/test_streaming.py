import json
import os

import pytest
from pyspark.sql import functions as F

from transferlens.streaming import alerts, jobs, messages

T0 = 1_777_593_600


def put(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}")
    with open(tmp, "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    os.rename(tmp, os.path.join(folder, name))


def topic(spark, folder):
    os.makedirs(folder, exist_ok=True)
    return messages.read_topic(spark, "text", path=folder)


def tx(h, s=0, value=0, **more):
    return {"hash": h, "block_timestamp": T0 + s, "from_address": "a", "to_address": "b", "value": value, **more}


def run(stream, checkpoint, **kw):
    query = jobs.start(stream, checkpoint, **kw)
    query.awaitTermination()


def test_decode_aliases_problems_and_tombstones(spark):
    rows = [json.dumps(tx("1")), json.dumps({**tx("2"), "timestamp": T0 + 5}), '{"hash": "3", "item_timestamp": "1777593600", "from_address": "a"}', '{"hash": "4", "timestamp": "soon", "from_address": "a"}', "not json", json.dumps(tx("5", value="1.5")), json.dumps({**tx("6"), "timestamp": 0}), None]
    raw = spark.createDataFrame([(r,) for r in rows], "value string")
    decoded = messages.decode(raw, "transactions")
    ok = {r.hash: r for r in messages.accepted(decoded).collect()}
    assert set(ok) == {"1", "2", "3"} and ok["3"].value == "0" and ok["3"].gas_price == "0"
    assert [int(ok[h].event_time.timestamp()) - int(ok["1"].event_time.timestamp()) for h in "123"] == [0, 5, 0]
    bad = sorted((tuple(r.problems), r.raw[:12]) for r in messages.quarantined(decoded).collect())
    assert len(bad) == 4 and {p for p, _ in bad} == {("event_time",), ("hash", "event_time", "from_address"), ("value",)}


def test_transfers_without_time_are_valid(spark):
    row = {"transaction_hash": "t", "log_index": 1, "block_number": 7, "token_address": "x", "from_address": "a", "to_address": "b", "value": 10**20}
    raw = spark.createDataFrame([(json.dumps(row),), (json.dumps({**row, "log_index": "x"}),)], "value string")
    decoded = messages.decode(raw, "token_transfers")
    ok = messages.accepted(decoded).collect()
    assert [(r.block_number, r.value, r.event_time) for r in ok] == [(7, str(10**20), None)]
    assert [r.problems for r in messages.quarantined(decoded).collect()] == [["log_index"]]


def test_dedup_across_batches_and_restart(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def go():
        rows = messages.accepted(messages.decode(topic(spark, source), "transactions"))
        run(jobs.deduplicated(rows, ["hash", "event_time"]), checkpoint, path=out)

    put(source, "1.txt", [tx("a"), tx("a"), tx("b", 1)])
    go()
    put(source, "2.txt", [tx("a"), tx("c", 2), "garbage"])
    go()  # a second start continues from the checkpoint
    assert sorted(r.hash for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_block_time_waits_matches_and_gives_up(spark, tmp_path):
    blocks_in, transfers_in, out, checkpoint = (str(tmp_path / n) for n in ("blocks", "transfers", "out", "cp"))

    def transfer(h, block, s):
        return {"transaction_hash": h, "log_index": 0, "block_number": block, "token_address": "x", "from_address": "a", "to_address": "b", "arrived_at": T0 + s}

    def go():
        raw = topic(spark, transfers_in).drop("arrived").withColumn("arrived", F.timestamp_seconds(F.get_json_object("value", "$.arrived_at").cast("bigint")))
        left = messages.accepted(messages.decode(raw, "token_transfers"))
        right = messages.accepted(messages.decode(topic(spark, blocks_in).drop("arrived"), "blocks"))
        run(jobs.with_block_time(left, right, delay="1 minute", bound="10 minutes"), checkpoint, path=out)

    put(transfers_in, "1.txt", [transfer("early", 1, 0), transfer("never", 99, 5)])
    put(blocks_in, "1.txt", [{"number": 2, "timestamp": T0}])
    go()
    put(blocks_in, "2.txt", [{"number": 1, "timestamp": T0 + 30}])  # the block comes after its transfer
    go()
    got = {r.transaction_hash: r.event_time for r in spark.read.parquet(out).collect()}
    assert set(got) == {"early"} and int(got["early"].timestamp()) % 60 == 30
    put(transfers_in, "3.txt", [transfer("later", 3, 7200)])
    put(blocks_in, "3.txt", [{"number": 3, "timestamp": T0 + 7200}])
    go()
    go()
    got = {r.transaction_hash: r.event_time for r in spark.read.parquet(out).collect()}
    assert set(got) == {"early", "never", "later"} and got["never"] is None


def test_store_then_alert_and_replay(spark, tmp_path):
    source, target, sink, checkpoint = (str(tmp_path / n) for n in ("in", "target", "alerts", "cp"))
    big = 100 * 10**18
    failures = iter([True])

    def flaky(alert_rows, batch_id):
        if next(failures, False):
            assert spark.read.parquet(target).count() == 3  # stored before alerting
            raise RuntimeError("topic down")
        jobs.file_alert_sink(sink)(alert_rows, batch_id)

    body = jobs.store_and_alert(target, ["hash", "event_time"], flaky, 100)

    def go():
        run(messages.accepted(messages.decode(topic(spark, source), "transactions")), checkpoint, body=body)

    put(source, "1.txt", [tx("small", value=big - 1), tx("exact", value=big), tx("exact", value=big), tx("huge", 1, value=str(10**30))])
    with pytest.raises(Exception, match="topic down"):
        go()
    go()  # the failed batch is replayed: alerts go out, nothing is stored twice
    put(source, "2.txt", [tx("exact", value=big), tx("new", 2, value=big)])
    go()
    assert sorted(r.hash for r in spark.read.parquet(target).collect()) == ["exact", "huge", "new", "small"]
    first = spark.read.json(f"{sink}/batch=0")
    assert sorted(r.key for r in first.collect()) == ["exact", "huge"]
    decoded = alerts.decode(first.select("value")).where("hash = 'exact'").first()
    assert (decoded.value, decoded.value_eth, decoded.from_address) == (str(big), 100.0, "a")
    assert decoded.timestamp == "2026-05-01T00:00:00+00:00"


def test_alert_decode(spark):
    raw = spark.createDataFrame([('{"hash":"0x1","value":100000000000000000000}',), ("invalid json",), ('{"hash":"0x2","value":1,"value_eth":7.5}',), ('{"hash":"0x3"}',)], "value string")
    got = [(r.hash, r.value_eth) for r in alerts.decode(raw).collect()]
    assert got == [("0x1", 100.0), (None, None), ("0x2", 7.5), ("0x3", 0.0)]


def test_feed_merges_dedupes_and_stays_bounded(spark):
    def rows(ids):
        return spark.createDataFrame([(str(i), f"2026-05-01T00:00:{i:02d}Z") for i in ids], "hash string, timestamp string")

    feed = alerts.feed(alerts.feed(None, rows(range(5)), 4), rows([4, 4, 7]), 4)
    assert [r.hash for r in feed.orderBy(F.desc("timestamp")).collect()] == ["7", "4", "3", "2"]


def test_windows_drop_late_rows_and_close(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def go():
        rows = messages.accepted(messages.decode(topic(spark, source), "transactions"))
        run(jobs.trending_by_window(rows.withColumn("token_address", F.col("to_address")), "10 minutes", "10 minutes", "1 minute"), checkpoint, path=out)

    put(source, "1.txt", [tx("a", 0), tx("b", 60), tx("c", 700)])
    go()
    put(source, "2.txt", [tx("late", 30), tx("d", 1300)])
    go()
    got = sorted((r.window_start.minute, r.transfer_count) for r in spark.read.parquet(out).collect())
    assert got == [(0, 2), (10, 1)]
