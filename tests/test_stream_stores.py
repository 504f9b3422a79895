"""Key index, live views, bounded batches and metrics of streams."""

import datetime as dt
import json
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from transferlens.sources.folders import children
from transferlens.streaming import jobs, keys, messages, views

T0 = 1_777_593_600
KEYS = ["transaction_hash", "log_index"]


def rows(spark, hashes, day, timed=False):
    at = dt.datetime(2026, 5, day, 12)
    data = [(h, 0, at if timed else None, at) for h in hashes]
    return spark.createDataFrame(data, "transaction_hash string, log_index long, event_time timestamp, arrived timestamp")


def stored_hashes(spark, target):
    return sorted(r["transaction_hash"] for r in spark.read.parquet(target).collect())


def test_untimed_rows_are_known_on_later_days(spark, tmp_path):
    target = str(tmp_path / "t")
    jobs.store_batch(rows(spark, "abc", 1), 0, target, KEYS)
    jobs.store_batch(rows(spark, "abcd", 2), 1, target, KEYS)
    jobs.store_batch(rows(spark, "ad", 3, timed=True), 2, target, KEYS)  # now with a time: still the same rows
    assert stored_hashes(spark, target) == list("abcd")
    assert len(spark.read.parquet(target).select("dt").distinct().collect()) == 2


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "t")
    jobs.store_batch(rows(spark, "ab", 1), 0, target, KEYS)
    for _ in range(3):
        jobs.store_batch(rows(spark, "bcd", 2), 1, target, KEYS)
    jobs.store_batch(rows(spark, "cde", 3), 2, target, KEYS)
    assert stored_hashes(spark, target) == list("abcde")


def test_only_touched_buckets_are_read(spark, tmp_path):
    index, batch = str(tmp_path / "i"), rows(spark, [f"h{k}" for k in range(200)], 1)
    schema = batch.select(*KEYS).schema
    keys.add_keys(batch, index, KEYS, 0, 16)
    wanted = [r["b"] for r in rows(spark, ["h1", "h2", "h1"], 2).select(keys.key_bucket(KEYS, 16).alias("b")).distinct().collect()]
    found = keys.known_keys(spark, index, schema, wanted, 1)
    folders = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    assert 0 < len(wanted) < 16 and folders == {str(b) for b in wanted}
    assert {"h1", "h2"} <= {r["transaction_hash"] for r in found.collect()}
    assert keys.known_keys(spark, index, schema, wanted, 0).count() == 0  # a batch does not know its own attempt


def test_folded_keys_stay_known_and_an_interrupted_fold_is_ignored(spark, tmp_path):
    target = str(tmp_path / "t")
    for batch in range(5):
        jobs.store_batch(rows(spark, ["same", f"h{batch}"], 1 + batch), batch, target, KEYS, buckets=4, fold_every=2)
    index = keys.index_of(target)
    assert keys.newest_base(spark, index) == 3
    left = {n for b in children(spark, f"{index}/delta") if b.startswith("bucket=") for n in children(spark, f"{index}/delta/{b}")}
    assert left == {"batch=4"}
    os.makedirs(f"{index}/base=9/bucket=0")  # broken off before it was complete
    jobs.store_batch(rows(spark, ["same", "h0", "h4", "new"], 9), 5, target, KEYS, buckets=4)
    assert stored_hashes(spark, target) == ["h0", "h1", "h2", "h3", "h4", "new", "same"]
    schema = rows(spark, "a", 1).select(*KEYS).schema
    keys.fold_keys(spark, index, schema, 5)
    keys.fold_keys(spark, index, schema, 5)
    everything = keys.known_keys(spark, index, schema, range(4), 6)
    assert sorted(r["transaction_hash"] for r in everything.collect()) == stored_hashes(spark, target)


def steps(spark, data):
    at = [(dt.datetime(2026, 5, 1, 10, m), Decimal(g), n) for m, g, n in data]
    return spark.createDataFrame(at, "step_start timestamp, gas_wei decimal(38,0), transactions long")


def test_a_view_merges_changes_and_rebuilds_the_same_version(spark, tmp_path):
    path, body = str(tmp_path / "v"), views.view_body(str(tmp_path / "v"), ["step_start"], keep="10 minutes")
    shape = steps(spark, [])
    assert views.latest_view(spark, path, shape).collect() == []
    body(steps(spark, [(0, 10, 1), (1, 20, 2)]), 0)
    for _ in range(2):
        body(steps(spark, [(1, 50, 5), (4, 1, 1)]), 1)
    seen = {r["step_start"].minute: (int(r["gas_wei"]), r["transactions"]) for r in views.latest_view(spark, path, shape).collect()}
    assert seen == {0: (10, 1), 1: (50, 5), 4: (1, 1)}
    body(steps(spark, []), 2)  # nothing changed
    assert views.latest_view(spark, path, shape).count() == 3
    body(steps(spark, [(12, 7, 1)]), 3)
    assert sorted(r["step_start"].minute for r in views.latest_view(spark, path, shape).collect()) == [4, 12]
    assert children(spark, path) == ["version=2", "version=3"]


def test_live_gas_holds_open_windows(spark):
    view = steps(spark, [(0, 4 * 10**9, 2), (3, 6 * 10**9, 1)])
    got = {r["window_start"].minute: (r["average_gas_price_gwei"], r["transactions"]) for r in views.live_gas(view).where("hour(window_start) = 10").collect()}
    assert got == {0: (3.33, 3), 1: (6.0, 1), 2: (6.0, 1), 3: (6.0, 1)}


def put(folder, name, hashes):
    os.makedirs(folder, exist_ok=True)
    lines = [json.dumps({"hash": h, "block_timestamp": T0, "from_address": "a", "to_address": "b", "value": str(200 * 10**18)}) for h in hashes]
    with open(f"{folder}/.{name}", "w") as f:
        f.write("\n".join(lines))
    os.rename(f"{folder}/.{name}", f"{folder}/{name}")


def test_backlog_in_bounded_batches_and_drain_at_stop(spark, tmp_path):
    source, target, sink = (str(tmp_path / n) for n in ("in", "t", "alerts"))
    for k in range(7):
        put(source, f"{k}.txt", [f"h{k}-{j}" for j in range(10)])
    stream = messages.accepted(messages.decode(messages.read_topic(spark, "text", limit=3, path=source), "transactions"))
    body = jobs.ledger_body({"transactions": (target, ["hash", "event_time"])}, jobs.topic_alert_sink("json", path=sink), 100)
    job = jobs.start(jobs.with_batch_metrics(stream), str(tmp_path / "cp"), body=body, available_now=False, interval="0 seconds")
    jobs.drain(job)
    assert not job.isActive
    sizes = [b["rows"] for b in jobs.batch_metrics(job)]
    assert sum(sizes) == 70 and max(sizes) <= 30 and len(sizes) >= 3
    assert spark.read.parquet(target).count() == 70
    assert spark.read.json(sink).select("key").distinct().count() == 70  # alerts in a second format


def test_delays_per_minute_of_storing(spark, tmp_path):
    target, clock = str(tmp_path / "t"), F.lit("2026-05-01 12:10:00").cast("timestamp")
    batch = spark.range(20).select(F.col("id").cast("string").alias("hash"), F.timestamp_seconds(F.unix_seconds(clock) - F.col("id") * 10).alias("event_time"))
    jobs.store_batch(batch, 0, target, ["hash"], stored_at=clock)
    found = jobs.ingest_delay(spark.read.parquet(target)).first()
    assert (found["rows"], found["p50_seconds"], found["p95_seconds"]) == (20, pytest.approx(90), pytest.approx(180))
