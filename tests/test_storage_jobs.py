"""Compaction, appends with a mark, versioned dimensions, and source counts observed while writing."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.test_day import DAY, config  # noqa: F401
from transferlens.operators.lookup import counted_broadcast
from transferlens.plans import day, enrich, quality
from transferlens.plans import serving
from transferlens.sources import compaction, dimensions, sinks
from transferlens.sources.folders import children, move

SCHEMA = "address string, at long, dt date"
HOW = {"segment_by": "address", "order_by": "at"}


@pytest.fixture
def table(spark, tmp_path):
    root = str(tmp_path / "t")
    days = spark.range(3000).select(F.concat(F.lit("a"), F.col("id") % 40).alias("address"), F.col("id").alias("at"), F.date_add(F.lit("2026-05-01").cast("date"), (F.col("id") % 10).cast("int")).alias("dt"))
    days.repartition(6).write.partitionBy("dt").parquet(root)
    return root, days.schema, sorted(map(tuple, days.collect()))


def rows(spark, root, schema):
    return sorted(map(tuple, spark.read.schema(schema).parquet(root).collect()))


def files_of(root, day_):
    return [f for f in os.listdir(f"{root}/{day_}") if f.startswith("part-")]


def test_aged_days_are_compacted_once(spark, table):
    root, schema, before = table
    done = compaction.compact(spark, root, schema, date(2026, 5, 12), **HOW)
    assert done == [f"dt=2026-05-{k:02d}" for k in range(1, 5)]
    assert rows(spark, root, schema) == before
    assert all(len(files_of(root, d)) <= 2 for d in done) and len(files_of(root, "dt=2026-05-05")) == 6
    assert compaction.compact(spark, root, schema, date(2026, 5, 12), **HOW) == []
    assert [n for n in children(spark, root) if not n.startswith("dt=")] == ["_SUCCESS"]
    spark.createDataFrame([("late", -1, date(2026, 5, 2))], schema).write.partitionBy("dt").mode("append").parquet(root)
    assert compaction.compact(spark, root, schema, date(2026, 5, 12), **HOW) == ["dt=2026-05-02"]
    assert rows(spark, root, schema) == sorted([*before, ("late", -1, date(2026, 5, 2))])


@pytest.mark.parametrize("stop", ["rewriting", "rewritten", "aside", "swapped", "rewriting with one aside"])
def test_a_broken_run_is_ended_by_the_next(spark, table, stop):
    root, schema, before = table
    days = ["dt=2026-05-01", "dt=2026-05-02"]
    compaction.rewrite(spark, root, days, schema, **HOW)
    if "rewriting" in stop:
        os.remove(f"{root}/{compaction.FRESH}/{compaction.COMPLETE}")
    if stop in ("aside", "swapped", "rewriting with one aside"):
        compaction.set_aside(spark, root, days[0])
    if stop == "swapped":  # the new folder is in place, the old one not yet gone
        move(spark, f"{root}/{compaction.FRESH}/{days[0]}", f"{root}/{days[0]}")
    compaction.compact(spark, root, schema, date(2026, 5, 12), **HOW)
    assert rows(spark, root, schema) == before
    assert compaction.aged_days(spark, root, date(2026, 5, 12)) == []
    assert [n for n in children(spark, root) if not n.startswith("dt=")] == ["_SUCCESS"]


def test_append_once(spark, tmp_path):
    root = str(tmp_path / "w")
    first = spark.createDataFrame([(1, "x", "u"), (2, "y", "v")], "k int, p string, q string")
    second = spark.createDataFrame([(3, "x", "u")], first.schema)
    for batch, load in (("a", first), ("b", second), ("a", first), ("a", first.where("k = 2")), ("b", second)):
        sinks.append_once(load, root, batch, "json", ["p", "q"])
    back = spark.read.schema("k int, p string, q string, load_batch string").json(root)
    assert sorted((r.k, r.p, r.q, r.load_batch) for r in back.collect()) == [(2, "y", "v", "a"), (3, "x", "u", "b")]


def test_versions_of_a_dimension(spark, tmp_path):
    root, csv = str(tmp_path / "d"), str(tmp_path / "t.csv")
    fixed = spark.createDataFrame([("0x0", "BURN", "Burn", 0)], "address string, symbol string, name string, decimals int")

    def load():
        return {r.address: r.symbol for r in dimensions.load_version(spark, root, csv, dimensions.read_token_csv, fixed.schema, fixed=fixed).collect()}

    assert load() == {"0x0": "BURN"} and children(spark, root) == []
    for lines in (["0xA,A1,Aa,6", "0xB,B1,Bb,x"], ["0xb,B2,Bb,8"], ["0xC,C1,Cc,1"]):
        with open(csv, "w") as f:
            f.write("\n".join(["address,symbol,name,decimals", *lines]))
        found = load()
    assert found == {"0x0": "BURN", "0xa": "A1", "0xb": "B2", "0xc": "C1"}
    os.makedirs(f"{root}/version=9")  # broken off
    os.remove(csv)
    assert load() == found and [n for n in children(spark, root)] == ["version=2", "version=3", "version=9"]


# ---- the daily run -----------------------------------------------------------------------------


def test_raw_tables_are_read_once(spark, config, monkeypatch):  # noqa: F811
    reads = []
    original = day.read_json

    def counted(session, root, *args):
        name = root.rsplit("/", 1)[1]
        return original(session, root, *args).withColumn("dt", F.col("dt")).observe(reads_of(name), F.count(F.lit(1)).alias("n"))

    def reads_of(name):
        from pyspark.sql import Observation

        reads.append((name, Observation(f"raw {name}")))
        return reads[-1][1]

    recounts = []
    monkeypatch.setattr(day, "read_json", counted)
    monkeypatch.setattr(day, "_settled", lambda seen, written, recount, f=day._settled: f(seen, written, lambda: recounts.append(1) or recount()))
    results = {(r.table, r.rule): r.value for r in day.run_day(spark, DAY, config).collect()}
    assert not recounts and results["txn_enriched", "retention"] == 1 and results["token_flow", "retention"] == 1
    assert {name: o.get["n"] for name, o in reads}["transactions"] == 1000


def test_counts_that_disagree_are_taken_anew():
    assert day._settled({"a": 2, "b": 9}, {"a": 2}, lambda: {"a": 0}) == {"a": 2, "b": 9}
    assert day._settled({"a": 3}, {"a": 2}, lambda: {"a": 2}) == {"a": 2}
    assert day._settled({}, {"a": 0}, lambda: {"a": 0}) == {"a": 0}


def test_given_counts_equal_counted_frames(spark):
    tokens = spark.createDataFrame([("t", "T", "Tt", 6), ("t", "T", "Tt", 6)], "token_address string, symbol string, token_name string, decimals int")
    transfers = spark.createDataFrame([("t",), ("t",), ("u",)], "token_address string")
    assert quality.flow_sources(transfers, tokens).first().asDict() == {"tracked_rows": 2, "all_rows": 3}


def test_block_times_do_not_shuffle_transfers(spark, capsys):
    blocks = spark.range(100).select(F.col("id").alias("number"), F.col("id").alias("timestamp"))
    shape = "token_address string, from_address string, to_address string, value string, transaction_hash string, log_index long, block_number long"
    transfers = spark.createDataFrame([("t", "a", "b", "5", "h", 0, 7)], shape)
    tokens = spark.createDataFrame([("t", "T", "Tt", 6)], "token_address string, symbol string, token_name string, decimals int")
    labels = dimensions.read_labels(spark, None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for limit, shuffled in ((1000, False), (10, True)):
            enrich.token_flow(transfers, tokens, counted_broadcast(blocks, "times", limit), labels).explain()
            assert ("hashpartitioning(block_number" in capsys.readouterr().out) == shuffled
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_history_is_not_read_while_the_window_has_a_price(spark, capsys):
    data = [("a", 100, "5000000000"), ("b", 900, "7000000000"), ("c", 950, None)]
    frame = spark.createDataFrame(data, "hash string, block_timestamp long, gas_price string").repartition(2)

    def price(as_of, capsys=capsys):
        found = serving.gas_price(frame, as_of)
        value = found.collect()[0]["average_gas_price_gwei"]
        found.explain()
        final = capsys.readouterr().out.split("== Initial Plan ==")[0]
        return value, "EmptyRelation" in final

    assert price(1000) == (7.0, True)
    assert price(700) == (5.0, False) and price(5000) == (7.0, False) and price(50)[0] == 0.0
