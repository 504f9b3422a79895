"""What the transfers of the given tables shuffle: joins, and the columns below them."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from transferlens.operators import reciprocal
from transferlens.plans import enrich, quality
from transferlens.session import stored
from transferlens.sources import sinks
from transferlens.workload import batch, frames, storage
from transferlens.workload import quality as gates

FOLDER = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_backfilled_transfers_join_the_orders_once(spark, monkeypatch):
    class Stop(Exception):
        pass

    seen = {}

    def caught(tables, *rest):
        seen.update(tables)
        raise Stop

    monkeypatch.setattr(sinks, "backfill_all", caught)
    with pytest.raises(Stop):
        storage.backfill_entities(spark, FOLDER)
    for name in ("logs", "token_transfers"):
        plan = _plan(sinks.project_days(seen[name], "block_timestamp", "1995-01-01", "1995-03-31"))
        assert plan.count("Join Inner") == 2  # lines with orders and with parts


def test_few_two_way_pairs_are_stored_and_give_the_same(spark):
    rows = [("t", "a", "b", "x1", 10.0), ("t", "b", "a", "x2", 11.0), ("t", "a", "c", "x3", 10.0), ("u", "b", "a", "x4", 10.0), ("t", None, "a", "x5", 10.0)]
    flow = spark.createDataFrame(rows, "token_address string, from_address string, to_address string, transaction_hash string, amount double")
    kept = {}

    def keep(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    pairs, matched = reciprocal.reciprocal_transfers(flow, keep=keep)
    plain = reciprocal.reciprocal_transfers(flow)
    assert sorted(pairs.collect()) == sorted(plain[0].collect()) and sorted(matched.collect()) == sorted(plain[1].collect())
    assert [tuple(r) for r in kept["two-way-pairs"].collect()] == [("t", "a", "b")]


def test_calendar_columns_are_made_behind_the_label_joins(spark):
    lines = _plan(batch.line_flow(spark, FOLDER)).splitlines()
    made = next(k for k, line in enumerate(lines) if " AS hour#" in line)
    assert made < next(k for k, line in enumerate(lines) if "Join LeftOuter" in line)


def test_the_flow_gate_stores_what_it_reads_and_counts_sources_on_the_way(spark, monkeypatch):
    kept = {}

    def keep(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    expected = sorted(gates.quality_gate_flow(spark, FOLDER).collect())
    monkeypatch.setattr(gates, "stored", keep)
    monkeypatch.setattr(quality, "flow_sources", None)  # no second pass over the transfers
    assert sorted(gates.quality_gate_flow(spark, FOLDER).collect()) == expected
    flow = kept["token-flow"]
    assert flow.columns == list(quality.FLOW_READ)
    whole = batch.line_flow(spark, FOLDER).select(*quality.FLOW_READ)
    assert flow.count() == whole.count() and flow.exceptAll(whole).isEmpty()


def test_source_counts_are_taken_anew_when_the_observed_ones_may_be_wrong(spark):
    rows = [("a", 7), ("a", 7), ("b", 7), (None, 7)]
    moved = spark.createDataFrame(rows, "token_address string, block_number bigint").withColumns(
        {"from_address": F.lit("x"), "to_address": F.lit("y"), "transaction_hash": F.lit("h"), "value": F.lit("1")}
    )
    blocks = spark.createDataFrame([(7, 0)], "number bigint, timestamp bigint")
    labels = spark.createDataFrame([], "address string, label_name string, label_category string")
    once = spark.createDataFrame([("a", "A", "a", 0)], "token_address string, symbol string, token_name string, decimals int")
    for tokens in (once, once.unionByName(once)):
        seen = Observation()
        flow = enrich.token_flow(moved, tokens, blocks, labels, observed=seen)
        plain = enrich.token_flow(moved, tokens, blocks, labels)
        written = len(flow.collect())
        assert sorted(flow.collect()) == sorted(plain.collect())
        right = {"tracked_rows": 2, "all_rows": 4}
        assert quality.source_counts(seen, written, moved, tokens) == right  # a token listed twice does not count twice
        assert quality.source_counts(seen, written - 1, moved, tokens) == right  # nor do counts that the table contradicts


def test_a_hot_token_is_split_where_transfers_are_counted(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        moved = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("token_address"), F.xxhash64("id").alias("value")
        )
        tokens = spark.range(997).select(F.col("id").cast("string").alias("token_address")).union(spark.createDataFrame([("hot",)], "token_address string"))
        seen = Observation()
        rows = enrich._counted(moved, tokens, seen)
        assert len(rows.collect()) == 60_000 and seen.get == {"tracked_rows": 60_000, "all_rows": 60_000}
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_hash_texts_are_made_behind_the_label_joins(spark):
    lines = _plan(batch.line_flow(spark, FOLDER)).splitlines()
    made = next(k for k, line in enumerate(lines) if "concat_ws(" in line)
    assert made < next(k for k, line in enumerate(lines) if "Join LeftOuter" in line)
    tables = [frames.table(spark, FOLDER, n) for n in ("lineitem", "orders", "part")]
    late = frames.line_transfers(*tables, hashed=False).select(frames.line_hash().alias("h"))
    early = frames.line_transfers(*tables).select("transaction_hash")
    assert late.exceptAll(early).isEmpty() and early.exceptAll(late).isEmpty()
