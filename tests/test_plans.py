from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from transferlens import schemas
from transferlens.functions import classify
from transferlens.plans import dimension_build, enrich, extract, quality, rollups, serving, whales

DAY = 1_777_593_600  # 2026-05-01 00:00:00


def eth(coins) -> str:
    return str(int(Decimal(str(coins)) * 10**18))


def frame(spark, schema, rows):
    names = schema.fieldNames()
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def transactions(spark, rows):
    return frame(spark, schemas.TRANSACTIONS, rows)


def receipts(spark, rows):
    return frame(spark, schemas.RECEIPTS, rows)


def enriched_rows(spark, rows):
    """(hash, second, sender, receiver, coins, success)"""
    data = [(h, DAY + s, a, b, Decimal(str(v)), ok, date(2026, 5, 1)) for h, s, a, b, v, ok in rows]
    return spark.createDataFrame(
        data, "hash string, block_timestamp long, from_address string, to_address string, value_eth decimal(38,18), is_success boolean, dt date"
    )


LABELS = [("0xb", "Binance 14", "CEX"), ("0xu", "Uniswap V3: Router", "DEX"), ("0xh", "Hop", "Bridge")]


def label_frame(spark, rows=LABELS):
    return spark.createDataFrame(rows, schemas.LABELS)


def test_enriched_keeps_every_row_and_produces_the_declared_columns(spark):
    tx = transactions(
        spark,
        [
            dict(hash="a", to_address=None, value=eth(1), input="0x", block_timestamp=DAY, transaction_type=2),
            dict(hash="b", to_address="", value="x", input="0xab", block_timestamp=DAY),
            dict(hash="c", to_address="0x1", value=eth("99.9999996"), input="0x", block_timestamp=DAY + 86_399),
            dict(hash="d", to_address="0x1", value="7" * 78, input=None, block_timestamp=DAY),
            dict(hash="e", to_address="0x1", value=eth(5), input="0xab", block_timestamp=None),
        ],
    )
    rec = receipts(
        spark,
        [dict(transaction_hash="a", status=1, gas_used=21_000, effective_gas_price=10**9), dict(transaction_hash="c", status=0, gas_used=9 * 10**18, effective_gas_price=9)],
    )
    out = enrich.enrich_transactions(tx, rec)
    assert out.columns == schemas.ENRICHED.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.ENRICHED]
    got = {r.hash: r for r in out.collect()}
    assert len(got) == 5
    assert (got["a"].is_contract_deploy, got["b"].is_contract_deploy, got["c"].is_contract_deploy) == (True, True, False)
    assert (got["a"].is_contract_call, got["b"].is_contract_call, got["c"].is_contract_call, got["d"].is_contract_call, got["e"].is_contract_call) == (False, False, False, None, True)
    assert (got["a"].is_success, got["c"].is_success, got["d"].is_success) == (True, False, None)
    assert got["a"].tx_fee_eth == Decimal("0.000021") and got["c"].tx_fee_eth == 81 and got["d"].tx_fee_eth is None
    assert got["c"].value_eth == Decimal("99.9999996") and got["b"].value_eth is None and got["d"].value_eth is None
    assert got["a"].tx_type == "eip1559" and got["a"].dt == date(2026, 5, 1) and got["c"].dt == date(2026, 5, 1)


def test_token_flow(spark):
    transfers = frame(
        spark,
        schemas.TOKEN_TRANSFERS,
        [
            dict(token_address="t6", from_address="0xb", to_address="0xz", value="2500000", transaction_hash="1", block_number=1),
            dict(token_address="t0", from_address="0xz", to_address="0xb", value="42", transaction_hash="2", block_number=9),
            dict(token_address="untracked", from_address="0xz", to_address="0xb", value="42", transaction_hash="3", block_number=1),
        ],
    )
    tokens = spark.createDataFrame([("t6", "USDT", "Tether", 6), ("t0", "NFT", "Zero", 0)], schemas.TOKENS)
    blocks = frame(spark, schemas.BLOCKS, [dict(number=1, timestamp=DAY + 3600)])
    flow = enrich.token_flow(transfers, tokens, blocks, label_frame(spark))
    assert flow.columns == schemas.TOKEN_FLOW.fieldNames()
    got = {r.transaction_hash: r for r in flow.collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].amount, got["1"].hour, got["1"].from_category, got["1"].to_label) == (2.5, 1, "CEX", "Unknown")
    assert (got["2"].amount, got["2"].hour, got["2"].dt) == (42.0, None, None)
    rec = receipts(spark, [dict(transaction_hash="1", status=0), dict(transaction_hash="2", status=1)])
    only = enrich.token_flow(transfers, tokens, blocks, label_frame(spark), rec).collect()
    assert [(r.transaction_hash, r.status) for r in only] == [("2", 1)]


def test_whales(spark):
    rows = [
        ("h2", 10, "s", "0xb", 100, True),
        ("h1", 10, "s", "0xu", 150, True),  # same second: the hash decides
        ("h3", 20, "s", "0xh", 1000, True),
        ("h4", 20, "0xb", "s", 10000, True),
        ("h5", 30, "s", "r", "99.999999999999999999", True),
        ("h6", 30, "s", "r", 500, False),
        ("h7", 30, "s", "r", 500, None),
        ("h8", 40_000, "s", "r", 200, True),
        ("h9", 50_000, "s", "r", 100, True),
    ]
    out = whales.whale_transactions(enriched_rows(spark, rows), label_frame(spark))
    assert out.columns == schemas.WHALES.fieldNames()
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.WHALES]
    got = {r.hash: r for r in out.collect()}
    assert set(got) == {"h1", "h2", "h3", "h4", "h8", "h9"}
    assert [(int(got[h].cumul_sent_eth), got[h].cumul_tx_count) for h in ("h1", "h2", "h3", "h8", "h9")] == [(150, 1), (250, 2), (1250, 3), (1450, 4), (1550, 5)]
    assert [got[h].flag_high_freq for h in ("h8", "h9")] == [False, True]
    assert (got["h8"].cumul_recv_eth, got["h9"].cumul_recv_eth) == (200, 300)
    assert [got[h].flow_type for h in ("h1", "h2", "h3", "h4", "h8")] == ["DEX_TRADE", "CEX_DEPOSIT", "BRIDGE_MOVE", "CEX_WITHDRAWAL", "PRIVATE_MOVE"]
    assert [got[h].whale_tier for h in ("h1", "h3", "h4")] == ["Shark", "Whale", "Humpback"]
    assert got["h2"].to_entity == "Binance" and got["h8"].is_private_transaction is True and got["h8"].hour == 11


def whale_frame(spark, rows, labels=LABELS):
    return whales.whale_transactions(enriched_rows(spark, rows), label_frame(spark, labels), threshold=0)


def test_top_whales(spark):
    rows = [("1", 1, "a", "b", 100, True), ("2", 2, "b", "a", 40, True), ("3", 3, "c", "c", 700, True), ("4", 4, "0xb", "d", 60, True), ("5", 5, "e", None, 60, True)]
    for cut in (False, True):
        got = {r.address: r for r in rollups.top_whales_daily(whale_frame(spark, rows), cut=cut).collect()}
        assert sum(r.total_sent_eth for r in got.values()) == sum(r.total_recv_eth for r in got.values()) == 960
        assert (got["a"].net_flow_eth, got["b"].net_flow_eth, got["c"].net_flow_eth) == (-60, 60, 0)
        assert [got[x].position_label for x in "abc"] == ["Dumper", "Accumulator", "Neutral"]
        # b, d and the missing receiver share the best net flow; ranks leave gaps
        assert [got[x].rank_accumulator for x in ("b", "d", None, "c", "a")] == [1, 1, 1, 4, 5]
        assert [got[x].rank_dumper for x in ("a", "e", "0xb", "c", "b")] == [1, 1, 1, 4, 5]
        assert (got["c"].rank_activity, got["c"].whale_tier, got["c"].total_tx_count) == (1, "Humpback", 2)
        assert got["0xb"].entity_name == "Binance" and got["a"].entity_name == "Unknown" and got[None].entity_name is None


def test_market_flow(spark):
    h = 3600
    rows = [
        ("1", 0, "x", "0xb", 150, True), ("2", 1, "0xb", "x", 100, True), ("3", 2, "x", "0xu", 7, True),
        ("4", h, "x", "0xb", 5, True),
        ("5", 2 * h, "0xb", "x", 5, True),
        ("6", 3 * h, "x", "y", 5, True),
        ("7", 4 * h, "x", "0xb", 5, True), ("8", 4 * h, "0xb", "x", 5, True),
    ]
    got = {(r.hour, r.flow_type): r for r in rollups.market_flow_hourly(whale_frame(spark, rows)).collect()}
    assert len(got) == 8
    assert {r.pressure_label for k, r in got.items() if k[0] == 0} == {"MILD_SELL_PRESSURE"}
    assert [float(got[0, "DEX_TRADE"][c]) for c in ("total_eth", "cex_deposit_eth", "cex_withdrawal_eth", "deposit_withdrawal_ratio")] == [7, 150, 100, 1.5]
    assert got[1, "CEX_DEPOSIT"].pressure_label == "STRONG_SELL_PRESSURE" and got[1, "CEX_DEPOSIT"].deposit_withdrawal_ratio is None
    assert got[2, "CEX_WITHDRAWAL"].pressure_label == "STRONG_BUY_PRESSURE"
    assert got[3, "PRIVATE_MOVE"].pressure_label == "NEUTRAL" and got[4, "CEX_DEPOSIT"].pressure_label == "NEUTRAL"


def flow_frame(spark, rows):
    """(tx, hour, token, sender, receiver, amount); 0xb is an exchange"""
    data = [(x, DAY + h * 3600, h, date(2026, 5, 1), t, t.upper(), t, a, "Binance 14" if a == "0xb" else "Unknown", "CEX" if a == "0xb" else "Unknown", b, "Binance 14" if b == "0xb" else "Unknown", "CEX" if b == "0xb" else "Unknown", float(v)) for x, h, t, a, b, v in rows]
    return spark.createDataFrame(data, schemas.TOKEN_FLOW)


def test_popularity_daily(spark):
    rows = [("1", 0, "t", "a", "0xb", 5), ("2", 0, "t", "0xb", "a", 2), ("3", 0, "t", "a", "c", 1), ("4", 0, "u", "a", "b", 1), ("5", 0, "v", "0xb", "0xb", 9), ("6", 0, "v", "0xb", "0xb", 1)]
    got = {r.token_address: r for r in rollups.token_popularity_daily(flow_frame(spark, rows), exact_pairs=True).collect()}
    assert (got["t"].popularity_score, got["t"].popularity_tier, got["t"].cex_net_flow, got["t"].cex_flow_label) == (1.0, "Top1", 3.0, "CEX_INFLOW")
    assert got["u"].popularity_score == 0.0 and got["u"].rank_popularity == 3 and got["u"].cex_flow_label == "NEUTRAL"
    assert got["v"].cex_net_flow == 10.0 and got["v"].unique_addresses == 1  # within the exchange counts as in
    alone = rollups.token_popularity_daily(flow_frame(spark, rows[3:4])).collect()
    assert [(r.popularity_score, r.rank_popularity) for r in alone] == [(0.0, 1)]


def test_popularity_hourly_skips_missing_hours(spark):
    rows = [(f"a{i}", 0, "t", "a", "b", 1) for i in range(2)] + [(f"b{i}", 2, "t", "a", "b", 1) for i in range(4)] + [(f"c{i}", 3, "t", "a", "b", 1) for i in range(2)] + [("d", 3, "u", "a", "b", 1)]
    got = {(r.token_address, r.hour): r for r in rollups.token_popularity_hourly(flow_frame(spark, rows)).collect()}
    assert got["t", 0].tx_count_change_pct is None and got["t", 2].tx_count_change_pct == 100.0 and got["t", 3].tx_count_change_pct == -50.0
    assert [got["t", h].trending_signal for h in (0, 2, 3)] == [None, "Surging", "Cooling"]
    assert (got["t", 3].rank_by_tx_count, got["u", 3].rank_by_tx_count) == (1, 2)
    dense = {(r.token_address, r.hour): r for r in rollups.token_popularity_hourly(flow_frame(spark, rows), dense=True).collect()}
    assert dense["t", 2].tx_count_change_pct is None and dense["t", 3].tx_count_change_pct == -50.0
    failed = flow_frame(spark, rows).withColumn("status", F.when(F.col("token_address") == "u", 0).otherwise(1))
    assert {r.token_address for r in rollups.token_popularity_hourly(failed).collect()} == {"t"}


def test_gas(spark):
    rows = [dict(hash="a", block_timestamp=1000, gas_price=5 * 10**9), dict(hash="b", block_timestamp=1300, gas_price=10 * 10**9)]
    tx = transactions(spark, rows)
    assert serving.gas_price(tx, 1300).first()[0] == 7.5
    assert serving.gas_price(tx, 1301).first()[0] == 10.0
    assert serving.gas_price(tx, 99_999).first()[0] == 10.0
    assert serving.gas_price(tx, 1100).first()[0] == 5.0  # later rows do not count
    assert serving.gas_price(tx, 999).first()[0] == 0.0
    assert serving.gas_price(tx.where("hash = 'none'"), 1000).first()[0] == 0.0


def test_wallet_history(spark):
    rows = [dict(hash=f"h{i}", block_timestamp=i, from_address="0xAb" if i % 2 else "0xc", to_address="0xc" if i % 2 else "0xab", value=eth(1)) for i in range(6)]
    rows.append(dict(hash="self", block_timestamp=9, from_address="0xab", to_address="0xab", value=eth(2), gas_price=10**9))
    rows.append(dict(hash="deploy", block_timestamp=10, from_address="0xab", to_address=None, value="0"))
    tx = serving.lowered(transactions(spark, rows), "from_address", "to_address")
    got = serving.wallet_transactions(tx, label_frame(spark), "0xAB", 4).orderBy(F.desc("block_timestamp")).collect()
    assert [r.hash for r in got] == ["deploy", "self", "self", "h5"]
    assert [r.type for r in got] == ["OUT"] * 4 and got[1].gas_price_gwei == 1.0 and got[0].to_address is None
    once = serving.wallet_transactions(tx, label_frame(spark), "0xab", 100, dedupe_self=True).collect()
    assert len(once) == 8 and {r.type for r in once if r.hash in ("h0", "h2")} == {"IN"}


def test_wallet_tokens_fill_in_missing_metadata(spark):
    transfers = frame(spark, schemas.TOKEN_TRANSFERS, [
        dict(token_address="t0", from_address="a", to_address="b", value="7", transaction_hash="1", log_index=0),
        dict(token_address="tn", from_address="b", to_address="a", value=eth(3), transaction_hash="2", log_index=0),
        dict(token_address="none", from_address="a", to_address="b", value=eth(4), transaction_hash="3", log_index=0),
    ]).withColumn("block_timestamp", F.lit(DAY))
    tokens = spark.createDataFrame([("t0", None, "Zero", 0), ("tn", "N", "Null", None)], schemas.TOKENS)
    got = {r.hash: (r.symbol, r.value, r.type) for r in serving.wallet_token_transfers(transfers, tokens, label_frame(spark), "A").collect()}
    assert got == {"1": ("UNKNOWN", 7.0, "OUT"), "2": ("N", 3.0, "IN"), "3": ("UNKNOWN", 4.0, "OUT")}


def test_token_list_prefix_is_literal(spark):
    tokens = spark.createDataFrame([("1", "a_b", "", 1), ("2", "axb", "", 1), ("3", "A%c", "", 1), ("4", "1inch", "", 1), ("5", None, "", 1), ("6", "A_z", "", 1)], schemas.TOKENS)

    def listed(**kw):
        return [r.token_address for r in serving.list_tokens(tokens, **kw).collect()]

    assert listed(prefix="a_") == ["6", "1"] and listed(prefix="a%") == ["3"] and listed(prefix="A") == ["3", "6", "1", "2"]
    assert listed(prefix="#") == ["4"] and listed(limit=2, offset=4) == ["2", "5"]


def test_label_build(spark):
    good, other = "0x" + "AB" * 20, "0x" + "cd" * 20
    raw = spark.createDataFrame(
        [(f" {good} ", "Binance 14", ["old-contract", "binance", "dex"]), (other, None, ["aave", "exchange"]), (other, "Zed", ["heist"]), ("0x12", "short", ["dex"]), ("0x" + "ef" * 20, "noise", ["donate"]), ("0x" + "01" * 20, "none", [])],
        "address string, name string, labels array<string>",
    )
    got = {r.address: (r.name, r.category) for r in dimension_build.build_labels(raw).collect()}
    assert got == {good.lower(): ("Binance 14", "CEX"), other: ("", "DeFi")}
    assert [tuple(r) for r in dimension_build.category_counts(dimension_build.build_labels(raw)).collect()] == [("CEX", 1), ("DeFi", 1)]


def test_token_build(spark):
    platforms = spark.createDataFrame([("weth", {"ethereum": "0xW"}), ("big", {"ethereum": "0xB"}), ("small", {"ethereum": " 0xS "}), ("copy", {"ethereum": "0xb"}), ("sol", {"solana": "0x1"}), ("odd", {"ethereum": "zz"})], "id string, platforms map<string,string>")
    markets = spark.createDataFrame([("weth", "weth", "WETH", None, None, 18), ("big", "big", "Big", 900, 1, 6), ("small", "sml", "Small", 5, 3, None), ("copy", "cpy", "Copy", 800, 2, 6), ("sol", "sol", "Sol", 9999, 0, 6)], "coin_id string, symbol string, name string, market_cap long, market_rank int, decimals int")
    built = dimension_build.build_tokens(markets, dimension_build.coin_addresses(platforms), cap=2).collect()
    assert [(r["rank"], r.symbol, r.address, r.market_cap_usd) for r in built] == [(1, "BIG", "0xb", 900), (2, "WETH", "0xw", 0)]
    more = dimension_build.build_tokens(markets, dimension_build.coin_addresses(platforms)).collect()
    assert [(r.symbol, r.decimals) for r in more] == [("BIG", 6), ("SML", 18), ("WETH", 18)]


def test_extract(spark):
    blocks = frame(spark, schemas.BLOCKS, [dict(number=n, timestamp=DAY + n * 43_200, transaction_count=n) for n in range(4)])
    assert sorted(map(tuple, extract.block_range(blocks).collect())) == [(date(2026, 5, 1), 0, 1, 2), (date(2026, 5, 2), 2, 3, 2)]
    assert extract.block_day(blocks, 3).first().dt == date(2026, 5, 2)
    tx = transactions(spark, [dict(hash="a", value=eth(100)), dict(hash="b", value=str(int(eth(100)) - 1)), dict(hash="c", value=None)])
    assert [r.hash for r in extract.whale_hashes(tx).collect()] == ["a"]
    sizes = spark.createDataFrame([("f", 2**30)], "path string, bytes long")
    summary = extract.run_summary(blocks, tx, receipts(spark, []), sizes).first()
    assert (summary.block_count, summary.total_tx_in_blocks, summary.whale_count, summary.receipt_count) == (4, 6, 1, 0)
    assert (summary.total_mb, summary.compute_units, summary.monthly_storage_usd) == (1024.0, 15, 0.02)


def test_logs(spark):
    pad = "0x" + "0" * 24
    logs = frame(spark, schemas.LOGS, [dict(address="0xT", topics=[enrich.TRANSFER_TOPIC, pad + "AA" * 20, pad + "bb" * 20], data="0x01", log_index=1), dict(address="0xT", topics=["0x1"], log_index=2)])
    got = enrich.decode_transfer_logs(logs).collect()
    assert [(r.token_address, r.from_address, r.to_address) for r in got] == [("0xt", "0x" + "aa" * 20, "0x" + "bb" * 20)]


def passed(results):
    return {r.rule: (r.passed, r.severity) for r in results.collect()}


def test_quality_gates(spark):
    tx = transactions(spark, [dict(hash=str(i), value=eth(1), block_timestamp=DAY, to_address="x", from_address="y", input="0x") for i in range(4)])
    enriched = enrich.enrich_transactions(tx, receipts(spark, [dict(transaction_hash="0", status=0, gas_used=21_000, effective_gas_price=1)]))
    assert passed(quality.check_enriched(enriched, tx)) == {"retention": (True, "critical"), "success_rate": (False, "critical"), "tx_count": (False, "critical"), "avg_fee_eth": (True, "critical")}
    with pytest.raises(quality.QualityError, match="success_rate.*tx_count"):
        quality.enforce(quality.check_enriched(enriched, tx))

    flow = flow_frame(spark, [(str(i), 0, "t", "a" if i % 2 else "b", "b" if i % 2 else "a", 1) for i in range(10)])
    tokens = spark.createDataFrame([("t", "T", "t", 0)], schemas.TOKENS)
    raw = flow.select("token_address").unionByName(spark.createDataFrame([("untracked",)] * 5, "token_address string"))
    results = quality.check_flow(flow, raw, tokens)
    assert passed(results) == {"retention": (True, "critical"), "row_count": (True, "critical"), "active_tokens": (True, "critical"), "wash_ratio": (False, "warning"), "unfiltered_retention": (True, "info")}
    assert {r.rule: r.value for r in results.collect()}["unfiltered_retention"] == pytest.approx(10 / 15, abs=1e-6)
    quality.enforce(results)  # warnings do not raise

    none = whale_frame(spark, [("1", 1, "a", None, 5, True)]).where("hash = 'x'")
    assert passed(quality.check_whales(none))["row_count"] == (False, "critical")
    lost = whale_frame(spark, [("1", 1, "a", None, 5, True)])
    assert passed(quality.check_whales(lost))["null_rows"] == (False, "critical")


def test_bronze_and_block_checks(spark):
    tx = transactions(spark, [dict(hash="a", value=eth(100), block_number=1), dict(hash="b", value=eth(1), block_number=2)])
    one = receipts(spark, [dict(transaction_hash="a", block_number=1)])
    assert passed(quality.check_bronze(tx, one))["receipt_gap"][0] is True
    assert passed(quality.check_bronze(tx, receipts(spark, [])))["receipt_gap"][0] is False
    blocks = frame(spark, schemas.BLOCKS, [dict(number=1, transaction_count=1), dict(number=2, transaction_count=1), dict(number=3, transaction_count=4)])
    got = sorted(map(tuple, quality.block_mismatches(blocks, tx, one).collect()))
    assert got == [(2, 1, 1, 0), (3, 4, 0, 0)]


def test_tier_names_are_consistent():
    assert [n for _, n in classify.TX_TIERS] == [n for _, n in classify.DAY_TIERS]
