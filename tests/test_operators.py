"""Skew-proof operators against brute force, with one key holding a third of the rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from transferlens.operators import labels, ranking, reciprocal, search, stats, upsert
from transferlens.operators.running import running_totals


def skewed_key(rng, hot="hot"):
    return hot if rng.random() < 0.34 else f"k{rng.randrange(9)}"


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_totals_equal_a_plain_loop(spark, width):
    rng = random.Random(width)
    rows = [(i, None if i % 50 == 0 else skewed_key(rng), rng.randrange(200), rng.choice([None, 1, 2, 5])) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, k string, at int, v int")
    got = running_totals(df, ["k"], ["at", "id"], F.floor(F.col("at") / width), {"run": F.col("v")}, {"total": F.col("v")})
    assert got.columns == ["id", "k", "at", "v", "run", "total"]
    run, total = defaultdict(int), defaultdict(int)
    for _, k, _, v in rows:
        total[k] += v or 0
    expected = {}
    for i, k, at, v in sorted(rows, key=lambda r: (r[2], r[0])):
        run[k] += v or 0
        expected[i] = (run[k], total[k])
    assert {r.id: (r.run, r.total) for r in got.collect()} == expected


@pytest.mark.parametrize("cut", [False, True])
def test_ranks_equal_plain_rank(spark, cut):
    rng = random.Random(3)
    rows = [(i, f"d{i % 3}" if i % 40 else None, None if i % 37 == 0 else 7.5 if rng.random() < 0.34 else round(rng.gauss(0, 50), 1)) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, d string, v double")
    got = {r.id: (r.up, r.down) for r in ranking.with_rank(df, ["d"], "v", "up", "down", cut).collect()}
    for i, d, v in rows:
        peers = [x for _, e, x in rows if e == d and x is not None]
        want = (None, None) if v is None else (1 + sum(x < v for x in peers), 1 + sum(x > v for x in peers))
        assert got[i] == want


def brute_pairs(rows, low=0.8, high=1.2):
    return [
        (a, b)
        for a in rows
        for b in rows
        if a[1] == b[1] and a[2] == b[3] and a[3] == b[2] and a[0] != b[0] and b[4] > 0 and b[4] * low <= a[4] <= b[4] * high
    ]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_reciprocal_equals_self_join(spark, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(220):
        a, b = ("A", "B") if rng.random() < 0.4 else (rng.choice("ABCD"), rng.choice("ABCD"))
        if rng.random() < 0.5:
            a, b = b, a
        rows.append((f"t{i // 3}", rng.choice(["X", "X", "Y"]), a, b, rng.choice([0.0, 1.0, 0.8, 1.2, 1.21, 10.0, 12.0, 8.0, 9.99, round(rng.uniform(0.5, 20), 2)])))
    df = spark.createDataFrame(rows, "transaction_hash string, token_address string, from_address string, to_address string, amount double")
    pairs, matched = reciprocal.reciprocal_transfers(df)
    want = brute_pairs(rows)
    by_token = defaultdict(int)
    for a, _ in want:
        by_token[a[1]] += 1
    assert {r.token: r.pairs for r in pairs.collect()} == dict(by_token)
    assert {(r.tx, r.token, r.sender, r.receiver, r.amount) for r in matched.collect()} == {a for a, _ in want}


def test_reciprocal_band_edges(spark):
    rows = [("1", "T", "a", "b", 0.8), ("2", "T", "b", "a", 1.0), ("3", "T", "c", "d", 1.21), ("4", "T", "d", "c", 1.0), ("5", "T", "e", "e", 3.0), ("6", "T", "e", "e", 3.0), ("7", "T", "f", "f", 3.0)]
    df = spark.createDataFrame(rows, "transaction_hash string, token_address string, from_address string, to_address string, amount double")
    _, matched = reciprocal.reciprocal_transfers(df)
    # 0.8 of 1.0 counts for the first; 1.0 against 0.8 is 1.25 and does not; 1.0 against 1.21 is 0.826
    assert sorted(r.tx for r in matched.collect()) == ["1", "4", "5", "6"]


def test_dominant_prefers_known_then_frequent_then_name(spark):
    rows = [("x", "Unknown"), ("x", "Unknown"), ("x", "Zeta"), ("y", "Unknown"), ("z", "B"), ("z", "A"), ("w", "A"), ("w", "B"), ("w", "B")]
    df = spark.createDataFrame(rows, "k string, e string")
    got = labels.dominant(df, ["k"], ["e"], F.col("e") == "Unknown")
    assert {r.k: r.e for r in got.collect()} == {"x": "Zeta", "y": "Unknown", "z": "A", "w": "B"}


def test_label_join_and_merge(spark):
    file = spark.createDataFrame([("0x1", "Binance 14", "CEX"), (labels.BURN_LABELS[0][0], "From file", "DeFi")], "address string, label_name string, label_category string")
    merged = {r.address: r.label_name for r in labels.merge_labels(file).collect()}
    assert merged == {"0x1": "Binance 14", labels.BURN_LABELS[0][0]: "From file", labels.BURN_LABELS[1][0]: "Null Address"}
    rows = spark.createDataFrame([("0x1", "0x2"), (None, "0x1")], "from_address string, to_address string")
    got = labels.with_labels(rows, file).select("from_category", "to_category").collect()
    assert sorted(map(tuple, got)) == [("CEX", "Unknown"), ("Unknown", "CEX")]


def test_upsert_and_insert_ignore(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 5, 0), ("b", 6, 1), ("c", 7, 2)], "k string, v int, n long")
    assert {r.k: r.v for r in upsert.upsert(old, new, ["k"], "n").collect()} == {"a": 1, "b": 6, "c": 7}
    assert {r.k: r.v for r in upsert.upsert(None, new, ["k"], "n").collect()} == {"b": 6, "c": 7}
    fresh = upsert.insert_ignore(old, new.select("k", "v").dropDuplicates(["k"]), ["k"])
    assert [r.k for r in fresh.collect()] == ["c"]


def test_search(spark):
    rows = [("1", "USDT", "Tether USD", 6), ("2", "USDC", "USD Coin", 6), ("3", "WETH", "Wrapped Ether", 18), ("4", None, "Tethered", 18)]
    df = spark.createDataFrame(rows, "token_address string, symbol string, token_name string, decimals int")

    def found(q, n=10):
        return [(r.token_address, r.score) for r in search.fuzzy_search(df, q, n).collect()]

    assert found("usdt") == [("1", 2.0), ("2", 1.5)]
    assert found("tethr")[0][0] == "1"
    assert found("us") == []  # short terms must match exactly
    assert found("wrapped eter") == [("3", pytest.approx(1.75))]
    assert len(found("usdt", 1)) == 1


def test_stats(spark):
    df = spark.createDataFrame([("a", "b"), ("b", None), (None, "a")], "x string, y string")
    assert stats.distinct_of(df, ["x", "y"], "n").first().n == 3
    assert stats.distinct_of(df, ["x", "y"], "n", count_null=False).first().n == 2
    numbers = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert numbers.agg(stats.variation("v").alias("c")).first().c == pytest.approx(2**0.5 / 2)
    assert numbers.where("v > 5").agg(stats.variation("v").alias("c")).first().c == 0.0
