import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from transferlens import schemas
from transferlens.operators.upsert import upsert
from transferlens.sources import dimensions, files, sinks


def write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))
    return path


def test_json_by_day_keeps_the_day_and_tolerates_bad_fields(spark, tmp_path):
    root = str(tmp_path / "transactions")
    write_lines(f"{root}/dt=2026-05-01/a.json", [{"hash": "a", "block_number": "12", "gas": 21000, "value": 10**20}, {"hash": "b", "block_number": "oops"}])
    write_lines(f"{root}/dt=2026-05-02/a.json", [{"hash": "c", "block_timestamp": "2026-05-02 00:00:10 UTC"}])
    got = files.read_json(spark, root, schemas.TRANSACTIONS, "dt=2026-05-01").orderBy("hash").collect()
    assert [(r.hash, r.block_number, r.gas, r.value, r.dt) for r in got] == [("a", 12, 21000, str(10**20), date(2026, 5, 1)), ("b", None, None, None, date(2026, 5, 1))]
    other = files.read_json(spark, root, schemas.TRANSACTIONS, "2026-05-02").first()
    assert (other.hash, other.block_timestamp) == ("c", 1_777_680_010)


def test_failfast_raises(spark, tmp_path):
    write_lines(str(tmp_path / "x" / "a.json"), ['{"hash": "a"', "not json"])
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        files.read_json(spark, str(tmp_path / "x"), schemas.TRANSACTIONS, mode="FAILFAST").collect()


def test_split_of_good_and_bad_lines(spark, tmp_path):
    write_lines(str(tmp_path / "x" / "a.json"), [{"hash": "a", "gas": 1}, "not json", {"hash": "b"}])
    good, bad = files.read_json_split(spark, str(tmp_path / "x"), schemas.TRANSACTIONS)
    assert sorted(r.hash for r in good.collect()) == ["a", "b"] and [r.raw for r in bad.collect()] == ["not json"]


def test_split_accepts_quoted_integers_and_refuses_misfits(spark, tmp_path):
    write_lines(str(tmp_path / "x" / "a.json"), [{"hash": "a", "gas": "12"}, {"hash": "b", "gas": "oops"}, {"hash": "c", "gas": None}])
    good, bad = files.read_json_split(spark, str(tmp_path / "x"), schemas.TRANSACTIONS)
    assert sorted((r.hash, r.gas) for r in good.collect()) == [("a", 12), ("c", None)]
    assert [json.loads(r.raw)["hash"] for r in bad.collect()] == ["b"]


def test_only_folders_of_the_days_asked_for_are_listed(spark, tmp_path):
    root = str(tmp_path / "t")
    write_lines(f"{root}/dt=2026-05-01/a.json", [{"hash": "a"}])
    write_lines(f"{root}/dt=2026-05-03/a.json", [{"hash": "c"}])
    assert [os.path.basename(f) for f in files.day_folders(spark, root, "2026-04-30", "dt=2026-05-02")] == ["dt=2026-05-01"]
    missing = files.read_json(spark, root, schemas.TRANSACTIONS, "2026-05-02")
    assert missing.count() == 0 and missing.columns[-1] == "dt"


def test_empty_files_are_found(spark, tmp_path):
    root = str(tmp_path / "receipts")
    write_lines(f"{root}/a.json", [{"transaction_hash": "a"}])
    write_lines(f"{root}/b.json", [])
    assert [os.path.basename(r.path) for r in files.empty_files(spark, root).collect()] == ["b.json"]
    assert [r.bytes for r in files.file_sizes(spark, root).collect()] == [os.path.getsize(f"{root}/a.json")]


def test_empty_files_of_one_day(spark, tmp_path):
    root = str(tmp_path / "receipts")
    for day in ("2026-05-01", "2026-05-02"):
        write_lines(f"{root}/dt={day}/a.json", [{"transaction_hash": "a"}])
        write_lines(f"{root}/dt={day}/b.json", [])
    found = [r.path for r in files.empty_files(spark, root, "2026-05-02").collect()]
    assert len(found) == 1 and found[0].endswith("dt=2026-05-02/b.json")


def test_later_csv_file_wins_whatever_its_size(spark, tmp_path):
    folder = str(tmp_path / "t")
    many = [f"0x{i},S{i},Name,6" for i in range(2000)]
    write_lines(f"{folder}/1.csv", ["address,symbol,name,decimals", "0xA,OLD,First,6", *many])
    write_lines(f"{folder}/2.csv", ["address,symbol,name,decimals", "0xa,NEW,Second,8"])
    got = upsert(None, dimensions.read_token_csv(spark, folder), ["address"], "load_order").where("address = '0xa'").collect()
    assert [(r.symbol, r.decimals) for r in got] == [("NEW", 8)]


def test_write_days_replaces_only_touched_days(spark, tmp_path):
    root = str(tmp_path / "silver")
    df = spark.createDataFrame([(1, "2026-05-01"), (2, "2026-05-02")], "v int, dt string").withColumn("dt", F.to_date("dt"))
    sinks.write_days(df, root)
    sinks.write_days(df.where("v = 2").withColumn("v", F.lit(7)), root)
    sinks.write_days(df.where("v = 2").withColumn("v", F.lit(7)), root)
    back = files.read_days(spark, root, df.schema)
    assert sorted(r.v for r in back.collect()) == [1, 7]
    assert [r.v for r in files.read_days(spark, root, df.schema, "dt=2026-05-01").collect()] == [1]
    sinks.append(df, root)
    assert files.read_days(spark, root, df.schema).count() == 4


def test_clustering_and_retention(spark, tmp_path):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 50)).alias("address"),
        F.col("id").alias("at"),
        F.when(F.col("id") < 30_000, F.lit("2026-05-01")).otherwise(F.lit("2025-01-01")).cast("date").alias("dt"),
    )
    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    sinks.write_days(rows.repartition(2).orderBy(F.rand(1)), plain)
    sinks.write_clustered(rows, clustered, "address", "at", files=2)
    back = files.read_days(spark, clustered, rows.schema)
    assert back.count() == 60_000
    report = sinks.saved_bytes(spark, plain, clustered).first()
    assert report.bytes_before > report.bytes_after > 0 and report.saved_pct > 0
    assert sinks.drop_expired(spark, clustered, date(2026, 5, 10)) == ["2025-01-01"]
    assert files.read_days(spark, clustered, rows.schema).count() == 30_000
    assert sinks.cutoff(date(2024, 8, 31)) == date(2024, 2, 29) and sinks.cutoff(date(2026, 1, 15)) == date(2025, 7, 15)


def test_backfill_projects_days(spark, tmp_path):
    tx = spark.createDataFrame([("a", "2026-05-01 10:00:00", 1), ("b", "2026-05-02 23:59:59", 0), ("c", "2026-05-03 00:00:00", 1)], "hash string, block_timestamp string, receipt_status int")
    root = str(tmp_path / "receipts")
    sinks.backfill(tx, root, "block_timestamp", "2026-05-01", "2026-05-02", {"hash": "transaction_hash", "receipt_status": "status"})
    got = files.read_json(spark, root, schemas.RECEIPTS, "2026-05-02").collect()
    assert [(r.transaction_hash, r.status) for r in got] == [("b", 0)]
    assert set(sinks.RECEIPT_COLUMNS.values()) == set(schemas.RECEIPTS.fieldNames())


def test_dimensions(spark, tmp_path):
    assert dimensions.read_tokens(spark, str(tmp_path / "none")).columns == schemas.TOKENS.fieldNames()
    assert dimensions.read_labels(spark, str(tmp_path / "none")).count() == 2
    assert dimensions.read_labels(spark, None).columns == schemas.LABELS.fieldNames()
    path = write_lines(str(tmp_path / "t" / "tokens.csv"), ["address,symbol,name,decimals", "0xA,AA,First,6", "0xB,BB,Second,x", "0xa,A2,Third,0"])

    got = upsert(None, dimensions.read_token_csv(spark, path), ["address"], "load_order").collect()
    assert {r.address: (r.symbol, r.decimals) for r in got} == {"0xa": ("A2", 0), "0xb": ("BB", 18)}
    labels = write_lines(str(tmp_path / "l" / "labels.csv"), ["address,name,category", "0xA,Binance,CEX"])
    assert dimensions.read_label_csv(spark, labels).first().address == "0xa"
