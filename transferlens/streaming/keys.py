"""The keys a stream store holds, dealt by their hash, so that "seen before" does not depend on the day of a row.

Beside a table lies its index: ``delta/bucket=<b>/batch=<n>`` has the keys that micro-batch n added, ``base=<n>/bucket=<b>`` those of all
micro-batches up to n. A batch reads the buckets its own keys fall into and nothing else. Now and then deltas are folded into a
new base; Spark's success mark makes it valid, and only then do older folders go. So a fold, or a batch, that is broken off at any
point is simply done again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from transferlens.sources.folders import children, delete, exists

BUCKETS = 32
#: Micro-batches after which deltas are folded.
FOLD_EVERY = 50


def index_of(target: str) -> str:
    return f"{target.rstrip('/')}.keys"


def key_bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def newest_base(spark: SparkSession, index: str) -> int:
    """The last micro-batch of the newest complete base; -1 without one."""
    bases = [int(name.split("=")[1]) for name in children(spark, index) if name.startswith("base=")]
    return max((n for n in bases if exists(spark, f"{index}/base={n}/_SUCCESS")), default=-1)


def known_keys(spark: SparkSession, index: str, schema: T.StructType, buckets: Sequence[int], batch_id: int) -> DataFrame | None:
    """Keys of these buckets that micro-batches before ``batch_id`` stored; None if there are none."""
    base, out = newest_base(spark, index), None
    for root, after in ((f"{index}/base={base}", None), (f"{index}/delta", base)):
        folders = [f for b in buckets if exists(spark, f := f"{root}/bucket={b}")]
        if not folders:
            continue
        shape = schema if after is None else T.StructType([*schema.fields, T.StructField("batch", T.LongType())])
        rows = spark.read.schema(shape).option("basePath", root).parquet(*folders)
        if after is not None:
            rows = rows.where((F.col("batch") > after) & (F.col("batch") < batch_id))
        rows = rows.select(*schema.names)
        out = rows if out is None else out.unionByName(rows)
    return out


def add_keys(rows: DataFrame, index: str, keys: Sequence[str], batch_id: int, buckets: int) -> None:
    """The keys that this micro-batch stored; a replay replaces them."""
    tagged = rows.select(*keys).withColumns({"bucket": key_bucket(keys, buckets), "batch": F.lit(batch_id).cast("long")})
    tagged.hint("rebalance", "bucket").write.option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch").mode("overwrite").parquet(f"{index}/delta")


def fold_keys(spark: SparkSession, index: str, schema: T.StructType, upto: int) -> None:
    """One base of all keys up to micro-batch ``upto``, in place of the deltas and the base before."""
    names = {"base": newest_base(spark, index)}
    if upto <= names["base"]:
        return
    shape = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    parts = []
    if names["base"] >= 0:
        parts.append(spark.read.schema(shape).parquet(f"{index}/base={names['base']}"))
    if exists(spark, f"{index}/delta"):
        deltas = spark.read.schema(shape.add("batch", T.LongType())).parquet(f"{index}/delta")
        parts.append(deltas.where((F.col("batch") > names["base"]) & (F.col("batch") <= upto)).drop("batch"))
    if not parts:
        return
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    rows.hint("rebalance", "bucket").write.partitionBy("bucket").mode("overwrite").parquet(f"{index}/base={upto}")
    for name in children(spark, index):
        if name.startswith("base=") and int(name.split("=")[1]) < upto:
            delete(spark, f"{index}/{name}")
    for bucket in children(spark, f"{index}/delta"):
        for name in children(spark, f"{index}/delta/{bucket}") if bucket.startswith("bucket=") else ():
            if name.startswith("batch=") and int(name.split("=")[1]) <= upto:
                delete(spark, f"{index}/delta/{bucket}/{name}")
