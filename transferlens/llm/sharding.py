"""Sharding by a k-d tree over metadata, in DataFrame functions only.

Every distinct text is one point, weighted by the bytes of its copies, with metadata as coordinates (by default the logarithm of the
size, the source and the language). A node that holds more than the target bytes is cut at its weighted median along the dimension in
which it is widest, relative to the whole corpus; with a number of leaves that is no power of two the cut is at the share
of leaves on its left. Leaves are the shards, so their sizes are near equal and the documents of a shard alike.

The median is exact up to ``PRECISION`` of the node: coordinate and a hash of the text form a 63-bit key, and each pass counts the
bytes in 4096 buckets of the key range that holds the median, for all nodes at once. A pass shuffles one row for each bucket
and map task, and the driver sees one row per node; nothing is sorted.

Copies of a text stay together, unless they hold more than ``SPLIT`` of a leaf: such a group is dealt into parts by id first, which
are points of their own; there are at most leaves / SPLIT such groups, the bound of what is broadcast.

Slots are gapless in each shard without sorting a shard in one task: rows are numbered in buckets of about ``BUCKET`` rows, and the
buckets of a shard are laid end to end.

Defined cases: a null text has no bytes and size 1, like an empty one. Null metadata is a value of its own. Repeated rows are
sharded one by one. An empty table gives no rows; with fewer points than leaves some shards are empty. Law: ``bytes``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import whole
from transferlens.session import stored

SPLIT = 0.01
PRECISION = 0.0005
BUCKET = 100_000
_GRID = 20  # bits of a coordinate in the key
_TIE = 63 - _GRID
_FAN = 12  # bits of a pass
LAW = "bytes"


def text_dimensions() -> dict[str, Column]:
    return {
        "size": F.log2(F.col("size").cast("double")),
        "source": F.crc32(F.coalesce(F.col("source"), F.lit(""))).cast("double"),
        "lang": F.crc32(F.coalesce(F.col("lang"), F.lit(""))).cast("double"),
    }


def _sized(docs: DataFrame, doc_id: str, text: str, dimensions: Mapping[str, Column]) -> DataFrame:
    """(doc_id, size, text_crc32, text_hash, d0..): the rows without their texts."""
    body = whole(F.col(text))
    named = docs.withColumns({"size": F.octet_length(body).cast("long") + 1, "text_crc32": F.crc32(body), "text_hash": F.xxhash64(body)})
    coordinates = [F.coalesce(c, F.lit(-1.0)).alias(f"d{k}") for k, c in enumerate(dimensions.values())]
    return named.select(F.col(doc_id).alias("doc_id"), "size", "text_crc32", "text_hash", *coordinates)


def _key(n_dimensions: int) -> Column:
    """63-bit place of a point along its node's dimension, ties ordered by hash. Needs the node's row joined."""
    along = F.element_at(F.array(*[F.col(f"d{k}") for k in range(n_dimensions)]), F.col("dim"))
    cell = F.least(F.greatest(F.floor((along - F.col("least")) * F.col("scale")), F.lit(0)), F.lit((1 << _GRID) - 1))
    return F.shiftleft(cell.cast("long"), _TIE).bitwiseOR(F.shiftrightunsigned(F.xxhash64("text_hash", "part"), 64 - _TIE))


def _cuts(points: DataFrame, nodes: dict[int, dict], n_dimensions: int) -> dict[int, int]:
    """For each node the key from which on points go right."""
    spark = points.sparkSession
    state = {n: {"low": 0, "below": 0} for n in nodes}
    cuts: dict[int, int] = {}
    schema = "node int, dim int, least double, scale double, low long, below double, target double"
    for shift in range(63 - _FAN, -_FAN, -_FAN):
        shift = max(shift, 0)
        rows = [(n, x["dim"], x["least"], x["scale"], state[n]["low"], float(state[n]["below"]), float(x["target"])) for n, x in nodes.items() if n not in cuts]
        if not rows:
            break
        keyed = points.join(F.broadcast(spark.createDataFrame(rows, schema)), "node").withColumn("key", _key(n_dimensions))
        past = F.shiftright(F.col("key") - F.col("low"), shift)
        counts = keyed.filter((F.col("key") >= F.col("low")) & (past < 1 << _FAN)).groupBy("node", "below", "target", past.alias("bucket")).agg(F.sum("weight").alias("w"))
        upto = F.sum("w").over(Window.partitionBy("node").orderBy("bucket"))
        reached = counts.withColumn("upto", upto + F.col("below")).filter((F.col("upto") >= F.col("target")) & (F.col("upto") - F.col("w") < F.col("target")))
        for r in reached.groupBy("node").agg(F.min_by(F.struct("bucket", "w", "upto"), "bucket").alias("b")).collect():
            node, bucket, w, reach = r["node"], r["b"]["bucket"], r["b"]["w"], r["b"]["upto"]
            low, x = state[node]["low"], nodes[node]
            if w <= PRECISION * x["weight"] or shift == 0:
                after = abs(reach - x["target"]) <= abs(reach - w - x["target"])
                cuts[node] = low + ((bucket + after) << shift)
            else:
                state[node] = {"low": low + (bucket << shift), "below": reach - w}
        if shift == 0:
            break
    return {n: cuts.get(n, 1 << 62) for n in nodes}


def assigned(points: DataFrame, leaves: int, n_dimensions: int) -> DataFrame:
    """``points`` (text_hash, part, d0.., weight) with the leaf each belongs to, as ``shard``."""
    spark = points.sparkSession
    points = stored(points.withColumn("node", F.lit(0)), "sharding-points")
    first, count = {0: 0}, {0: leaves}  # of each node: its first leaf, and how many
    extents = [f for k in range(n_dimensions) for f in (F.min(f"d{k}").alias(f"low{k}"), F.max(f"d{k}").alias(f"high{k}"))]
    whole_range = points.agg(*extents).first()
    while any(n > 1 for n in count.values()):
        nodes = {}
        for r in points.groupBy("node").agg(F.sum("weight").alias("weight"), *extents).collect():
            node = r["node"]
            if count[node] < 2:
                continue
            widths = [(r[f"high{k}"] - r[f"low{k}"]) / ((whole_range[f"high{k}"] - whole_range[f"low{k}"]) or 1.0) for k in range(n_dimensions)]
            dim = max(range(n_dimensions), key=widths.__getitem__)
            span = r[f"high{dim}"] - r[f"low{dim}"]
            share = (count[node] // 2) / count[node]
            nodes[node] = {"dim": dim + 1, "least": r[f"low{dim}"], "scale": ((1 << _GRID) - 1) / span if span else 0.0, "weight": r["weight"], "target": r["weight"] * share}
        if not nodes:
            break
        cuts = _cuts(points, nodes, n_dimensions)
        fresh, rows = max(count) + 1, []
        for node, x in nodes.items():
            rows.append((node, x["dim"], x["least"], x["scale"], cuts[node], fresh))
            left = count[node] // 2
            first[fresh], count[fresh] = first[node] + left, count[node] - left
            count[node] = left
            fresh += 1
        params = spark.createDataFrame(rows, "node int, dim int, least double, scale double, cut long, right int")
        names = points.columns
        moved = points.join(F.broadcast(params), "node", "left").withColumn("key", _key(n_dimensions))
        points = stored(moved.withColumn("node", F.when(F.col("key") >= F.col("cut"), F.col("right")).otherwise(F.col("node"))).select(*names), "sharding-points")
    leaf = spark.createDataFrame([(n, f) for n, f in first.items()], "node int, shard int")
    return points.join(F.broadcast(leaf), "node").drop("node")


def shards(
    docs: DataFrame, *, target_bytes: int | None = None, leaves: int | None = None, doc_id: str = "doc_id", text: str = "text", dimensions: Mapping[str, Column] | None = None
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot) of every row; as many shards as ``leaves``, or as the target size asks for."""
    dimensions = dimensions or text_dimensions()
    rows = stored(_sized(docs, doc_id, text, dimensions), "sharding-rows")
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    leaves = leaves or max(1, -(-total // (target_bytes or total or 1)))
    most = max(1.0, SPLIT * total / leaves)
    places = [f"d{k}" for k in range(len(dimensions))]
    heavy = rows.groupBy("text_hash").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") > most)
    heavy = heavy.select("text_hash", F.ceil(F.col("bytes") / most).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("parts", F.lit(1))).cast("int")
    rows = rows.join(F.broadcast(heavy), "text_hash", "left").withColumn("part", part).drop("parts")
    # copies may differ in source or language: the point stands where the least of them is
    points = rows.groupBy("text_hash", "part").agg(*[F.min(p).alias(p) for p in places], F.sum("size").alias("weight"))
    leaf = assigned(points, leaves, len(places)).select("text_hash", "part", "shard")
    placed = rows.join(leaf, ["text_hash", "part"]).select("doc_id", "size", "text_crc32", "text_hash", "shard")
    return _slotted(stored(placed, "sharding-placed"), n_rows).withColumn("law", F.lit(LAW)).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot"
    )


def _slotted(rows: DataFrame, n_rows: int) -> DataFrame:
    buckets = max(1, -(-n_rows // BUCKET))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(buckets)))
    counts = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    counts = counts.select("shard", "bucket", before.alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("text_hash", "doc_id")) - 1
    return rows.withColumn("inside", inside).join(counts, ["shard", "bucket"]).withColumn("slot", (F.col("inside") + F.col("before")).cast("long"))
