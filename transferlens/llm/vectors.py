"""What the vector operators share: reading vectors from Arrow batches, and folding one array a task into one array."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of numbers that are worked on together.
BLOCK = 4 << 20


def dimension(df: DataFrame, vector: str) -> int:
    """The commonest length of the vectors, of equally common ones the largest; 0 without vectors."""
    sizes = df.filter(F.col(vector).isNotNull()).groupBy(F.size(vector).alias("size")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("size")).head(1)
    return first[0]["size"] if first else 0


def finite(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose vector has ``size`` finite numbers, and those numbers as doubles."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    rows = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False) & (lengths == size))
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null entries become NaN
    found = values[(ends[rows] - size)[:, None] + np.arange(size)]
    good = np.isfinite(found).all(axis=1)
    return rows[good], found[good]


def whole_numbers(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * values) as int64; beyond +-2^62 the nearest of these."""
    limit = float(1 << 62)
    return np.clip(np.floor(scale * values), -limit, limit).astype(np.int64)


def chunks(rows: int, width: int) -> Iterator[slice]:
    """Slices of so many rows that ``width`` numbers each fit into a block."""
    step = max(1, BLOCK // (8 * max(width, 1)))
    return (slice(at, min(at + step, rows)) for at in range(0, rows, step))


def folded(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], np.ndarray | None], join: Callable, dtype: str = "float64") -> np.ndarray | None:
    """``each`` makes one flat array of a task's batches; ``join`` (such as ``np.add``) folds those of all tasks.

    The arrays are folded in two steps, as many lanes as the root of their number, so that neither a task nor the driver
    holds more than that many.
    """

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = each(batches)
        if found is not None:
            lane, value = TaskContext.get().partitionId(), np.ascontiguousarray(found, dtype=dtype).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([lane], pa.int64()), pa.array([value], pa.binary())], ["lane", "part"])

    def all_of(parts) -> np.ndarray:
        arrays = [np.frombuffer(p, dtype=dtype) for p in parts]
        out = arrays[0]
        for other in arrays[1:]:
            out = join(out, other)
        return out

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [all_of(group["part"]).tobytes()]})

    parts = df.mapInArrow(part, "lane long, part binary")
    lanes = math.isqrt(max(1, df.rdd.getNumPartitions()))
    dealt = parts.withColumn("lane", F.pmod("lane", F.lit(lanes)))
    merged = [row["part"] for row in dealt.groupBy("lane").applyInPandas(merge, "part binary").collect()]
    return all_of(merged) if merged else None
