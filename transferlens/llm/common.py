"""What several operators of this folder share."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Documents carry these columns.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores as it takes not to be a column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def held_out(doc_id: Column, parts: int) -> Column:
    """True for the share of ids kept from learning; a null id belongs to the learning part."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 2, F.lit(False))


def whole(text: Column) -> Column:
    """The text, a null one as an empty one."""
    return F.coalesce(text, F.lit(""))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words between spaces and the controls 9 to 13, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``concatenate([arange(s, s + c) for s, c in zip(starts, counts)])`` without the loop."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, dtype=np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift
