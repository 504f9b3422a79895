"""Exact top-k search by inner product with a vector-approximation file.

Vectors become whole numbers, floor(scale x). Equal vectors are one entry with its smallest ids, as many as any result can need, so a
vector that holds a third of all rows is compared once. For every entry a small cell code is stored: per dimension the number of
the interval that holds its value. From the intervals' ends follow a lower and an upper bound of its score for a query.

Search, for the queries in blocks of bounded bytes, each against all entries:
1. a scan of the cells finds the k-th best lower bound of every query, folded over the tasks;
2. a second scan keeps the entries whose upper bound reaches it, all of them;
3. exact vectors of these are read in order of their bounds, a few per query first and twice as many each round, until no
   unread entry's upper bound can reach the k-th exact score.

A query's own row is left out at the end: the search is for one more result, over distinct vectors, so queries with equal vectors
share it. The marks between cells are quantiles of a sample of about ``SAMPLE`` entries, chosen by hash; they only decide how
tight the bounds are. The outer cells end at the least and largest value of all entries, so bounds, and results, are exact. Bounds are
whole numbers in doubles; where those could round, the bounds are widened by more than the rounding.

Ids and queries come from the whole table. The driver holds marks (256 a dimension at most), one block of queries and their
thresholds. Candidates of a query are ranked behind a limit that Spark applies before it shuffles, so no task sorts all of them. Each step
is a table in the shared folder, a lost executor repeats its part only.

Defined cases: vectors that are null, hold null or non-finite components, or have not the commonest length take no part, nor do rows
without an id. Rows equal in id and vector count once; a query never finds a row with its own id. Ties go to the smaller id. With fewer
candidates than k all are returned. Components whose whole number is beyond 2^62 take the nearest of that size; a score beyond a long
is the nearest long. An empty table, or one without queries, gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.vectors import chunks, dimension, finite, folded, whole_numbers
from transferlens.session import stored, work_folder

#: Bits of a cell number, a dimension.
BITS = 6
#: Entries, about, from which the marks are taken, and their bytes at most.
SAMPLE = 8192
SAMPLE_BYTES = 16 << 20
#: Bytes of query vectors that are searched together, and numbers of bounds that are made at once.
QUERY_BYTES = 8 << 20
TILE = 1 << 21
CANDIDATE = "query long, key long, first long, upper double"
#: Sums of whole numbers up to here are exact in doubles.
_EXACT = float(1 << 53)


def _numbers(values: list[bytes] | pa.Array, size: int) -> np.ndarray:
    parts = values.to_pylist() if isinstance(values, pa.Array) else values
    return np.frombuffer(b"".join(parts), np.int64).reshape(-1, size)


def rows_of(df: DataFrame, size: int, *, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, v): distinct rows that take part, vectors as the bytes of their whole numbers."""
    own = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))

    def quantised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            rows, values = finite(part.column(1), size)
            x = whole_numbers(values, scale)
            ids = part.column(0).take(pa.array(rows))
            for own in chunks(len(rows), size):
                yield pa.RecordBatch.from_arrays([ids[own], pa.array([v.tobytes() for v in x[own]], pa.binary())], ["vec_id", "v"])

    return own.filter(F.col("vec_id").isNotNull()).mapInArrow(quantised, "vec_id long, v binary")


def entries_of(rows: DataFrame, ids: int) -> DataFrame:
    """(key, v, ids): distinct vectors with their ``ids`` smallest ids, ascending."""
    hashed = rows.withColumn("h", F.xxhash64("v"))
    turn = F.row_number().over(Window.partitionBy("h", "v").orderBy("vec_id"))
    # Spark keeps the first of a group before it shuffles
    few = hashed.dropDuplicates(["vec_id", "h", "v"]).withColumn("turn", turn).filter(F.col("turn") <= ids)
    grouped = few.groupBy("h", "v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    return grouped.select(F.monotonically_increasing_id().alias("key"), "v", "ids")


def marks_of(entries: DataFrame, size: int, count: int, bits: int = BITS, sample: int = SAMPLE) -> np.ndarray:
    """(dimension, cells + 1): ascending ends of the cells; a cell holds the values from its mark on and below the next."""
    sample = min(sample, SAMPLE_BYTES // (8 * size) or 1)
    chosen = entries.filter(F.abs(F.xxhash64("key", "v") / 2.0**63) < sample / max(count, 1)).select("v")
    values = _numbers([row["v"] for row in chosen.collect()], size)

    def ends(batches: Iterator[pa.RecordBatch]) -> np.ndarray | None:
        found = [np.concatenate([x.min(axis=0), -x.max(axis=0)]) for part in batches if len(x := _numbers(part.column(0), size))]
        return np.min(found, axis=0) if found else None

    outer = folded(entries.select("v"), ends, np.minimum, "int64").reshape(2, size)
    cells = 1 << bits
    inner = np.quantile(values, np.arange(1, cells) / cells, axis=0, method="higher").T if len(values) else np.zeros((size, cells - 1))
    inner = np.clip(inner.astype(np.int64), outer[0][:, None], -outer[1][:, None] + 1)
    return np.concatenate([outer[0][:, None], inner, -outer[1][:, None] + 1], axis=1)


def cells_of(entries: DataFrame, size: int, marks: np.ndarray) -> DataFrame:
    """(keys, firsts, codes): blocks of cell codes with their entries' keys and smallest ids."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            keys, firsts, x = part.column(0).to_numpy(), part.column(1).to_numpy(), _numbers(part.column(2), size)
            for own in chunks(len(x), 8 * size):
                codes = np.stack([np.searchsorted(marks[k, 1:-1], x[own, k], side="right") for k in range(size)], axis=1)
                values = [keys[own].tobytes(), firsts[own].tobytes(), codes.astype(np.uint8).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], ["keys", "firsts", "codes"])

    return entries.select("key", F.col("ids")[0].alias("first"), "v").mapInArrow(code, "keys binary, firsts binary, codes binary")


def _bounds(cells: pa.RecordBatch, marks: np.ndarray, queries: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per tile: (first query, keys, smallest ids, lower bounds, upper bounds), a row of bounds a query."""
    size, largest = len(marks), float(np.abs(marks.astype(float)).max(initial=0))
    up, down = np.maximum(queries, 0.0), np.minimum(queries, 0.0)
    reach = np.abs(queries).sum(axis=1) * largest
    slack = np.where(reach < _EXACT, 0.0, reach * size * 2.0**-49)[:, None]
    dims = np.arange(size)
    for keys, firsts, codes in zip(*(cells.column(k).to_pylist() for k in range(3)), strict=True):
        keys, firsts = np.frombuffer(keys, np.int64), np.frombuffer(firsts, np.int64)
        codes = np.frombuffer(codes, np.uint8).reshape(-1, size)
        low, high = marks[dims, codes].astype(float).T, (marks[dims, codes.astype(np.int64) + 1] - 1).astype(float).T
        step = max(1, TILE // max(len(keys), 1))
        for at in range(0, len(queries), step):
            some = slice(at, at + step)
            least = up[some] @ low + down[some] @ high - slack[some]
            yield at, keys, firsts, least, up[some] @ high + down[some] @ low + slack[some]


def thresholds(cells: DataFrame, marks: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the k-th best lower bound and, of the entries that reach it, the last smallest id; -inf with fewer than k entries."""
    longs = np.iinfo(np.int64)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, ids = np.full((len(queries), k), -np.inf), np.full((len(queries), k), longs.max)
        for part in batches:
            for at, _, firsts, least, _ in _bounds(part, marks, queries):
                hit = least >= scores[at : at + len(least), -1:]
                for row in np.flatnonzero(hit.any(axis=1)):
                    own = np.flatnonzero(hit[row])
                    value, who = np.concatenate([scores[at + row], least[row, own]]), np.concatenate([ids[at + row], firsts[own]])
                    first = np.lexsort((who, -value))[:k]
                    scores[at + row], ids[at + row] = value[first], who[first]
        query, place = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(scores[query, place]), pa.array(ids[query, place])], ["query", "score", "id"])

    turn = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    found = cells.mapInArrow(best, "query long, score double, id long").withColumn("turn", turn).filter(F.col("turn") <= k)
    score, last = np.full(len(queries), -np.inf), np.full(len(queries), longs.max)
    for row in found.filter(F.col("turn") == k).select("query", "score", "id").collect():
        score[row["query"]], last[row["query"]] = row["score"], row["id"]
    return score, last


def candidates(cells: DataFrame, marks: np.ndarray, keys: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """(query, key, first, upper): all entries that can be among the k best of a query."""
    score, last = thresholds(cells, marks, queries, k)

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for at, entry, firsts, _, most in _bounds(part, marks, queries):
                some = slice(at, at + len(most))
                limit = score[some][:, None]
                row, column = np.nonzero(most >= limit)
                kept = (most[row, column] > limit[row, 0]) | (firsts[column] <= last[some][row])
                row, column = row[kept], column[kept]
                values = [keys[at + row], entry[column], firsts[column], most[row, column]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, values)), ["query", "key", "first", "upper"])

    return cells.mapInArrow(reach, CANDIDATE)


def _scored(pairs: DataFrame, entries: DataFrame, queries: DataFrame, size: int) -> DataFrame:
    """(query, vec_id, score): exact scores of (query, key) pairs, one row per id of the entry."""
    joined = pairs.select("query", "key").join(entries, "key").join(queries.select(F.col("key").alias("query"), F.col("v").alias("q")), "query")
    longs = np.iinfo(np.int64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            a, b, ids = _numbers(part.column(3), size), _numbers(part.column(1), size), part.column(2)
            value = np.zeros(len(a), dtype=np.int64)
            if len(a) and np.abs(a.astype(float)).max(initial=0) * np.abs(b.astype(float)).max(initial=0) * size < _EXACT * 512:
                value = np.einsum("ij,ij->i", a, b)
            elif len(a):
                whole = (a.astype(object) * b.astype(object)).sum(axis=1)
                value = np.array([min(max(int(s), longs.min), longs.max) for s in whole], dtype=np.int64)
            each = pa.array(np.repeat(np.arange(len(a)), ids.value_lengths().to_numpy()))
            yield pa.RecordBatch.from_arrays([part.column(0).take(each), ids.flatten(), pa.array(value).take(each)], ["query", "vec_id", "score"])

    return joined.select("query", "v", "ids", "q").mapInArrow(score, "query long, vec_id long, score long")


def _first(rows: DataFrame, order: list, limit: int, name: str) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    return rows.withColumn(name, turn).filter(F.col(name) <= limit)


def refined(found: DataFrame, entries: DataFrame, queries: DataFrame, size: int, k: int) -> DataFrame:
    """(query, rank, vec_id, score): the k best, reading exact vectors in order of the bounds until they are certain."""
    left, best, limit = found, None, 4 * k
    place = F.struct((-F.col("upper")).alias("upper"), F.col("first").alias("first"), F.col("key").alias("key"))
    while True:
        batch = stored(_first(left, [F.desc("upper"), "first", "key"], limit, "turn"), "vafile-batch")
        exact = _scored(batch, entries, queries, size)
        rows = exact if best is None else exact.unionByName(best.drop("rank"))
        best = stored(_first(rows, [F.desc("score"), "vec_id"], k, "rank"), "vafile-best")
        read = batch.groupBy("query").agg(F.max(place).alias("read"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == limit)
        kth = best.filter(F.col("rank") == k).select("query", F.col("score").alias("kth"), F.col("vec_id").alias("kth_id"))
        even = (F.col("upper") == F.col("kth")) & (F.col("first") < F.col("kth_id"))
        may = F.col("kth").isNull() | (F.col("upper") > F.col("kth")) | even
        open_ = left.join(read, "query").join(kth, "query", "left").filter((place > F.col("read")) & may)
        left = stored(open_.select("query", "key", "first", "upper"), "vafile-open")
        if not left.head(1):
            return best
        limit *= 2


def search(
    df: DataFrame, is_query: Column, *, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding", scale: int = 256,
    bits: int = BITS, query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest scores for every row of ``df`` that ``is_query`` tells.

    ``is_query`` is a condition on ``vec_id``.
    """
    size = dimension(df, vector)
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not size:
        return empty
    rows = stored(rows_of(df, size, vec_id=vec_id, vector=vector, scale=scale), "vafile-rows")
    entries = stored(entries_of(rows, k + 1), "vafile-entries")
    asked = rows.filter(is_query).distinct().join(entries.select("v", "key"), "v").select(F.col("vec_id").alias("query_id"), F.col("key").alias("query"))
    asked = stored(asked, "vafile-asked")
    queries = stored(entries.join(asked.select(F.col("query").alias("key")).distinct(), "key", "left_semi").select("key", "v"), "vafile-queries")
    n_queries = queries.count()
    if not n_queries:
        return empty
    marks = marks_of(entries, size, entries.count(), bits)
    cells = stored(cells_of(entries, size, marks), "vafile-cells")
    parts = -(-n_queries * size * 8 // query_bytes)
    path = work_folder(df.sparkSession, "vafile-candidates")
    for part in range(parts):
        own = queries.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == part).collect()
        if own:
            keys, values = np.array([r["key"] for r in own]), _numbers([r["v"] for r in own], size).astype(float)
            candidates(cells, marks, keys, values, k + 1).write.parquet(f"{path}/part={part}")
    found = df.sparkSession.read.schema(CANDIDATE).parquet(path)
    best = refined(found, entries, queries, size, k + 1)
    # at most k + 1 results a query vector
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
    other = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asked.join(lists, "query").select("query_id", F.posexplode(other).alias("place", "row"))
    return out.select("query_id", (F.col("place") + 1).alias("rank"), "row.vec_id", "row.score")
