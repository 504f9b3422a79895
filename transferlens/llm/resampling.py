"""Importance resampling: draws the documents whose word runs look most like a target corpus, with noise that makes it a sample.

Runs of words (n-grams) are counted by hashed bucket over all documents and over all target texts. A bucket's gain is the
logarithm of how much commoner it is in the target; a document's weight is the sum of the gains of its runs. Its score adds Gumbel
noise from a hash of its id, so that the highest scores are a draw without replacement.

Inside a task texts are taken in batches of at most ``CHUNK`` bytes. Each batch interns its runs in an open-addressed table of
numpy slots: the xxhash64 of a run names its first slot, equal hashes are verified byte by byte, and others probe on. A slot holds the
run's bucket and its count, so a run's bucket is found once a batch; the slot ids of the occurrences then gather the gains.
A longer text is taken in parts cut between words, each led by the words that its first runs still need.

What the driver holds is one count and one gain a bucket. Ranks come from one sort by range of narrow rows (id, figures), numbered within
its partitions behind the sizes of the partitions before; neither the driver nor one task sees them all.

Defined cases: null and empty texts have no words, no features and weight 0. A null id is hashed as the empty text and comes after
all other ids in ties. Repeated rows count each. Ties go to the smaller id, then to more features, then to the smaller text hash. No
documents: no rows; no target texts: every count there is 0. Other columns are not read by ``importance`` and stay as they are in
``resample``, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from transferlens.session import stored

BUCKETS = 10_000
#: Bytes of text that are interned together.
CHUNK = 4 << 20
#: Bytes of words: digits, lower-case letters and all of characters beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[0x30:0x3A] = WORD[0x61:0x7B] = WORD[0x80:] = True


class GramTable:
    """Open-addressed table of the distinct runs of one batch. ``slot`` has the slot of every occurrence."""

    def __init__(self, grams: list[bytes], buckets: int) -> None:
        values = np.empty(len(grams), dtype=object)
        values[:] = grams
        size = 1 << max(4, (2 * len(grams)).bit_length())
        self.owner = np.full(size, -1, dtype=np.int64)  # the occurrence that claimed the slot
        self.slot = self._place(values, np.fromiter(map(xxhash.xxh64_intdigest, grams), np.uint64, len(grams)))
        self.used = np.flatnonzero(self.owner >= 0)
        self.bucket = np.zeros(size, dtype=np.int64)
        self.bucket[self.used] = [zlib.crc32(grams[o]) % buckets for o in self.owner[self.used].tolist()]
        self.count = np.bincount(self.slot, minlength=size)

    def _place(self, grams: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        last = len(self.owner) - 1
        at = (hashes & np.uint64(last)).astype(np.int64)
        slot = np.empty(len(grams), dtype=np.int64)
        todo = np.arange(len(grams))
        while len(todo):
            here = at[todo]
            free = self.owner[here] < 0
            self.owner[here[free][::-1]] = todo[free][::-1]  # of several the first occurrence claims it
            own = self.owner[here]
            same = hashes[own] == hashes[todo]
            same[same] = (grams[own[same]] == grams[todo[same]]).astype(bool)
            slot[todo[same]] = here[same]
            todo = todo[~same]
            at[todo] = (at[todo] + 1) & last
        return slot

    def bucket_counts(self, buckets: int) -> np.ndarray:
        out = np.zeros(buckets, dtype=np.int64)
        np.add.at(out, self.bucket[self.used], self.count[self.used])
        return out


def _parts(texts: list[str | None], longest: int, chunk: int) -> Iterator[list[tuple[int, bytes, int]]]:
    """Batches of (row, lower-cased bytes, leading words that belong to runs of the part before)."""
    batch, size = [], 0
    for row, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass").lower()
        lead: list[bytes] = []
        while data:
            if len(data) <= chunk:
                part, data = data, b""
            else:
                gaps = np.flatnonzero(~WORD[np.frombuffer(data, np.uint8, chunk)])
                if not len(gaps):  # one word longer than a chunk
                    gaps = chunk + np.flatnonzero(~WORD[np.frombuffer(data, np.uint8, offset=chunk)])[:1]
                cut = int(gaps[-1]) + 1 if len(gaps) else len(data)
                part, data = data[:cut], data[cut:]
            part = b" ".join([*lead, part])
            batch.append((row, part, len(lead)))
            size += len(part)
            lead = _words(part)[-(longest - 1) :] if longest > 1 and data else []
            if size >= chunk:
                yield batch
                batch, size = [], 0
    if batch:
        yield batch


def _words(data: bytes) -> list[bytes]:
    raw = np.frombuffer(data, np.uint8)
    return np.where(WORD[raw], raw, np.uint8(0x20)).tobytes().split()


def _grams(words: list[bytes], n: int, lead: int) -> list[bytes]:
    """All runs of n words that end behind the leading words."""
    if n == 1:
        return words[lead:]
    return [b" ".join(words[k - n + 1 : k + 1]) for k in range(max(lead, n - 1), len(words))]


def interned(texts: list[str | None], shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, chunk: int = CHUNK) -> Iterator[tuple[GramTable, np.ndarray, np.ndarray, np.ndarray]]:
    """Per batch: the table, and for each part its row, its number of new words and of runs; occurrences are in order of the parts."""
    for batch in _parts(texts, longest, chunk):
        grams: list[bytes] = []
        rows, n_words, n_grams = [], [], []
        for row, part, lead in batch:
            words, before = _words(part), len(grams)
            for n in range(shortest, longest + 1):
                grams.extend(_grams(words, n, lead))
            rows.append(row)
            n_words.append(len(words) - lead)
            n_grams.append(len(grams) - before)
        yield GramTable(grams, buckets), np.array(rows), np.array(n_words), np.array(n_grams)


def bucket_counts(texts: DataFrame, column: str = "text", *, ngrams: tuple[int, int] = (1, 1), buckets: int = BUCKETS) -> np.ndarray:
    """Runs in each bucket over all rows: every task sends one count a bucket, Spark adds them up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for part in batches:
            for table, *_ in interned(part.column(0).to_pylist(), *ngrams, buckets):
                total += table.bucket_counts(buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counted = texts.select(F.col(column).alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares in target and corpus."""
    own = (target + 1).astype(float) * float(corpus.sum() + len(corpus))
    all_ = (corpus + 1).astype(float) * float(target.sum() + len(target))
    return np.floor(1000 * np.log(own / all_)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray, *, doc_id: str = "doc_id", text: str = "text", ngrams: tuple[int, int] = (1, 1)) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight) of every row."""
    own = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), F.col(text).alias("text"))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            figures = np.zeros((3, part.num_rows), dtype=np.int64)
            for table, rows, n_words, n_grams in interned(part.column(2).to_pylist(), *ngrams, len(gains)):
                upto = np.concatenate([[0], np.cumsum(gains[table.bucket][table.slot])])
                ends = np.cumsum(n_grams)
                for figure, value in zip(figures, (n_words, n_grams, upto[ends] - upto[ends - n_grams]), strict=True):
                    np.add.at(figure, rows, value)
            columns = [part.column(0), part.column(1), *map(pa.array, figures)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "n_words", "n_features", "weight"])

    kinds = f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text_hash long, n_words long, n_features long, weight long"
    return own.mapInArrow(weigh, kinds)


def with_noise(weighted: DataFrame, seed: int) -> DataFrame:
    """``score``: the weight and Gumbel noise, in thousandths, from the first 32 bits of the SHA-256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighted.withColumn("score", F.col("weight") + noise)


def with_rank(rows: DataFrame, order: list, rank: str) -> DataFrame:
    """``rows`` with their place in ``order``, from 1: sorted by range, numbered behind the partitions before."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stored(sorted_.withColumn("_place", F.monotonically_increasing_id()), "resampling-sorted")
    part = F.shiftright("_place", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    # one row a partition
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    joined = numbered.withColumn("_part", part).join(F.broadcast(before), "_part")
    inside = F.col("_place") - F.shiftleft(F.col("_part"), 33)
    return joined.withColumn(rank, F.col("_before") + inside + 1).drop("_place", "_part", "_before")


def importance(
    docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
    ngrams: tuple[int, int] = (1, 1), buckets: int = BUCKETS, percent: int = 10, least_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score, rank) of every row; rank is null for those not drawn."""
    gains = gains_of(bucket_counts(docs, text, ngrams=ngrams, buckets=buckets), bucket_counts(target, target_text, ngrams=ngrams, buckets=buckets))
    scored = stored(with_noise(weights(docs, gains, doc_id=doc_id, text=text, ngrams=ngrams), seed), "resampling-scores")
    eligible = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * eligible.count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("n_features"), F.asc("text_hash")]
    ranked = with_rank(eligible, order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, all columns as they came; of rows equal in id and text all stay if one is drawn."""
    found = importance(docs, target, doc_id=doc_id, text=text, **settings).filter(F.col("rank").isNotNull())
    drawn = found.select(F.struct("doc_id", "text_hash").alias("key")).distinct().alias("drawn")
    rows = docs.alias("docs")
    key = F.struct(F.col(f"docs.`{doc_id}`"), F.xxhash64(F.coalesce(F.col(f"docs.`{text}`"), F.lit(""))))
    return rows.join(drawn, key.eqNullSafe(F.col("drawn.key")), "left_semi")
