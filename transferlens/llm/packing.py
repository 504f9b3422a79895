"""Best-fit packing of tokenized documents into sequences, by hierarchical residual packing.

A document's token ids, closed by one end id, are cut into pieces of the sequence length; only the last piece may be shorter,
so a document no longer than a sequence stays whole. The pieces are dealt to many groups of bounded size. Each group packs its own by
best fit in decreasing order and emits the bins that are at least ``FULL`` full. The other bins, each now one item of its
size, go on to the next round, where fewer groups pack them by best fit again, and so on as a tree. No group ever
has more than ``GROUP`` items on average. Every round deals the bins anew by another hash. It ends when one group has packed all that is left, or when
``IDLE`` deals in a row have merged nothing.

Tokenization works per word: a tokenizer that drops white space encodes the pieces between spaces independently (and marks
apart from the letters before them), so each worker keeps the ids of words it has met, over all its tasks, and asks the tokenizer for new ones
only, many at a time. The cache is bounded: when it is full, words not met since it was last full go. Tests compare this with encoding whole texts.

Defined cases: null and empty texts are the end id alone. Repeated rows are packed once each. A text of any length is cut into
full sequences and one rest. Rows are dealt by a hash of all that identifies a piece, and every round is written to the
shared folder, so a lost executor repeats its own part only and placements stay consistent.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import ragged
from transferlens.session import stored

VOCABULARY = "word_bpe_49k.json"
LENGTH = 4096
END = 1
#: A bin at least so full is emitted at once.
FULL = 0.995
#: Items of one group.
GROUP = 200_000
_CACHE = 1_000_000
#: Deals in a row without a merge after which the bins stay as they are.
IDLE = 3
#: Signs of which one that is a single token stands between words that are encoded together.
_MARKS = "\u2764\u2605\u2665\u2022"
_PIECE = "doc_id long, item long, piece int, start long, length long, ids_crc32 long"


#: Marks behind a letter or digit, up to white space, are a token run of their own.
_TAIL = re.compile(rb"([a-z0-9])([.,!?$%&*#|]+)(?![^\s])")


def _split(text: str) -> list[bytes]:
    """Parts of a text that are encoded independently: words without the marks behind them, and those marks.

    The vocabulary is lower case, so A-Z go first, unless the text may name a special token.
    """
    data = text.encode("utf-8", "surrogatepass")
    if b"<|" not in data:
        data = data.lower()
    return _TAIL.sub(rb"\1 \2", data).split()


class WordTokenizer:
    """Ids of whole texts through a cache of words; for vocabularies in which white space separates independent parts."""

    def __init__(self, path: str, end: int = END) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.end = Tokenizer.from_file(path), end
        single = [(mark, ids[0]) for mark in _MARKS if len(ids := self._ids(mark)) == 1]
        self.mark, self.mark_id = single[0] if single else ("", None)
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, dtype="<u4")
        self.starts = np.zeros(1 << 14, dtype=np.int64)
        self.met = np.zeros(1 << 14, dtype=bool)
        self.used = 0

    def _evict(self) -> None:
        """Keeps the words met since the last eviction; if these alone fill the cache, those of them known longest."""
        words, starts, met = list(self.known), self.starts, self.met
        kept = np.flatnonzero(met[: len(words)])[: _CACHE // 2]
        lengths = starts[kept + 1] - starts[kept]
        ids = self.flat[ragged(starts[kept], lengths)]
        self._clear()
        self._add([words[k] for k in kept], ids, lengths)

    def _add(self, words: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        k = len(self.known)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while k + len(words) + 1 > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.starts[k + 1 : k + 1 + len(words)] = self.used + np.cumsum(lengths)
        self.known.update(zip(words, range(k, k + len(words)), strict=True))
        self.used += len(ids)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Words are encoded many at a time, with a mark between them that no other word has."""
        texts = [w.decode("utf-8", "surrogatepass") for w in words]
        if self.mark_id is not None and not any(self.mark in t for t in texts):
            ids = self._ids(" ".join(f"{t} {self.mark}" for t in texts))
            cuts = np.flatnonzero(ids == self.mark_id)
            if len(cuts) == len(words):
                self._add(words, ids[ids != self.mark_id], np.diff(cuts, prepend=-1) - 1)
                return
        for word, text in zip(words, texts, strict=True):
            ids = self._ids(text)
            self._add([word], ids, np.array([len(ids)]))

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text and the end id; words that are new in any of them are learned together."""
        parts = [_split(text) if text else [] for text in texts]
        words = list(chain.from_iterable(parts))
        if len(self.known) > _CACHE:
            self._evict()
        new = list(set(words).difference(self.known))
        for at in range(0, len(new), 2048):
            self._learn(new[at : at + 2048])
        places = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self.met[places] = True
        starts = self.starts[places]
        lengths = self.starts[places + 1] - starts
        ids = self.flat[ragged(starts, lengths)]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = upto[np.cumsum([len(p) for p in parts])]
        end = np.array([self.end], dtype="<u4")
        return [np.concatenate([ids[a:b], end]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the text and the end id."""
        return self.encode_all([text])[0]


def _batches(texts: pa.Array, size: int = 1 << 20) -> Iterator[list[str | None]]:
    """Texts in order, about ``size`` characters at a time."""
    some, held = [], 0
    for value in texts:
        some.append(value.as_py())
        held += len(some[-1] or "")
        if held >= size:
            yield some
            some, held = [], 0
    if some:
        yield some


@cache
def _tokenizer(path: str, end: int) -> WordTokenizer:
    """One per worker, with all the words it has met in earlier tasks."""
    return WordTokenizer(path, end)


def pieces(docs: DataFrame, *, path: str | None = None, length: int = LENGTH, end: int = END, doc_id="doc_id", text="text", ids: bool = False) -> DataFrame:
    """(doc_id, item, piece, start, length, ids_crc32[, ids]): the pieces of every document.

    ``item`` numbers the pieces; it is fixed once the result is written.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = _PIECE + (", ids array<long>" if ids else "")
    types = {"int": pa.int32(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    kinds = {name: types[kind] for name, kind in (column.split() for column in schema.split(", "))}
    names = list(kinds)

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path, end)
        item = TaskContext.get().partitionId() << 36
        for part in parts:
            rows: list[tuple] = []
            encoded = chain.from_iterable(map(tokenizer.encode_all, _batches(part.column(1))))
            for key, found in zip(part.column(0).to_pylist(), encoded, strict=True):
                for k, at in enumerate(range(0, len(found), length)):
                    own = found[at : at + length]
                    rows.append((key, item, k, at, len(own), zlib.crc32(own.tobytes()), *([own.astype(np.int64)] if ids else [])))
                    item += 1
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, kinds[n]) for n, c in zip(names, columns, strict=True)], names)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of every item, taken in the given order, and the number of bins.

    An item goes into the open bin with the least sufficient room, else into a new one. Bins are kept by their room.
    """
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rooms: list[int] = []  # rooms that some bin has, ascending
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    n = 0
    for k, size in enumerate(sizes.tolist()):
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            own = by_room[room].pop()
            if not by_room[room]:
                del rooms[at]
        else:
            room, own, n = length, n, n + 1
        bins[k], offsets[k] = own, length - room
        if rest := room - size:
            if not by_room[rest]:
                rooms.insert(bisect_left(rooms, rest), rest)
            by_room[rest].append(own)
    return bins, offsets, n


def _round(items: DataFrame, groups: int, turn: int, length: int) -> DataFrame:
    """(item, size) to (item, bin, offset, filled): one best-fit pass in each group. Bin ids are unique over rounds."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["size", "item"], ascending=[False, True], kind="stable").reset_index(drop=True)
        bins, offsets, n = best_fit(part["size"].to_numpy(), length)
        filled = np.bincount(bins, weights=part["size"], minlength=n).astype(np.int64)
        first = (turn << 50) + (int(part["group"].iloc[0]) << 32)
        return pd.DataFrame({"item": part["item"], "bin": first + bins, "offset": offsets, "filled": filled[bins]})

    dealt = items.withColumn("group", F.pmod(F.xxhash64("item", F.lit(turn)), F.lit(groups)))
    return dealt.groupBy("group").applyInPandas(pack, "item long, bin long, offset long, filled long")


def placed(cut: DataFrame, *, length: int = LENGTH, full: float = FULL, group: int = GROUP, least_groups: int = 16) -> DataFrame:
    """``cut`` (stored pieces) with ``sequence_id`` and ``offset``.

    The first round has ``least_groups`` groups at least, so that a small corpus is packed in parallel as well.
    """
    items = cut.select("item", F.col("length").alias("size"))
    count = items.count()
    groups = max(-(-count // group), min(least_groups, -(-count // 5000)), 1)
    out, idle = None, 0
    for turn in range(1 << 13):
        packed = stored(_round(items, groups, turn, length), "packing-round")
        if out is None:
            out = packed.select("item", F.col("bin").alias("sequence_id"), "offset")
        else:
            up = packed.select(F.col("item").alias("sequence_id"), "bin", F.col("offset").alias("base"))
            out = out.join(up, "sequence_id", "left").select(
                "item", F.coalesce("bin", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset")
            )
            if turn % 8 == 0:
                out = stored(out, "packing-places")
        items = packed.filter(F.col("filled") < int(full * length)).select(F.col("bin").alias("item"), F.col("filled").alias("size")).distinct()
        before, count = count, items.count()
        idle = 0 if turn == 0 or count < before else idle + 1
        if groups == 1 or idle == IDLE:
            break
        groups = max(1, -(-count // group))
    return cut.join(out, "item")


def pack(docs: DataFrame, *, path: str | None = None, length: int = LENGTH, end: int = END, ids: bool = False, **settings) -> DataFrame:
    """One row per piece with its place; ``ids=True`` adds the token ids."""
    cut = stored(pieces(docs, path=path, length=length, end=end, ids=ids), "packing-pieces")
    return placed(cut, length=length, **settings).drop("item")
