"""Language-model scores by context-tree weighting over bytes.

A text is the bytes of its lower-cased words, each closed by a space, and one end byte. A byte is eight binary decisions, so a
context of d bytes has up to 255 decision nodes. At every node of every context of 0 to ``depth`` bytes the
Krichevsky-Trofimov estimate (n1 + 1/2) / (n0 + n1 + 1) predicts the next bit, and context-tree weighting mixes all depths:
the weighted probability of a context is half its own block probability plus half the product over the contexts that extend
it. Scoring uses the conditional probabilities that follow from the trained weights along the path of contexts; it starts at the
deepest context in which the decision was seen. The code length of a byte is -log2 of its probability.

Counts: each task counts the grams of ``depth`` + 1 bytes of its training texts with numpy; they are dealt out by their hash, many
in a row, and added up over the whole corpus. No context is dropped, however rare. The tree is dealt out by the last ``SUFFIX``
bytes of the contexts: all that extend such a suffix are in one part. A first pass weighs each part from its leaves up to its
suffixes; the driver weighs what is above (contexts of up to ``SUFFIX`` bytes, so their number is bounded by the alphabet and not by
the corpus); a second pass carries these weights down each part and scores the distinct grams that the texts ask for. Texts are
dealt into blocks of about ``_BLOCK`` bytes; a block asks once for each of its grams and gets its own answers back.

The base score needs the exact count of every training word. Words with at least ``word_share`` of all tokens (at most 1 /
word_share of them) are broadcast; a text's other words leave the task as hashes and are joined with the counts of all words.

Defined cases: null and empty texts are the end alone. An empty training set gives a tree without counts (1/2 for each bit).
Repeated rows are scored and counted each. Rows without an id belong to the learning part. Words are told apart by a hash of 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import words_of
from transferlens.session import stored

DEPTH = 6
#: Bytes at the end of a context by which the tree is dealt out.
SUFFIX = 3
WORD_SHARE = 2e-7
END = b"\n"
#: Bytes that are scored at once, and rows that a task gathers before it adds them up.
_CHUNK = 1 << 20
_FLUSH = 1 << 20
#: Distinct grams and words that a counting task gathers: what it adds up itself is not shuffled.
_COUNTED = 5 << 19
_WORDS = 1 << 19
#: Bytes of text to each task that adds up counts, at most.
_DEALT = 16 << 20
#: Bytes of text in a block, and distinct grams in a part of the tree.
_BLOCK = 12 << 20
_PART = 1 << 18
#: Spreads the suffixes over the parts.
_SPREAD = 0x9E3779B1
#: An odd factor mixes grams one to one; its inverse gives them back.
_MIX = 0x9E3779B97F4A7C15
_UNMIX = pow(_MIX, -1, 1 << 64)
#: Hash of the end token; words hash to something else.
END_HASH = 0


@dataclass
class Level:
    """Contexts of one depth: known grams (context and next byte) with their log2 probability, and the decision nodes."""

    grams: np.ndarray
    bits: np.ndarray
    contexts: np.ndarray
    nodes: np.ndarray
    ones: np.ndarray  # probability that the next bit is 1 if at most 1/2, else minus that of a 0: single precision would round a rare bit away


def serialized(text: str | None, depth: int) -> bytes:
    """The bytes that are scored, behind ``depth`` end bytes as the first context."""
    return END * depth + b" ".join([*words_of(text), END])


def _mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


def _grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all texts, and where each text's begin."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    n, width, out = len(data) - depth, 1, data.astype(np.int64)
    while 2 * width <= depth + 1:  # windows of twice the width from two neighbours
        out = out[: len(out) - width] << 8 * width | out[width:]
        width *= 2
    rest = depth + 1 - width
    if rest:
        out = out[:n] << 8 * rest | out[rest : n + rest] & _mask(rest)
    starts = np.concatenate(([0], np.cumsum(lengths)))
    own = np.ones(n, dtype=bool)  # not the windows that reach from one text into the next
    for k in range(depth):
        own[starts[1:-1] - 1 - k] = False
    return out[own], np.concatenate(([0], np.cumsum(lengths - depth)))[:-1]


def _summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their counts."""
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def _merged(keys: np.ndarray, counts: np.ndarray, more: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two tables as by ``_summed`` as one. Uses up ``counts``."""
    if not len(keys) or not len(more):
        return (keys, counts) if len(keys) else (more, times)
    at = np.searchsorted(keys, more)
    hit = keys[np.minimum(at, len(keys) - 1)] == more
    counts[at[hit]] += times[hit]
    if hit.all():
        return keys, counts
    at, new = at[~hit], ~hit
    return np.insert(keys, at, more[new]), np.insert(counts, at, times[new])


def _planes(values: np.ndarray) -> bytes:
    """The lowest bytes of all values, then the next ones, up to the highest that is used: sorted values compress well so."""
    width = max(1, -(-int(values.view(np.uint64).max()).bit_length() // 8))
    return values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(planes: pa.Scalar, count: int) -> np.ndarray:
    own = np.frombuffer(planes.as_buffer(), dtype=np.uint8).reshape(-1, count)
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, : len(own)] = own.T
    return out.view(np.int64)[:, 0]


def count_grams(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    return _summed(_grams(texts, depth)[0]) if texts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def all_depths(grams: np.ndarray, counts: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(d, grams of d + 1 bytes, counts), from the deepest to the shallowest."""
    for d in range(depth, -1, -1):
        if d < depth:
            grams, counts = _summed(grams & _mask(d + 1), counts)
        yield d, grams, counts


def kept(grams: np.ndarray, counts: np.ndarray, floor: int) -> np.ndarray:
    """Which of the sorted grams belong to a context that is seen ``floor`` times."""
    contexts = grams >> 8
    first = np.flatnonzero(np.concatenate(([True], contexts[1:] != contexts[:-1]))) if len(grams) else np.zeros(0, np.int64)
    totals = np.add.reduceat(counts, first) if len(grams) else counts
    return np.repeat(totals >= floor, np.diff(np.append(first, len(grams))))


_SMALL = 1 << 12
_TABLE = np.array([0.0, *(math.lgamma(v / 2) for v in range(1, _SMALL))])


def _log_gamma(doubled: np.ndarray) -> np.ndarray:
    """log of gamma at half of each whole number: from a table, and by Stirling's series beyond it."""
    out = _TABLE[np.minimum(doubled, _SMALL - 1)]
    large = np.flatnonzero(doubled >= _SMALL)
    x = doubled[large] / 2
    out[large] = (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3)
    return out


def _block(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of a block with these counts."""
    return _log_gamma(2 * zeros + 1) + _log_gamma(2 * ones + 1) - math.log(math.pi) - _log_gamma(2 * (zeros + ones) + 2)


def _nodes(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Decision nodes (context and the bits so far behind a leading 1), ascending, and how often a 0 and a 1 followed."""
    keys, zeros, ones = [], [], []
    for k in range(8):
        before, bit = grams >> (8 - k), grams >> (7 - k) & 1
        first = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        total, up = np.add.reduceat(counts, first), np.add.reduceat(counts * bit, first)
        keys.append((before[first] >> k) << 8 | 1 << k | before[first] & ((1 << k) - 1))
        zeros.append(total - up)
        ones.append(up)
    key = np.concatenate(keys)
    order = np.argsort(key, kind="stable")
    return key[order], np.concatenate(zeros)[order], np.concatenate(ones)[order]


def _climb(tables: list[tuple[np.ndarray, np.ndarray]], top: int = 0, leaves: np.ndarray | None = None) -> tuple[list, list, list, list, np.ndarray]:
    """From the grams of each depth from ``top`` on (sorted, with counts): nodes, blocks, places of parents, log products over what
    extends a node, and the log weighted probabilities of the shallowest nodes. ``leaves`` are those of the deepest, if known."""
    nodes = [_nodes(g, c) for g, c in tables if len(g)]
    blocks = [_block(z, o) for _, z, o in nodes]
    above: list[np.ndarray] = []  # of each depth, the place of each node's parent
    for d in range(1, len(nodes)):
        parent = (nodes[d][0] >> 8 & _mask(top + d - 1)) << 8 | nodes[d][0] & 255
        above.append(np.searchsorted(nodes[d - 1][0], parent))
    weighted, children = blocks[-1] if nodes else np.zeros(0), [np.zeros(0)] * len(nodes)
    if leaves is not None:
        weighted = leaves
    for d in range(len(nodes) - 2, -1, -1):
        key, zeros, ones = nodes[d]
        size = len(key)
        rest = [x - np.bincount(above[d], weights=y, minlength=size).astype(np.int64) for x, y in ((zeros, nodes[d + 1][1]), (ones, nodes[d + 1][2]))]
        children[d] = np.bincount(above[d], weights=weighted, minlength=size) + _block(np.maximum(rest[0], 0), np.maximum(rest[1], 0))
        extended = np.bincount(above[d], minlength=size) > 0
        weighted = np.where(extended, np.logaddexp(blocks[d], children[d]) - math.log(2), blocks[d])
    return nodes, blocks, above, children, weighted


def _descend(
    tables: list[tuple[np.ndarray, np.ndarray]], nodes: list, blocks: list, above: list, children: list, entry: tuple[np.ndarray, np.ndarray] | None = None
) -> tuple[list[Level], tuple[np.ndarray, np.ndarray]]:
    """The levels, and what enters the deepest: the share left to each node, and the probability that its ancestors have given.
    ``entry`` is what enters the shallowest. Uses up the lists."""
    levels, share, base = [], *(entry or (None, None))
    enters = (np.ones(0), np.zeros(0))
    for d in range(len(nodes)):
        key, zeros, ones = nodes[d]
        own = (ones + 0.5) / (zeros + ones + 1)
        nodes[d] = zeros = ones = None
        if d:
            share, base = share[above[d - 1]], base[above[d - 1]]
            above[d - 1] = None
        elif share is None:
            share, base = np.ones(len(key)), np.zeros(len(key))
        enters = share, base
        result = base + share * own
        result = np.where(result > 0.5, result - 1, result).astype(np.float32)
        if d + 1 < len(children):
            ratio = np.exp(np.clip(blocks[d] - children[d], -700, 700))  # of the node itself against what extends it
            blocks[d] = children[d] = None
            base, share = base + share * own * ratio / (1 + ratio), share / (1 + ratio)
        grams = tables[d][0]
        bits = np.zeros(len(grams), dtype=np.float32)
        for k in range(8):
            node = (grams >> 8) << 8 | 1 << k | (grams & 255) >> (8 - k)
            p = result[np.searchsorted(key, node)]
            bits += np.log2(_probability(p, grams >> (7 - k) & 1))
        levels.append(Level(grams, bits, np.unique(grams >> 8), key, result))
    return levels, enters


def _probability(ones: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """Of this bit, from a ``Level``'s ``ones``; never 0."""
    least = np.float32(2.0**-120)
    own = np.maximum(np.abs(ones), least)
    return np.where((ones > 0) == (bit == 1), own, 1 - own)


def weigh(tables: list[tuple[np.ndarray, np.ndarray]]) -> list[Level]:
    """The tree from the grams of each depth 0.. (sorted, with counts)."""
    return _descend(tables, *_climb(tables)[:4])[0]


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return at, table[at] == keys


def gram_bits(levels: list[Level], grams: np.ndarray) -> np.ndarray:
    """log2 probability of the last byte of each gram given the bytes before it."""
    out = np.full(len(grams), -8.0)
    if not levels:
        return out
    left = np.arange(len(grams))
    for d in range(len(levels) - 1, -1, -1):
        if not len(left):
            break
        level, key = levels[d], grams[left] & _mask(d + 1)
        at, hit = _find(level.grams, key)
        out[left[hit]] = level.bits[at[hit]]
        left, key = left[~hit], key[~hit]
        known = _find(level.contexts, key >> 8)[1]
        if known.any():  # the context is kept, but this byte never followed it
            out[left[known]] = _by_bits(levels, d, grams[left[known]])
            left = left[~known]
    return out


def _by_bits(levels: list[Level], deepest: int, grams: np.ndarray) -> np.ndarray:
    """Bit by bit, each from the deepest context in which the decision was seen."""
    out = np.zeros(len(grams))
    for k in range(8):
        p, left = np.full(len(grams), 0.5), np.arange(len(grams))
        for d in range(deepest, -1, -1):
            own = grams[left]
            at, hit = _find(levels[d].nodes, (own >> 8 & _mask(d)) << 8 | 1 << k | (own & 255) >> (8 - k))
            p[left[hit]] = levels[d].ones[at[hit]]
            left = left[~hit]
        out += np.log2(_probability(p, grams >> (7 - k) & 1))
    return out


def text_bits(levels: list[Level], texts: list[bytes], depth: int) -> np.ndarray:
    """log2 probability of each serialized text, of at most 2 ** 24 bytes in all."""
    grams, starts = _grams(texts, depth)
    keys, lengths, place = _folded(grams)
    return _sums(gram_bits(levels, _unmixed(keys)), lengths, place, starts)


def _mixed(grams: np.ndarray) -> np.ndarray:
    return grams.view(np.uint64) * np.uint64(_MIX)


def _unmixed(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(_UNMIX)).view(np.int64)


def _folded(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal grams side by side: their mixed keys, nearly ascending (one may come twice), how many each stands for, and the places
    these come from. The keys' high bits are sorted with the place in the low ones, which costs one sort of whole numbers."""
    return _side_by_side(_mixed(grams))


def _side_by_side(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = np.uint64(max(1, (len(keys) - 1).bit_length()))
    tagged = keys >> low
    tagged <<= low
    tagged |= np.arange(len(keys), dtype=np.uint64)
    tagged.sort()
    tagged &= (np.uint64(1) << low) - np.uint64(1)
    place = tagged.astype(np.int32 if len(keys) < 1 << 31 else np.int64)
    del tagged
    keys = keys[place]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.diff(np.append(first, len(keys))).astype(np.int32), place


def _sums(bits: np.ndarray, lengths: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum over each text's grams, from the bits of the folded ones."""
    values = np.empty(len(place))
    values[place] = np.repeat(bits, lengths)
    return np.add.reduceat(values, starts)


def runs(texts: Iterable[bytes], depth: int, size: int = _CHUNK) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts in batches of about ``size`` bytes, with their places; a longer text comes in runs that overlap by a context."""
    rows: list[int] = []
    batch: list[bytes] = []
    total = 0
    for row, text in enumerate(texts):
        for at in range(0, max(1, len(text) - depth), size):
            run = text[at : at + size + depth]
            if batch and total + len(run) > size + depth:
                yield rows, batch
                rows, batch, total = [], [], 0
            rows.append(row)
            batch.append(run)
            total += len(run)
    if batch:
        yield rows, batch


#: Longest word, in bytes, that is hashed beside others.
_SHORT = 64
_LOWEST = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of 64 bits, never ``END_HASH``, of each word; 8 bytes more stand behind the last. Eight bytes at once are mixed one to
    one into what went before, so short words of one length never share a hash."""
    eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))
    out = lengths.astype(np.uint64) * np.uint64(_MIX)
    left = np.flatnonzero(lengths <= _SHORT)
    for at in range(0, _SHORT, 8):
        left = left[lengths[left] > at]
        if not len(left):
            break
        x = out[left] ^ eight[starts[left] + at] & _LOWEST[np.minimum(lengths[left] - at, 8)]
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x ^= x >> np.uint64(30)
            x *= np.uint64(factor)
        out[left] = x ^ x >> np.uint64(31)
    for k in np.flatnonzero(lengths > _SHORT):
        out[k] = xxhash.xxh64_intdigest(data[starts[k] : starts[k] + lengths[k]].tobytes())
    out[out == END_HASH] = 1
    return out


def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of serialized texts: the text and the code of each, and the hash behind each code (one may come twice)."""
    data = np.frombuffer(b"".join([*texts, bytes(8)]), dtype=np.uint8)
    breaks = np.flatnonzero((data == 32) | (data == END[0]))  # no word holds either, and a space closes each
    closed = np.flatnonzero(data[breaks] == 32)
    starts = breaks[closed - 1] + 1 if len(closed) else closed
    ends = breaks[closed]
    if len(closed) and not closed[0]:
        starts[0] = 0
    rows = np.searchsorted(np.cumsum([len(t) for t in texts]), ends, side="right")
    hashes, sizes, place = _side_by_side(_hashes(data, starts, ends - starts))
    codes = np.empty(len(place), dtype=np.int64)
    codes[place] = np.repeat(np.arange(len(hashes)), sizes)
    return rows, codes, hashes.view(np.int64)


def _some(texts: Iterable, depth: int, size: int = 4 * _CHUNK) -> Iterator[tuple[int, list[bytes]]]:
    """Serialized texts, about ``size`` bytes at once, and the place of the first."""
    batch: list[bytes] = []
    at = total = 0
    for text in texts:
        batch.append(serialized(text.as_py(), depth))
        total += len(batch[-1])
        if total > size:
            yield at, batch
            at, batch, total = at + len(batch), [], 0
    if batch:
        yield at, batch


def _distinct(keys: list[np.ndarray]) -> np.ndarray:
    key = np.concatenate(keys)
    key.sort()
    return key[np.concatenate(([True], key[1:] != key[:-1]))]


#: In a table of counts: depth of the rows that count words.
_WORD = -1


#: Counts on their way: the task that adds them up, their depth, how many they are, and ``_planes`` of grams and counts.
_PARTIAL = pa.schema([("part", pa.int32()), ("d", pa.int32()), ("k", pa.int32()), ("gram", pa.binary()), ("n", pa.binary())])


def text_bytes(docs: DataFrame, *, text: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0


def counted(docs: DataFrame, size: int, *, text: str = "text", depth: int = DEPTH) -> DataFrame:
    """(d, gram, n): grams of the full depth, words (d = -1, by hash) and ends, added up over all rows. ``size``: bytes of all texts."""
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / _DEALT))

    def frame(d: int, gram: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Ascending keys and their counts, a row for each task that is to add them up."""
        if not len(gram):
            return
        part = (_mixed(gram) >> np.uint64(32)) % np.uint64(tasks)
        order = np.argsort(part.astype(np.uint16) if tasks <= 1 << 16 else part, kind="stable")
        part, gram, n = part[order].astype(np.int32), gram[order], n[order]
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        last = np.append(first[1:], len(part))
        rows: list[tuple] = []
        held = 0
        for a, z in zip(first.tolist(), last.tolist(), strict=True):
            rows.append((part[a], d, z - a, _planes(gram[a:z]), _planes(n[a:z])))
            held += z - a
            if held > 250_000 or z == len(part):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARTIAL, strict=True)], schema=_PARTIAL)
                rows, held = [], 0

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        ends, grams, words = 0, (none, none), (none, none)
        for part in parts:
            ends += part.num_rows
            for _, texts in _some(part.column(0), depth):
                for _, batch in runs(texts, depth, 4 * _CHUNK):
                    grams = _merged(*grams, *count_grams(batch, depth))
                    if len(grams[0]) > _COUNTED:
                        yield from frame(depth, *grams)
                        grams = none, none
                _, codes, hashes = _coded(texts)
                words = _merged(*words, *_summed(hashes, np.bincount(codes, minlength=len(hashes))))
                if len(words[0]) > _WORDS:
                    yield from frame(_WORD, *words)
                    words = none, none
        yield from frame(depth, *grams)
        yield from frame(_WORD, *words)
        yield from frame(_WORD, np.array([END_HASH]), np.array([ends]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, dtype=np.int64)
        sums = {depth: (none, none), _WORD: (none, none)}
        held: dict[int, list] = {depth: [], _WORD: []}
        waiting = dict.fromkeys(held, 0)

        def fold(d: int) -> None:
            if held[d]:
                sums[d] = _merged(*sums[d], *_summed(*(np.concatenate(x) for x in zip(*held[d], strict=True))))
                held[d], waiting[d] = [], 0

        for batch in batches:
            for d, k, gram, n in zip(*(batch.column(c) for c in ("d", "k", "gram", "n")), strict=True):
                d, k = d.as_py(), k.as_py()
                held[d].append((_from_planes(gram, k), _from_planes(n, k)))
                waiting[d] += k
                if waiting[d] > max(_FLUSH // 4, len(sums[d][0]) // 2):
                    fold(d)
        for d in held:
            fold(d)
            key, n = sums.pop(d)
            key, n = key[n > 0], n[n > 0]
            for at in range(0, len(key), 250_000):
                some, times = key[at : at + 250_000], n[at : at + 250_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), d, np.int32)), pa.array(some), pa.array(times)], ["d", "gram", "n"])

    partial = docs.select(text).mapInArrow(count, "part int, d int, k int, gram binary, n binary")
    return partial.repartition(tasks, "part").mapInArrow(add, "d int, gram long, n long")


@dataclass
class Model:
    depth: int
    levels: list[Level]  # above the suffixes
    nodes: np.ndarray  # of the suffixes, ascending
    share: np.ndarray  # what enters these nodes from above
    base: np.ndarray
    parts: int
    tokens: int  # N
    distinct: int  # V
    words: np.ndarray  # hashes of the frequent words, ascending
    counts: np.ndarray


def _part_column(parts: int, top: int) -> Column:
    suffix = F.shiftright("gram", 8).bitwiseAND(F.lit(_mask(top)).cast("long"))
    return F.shiftright(suffix * F.lit(_SPREAD).cast("long"), 20) % F.lit(parts).cast("long")


def _part_numbers(grams: np.ndarray, parts: int, top: int) -> np.ndarray:
    return ((grams >> 8 & _mask(top)) * _SPREAD >> 20) % parts


def _part(batches: list[pa.RecordBatch], depth: int, top: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of the depths from ``top`` on, from those of the full depth."""
    if not batches:
        return []
    gram, n = (np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("gram", "n"))
    return [(g, c) for _, g, c in islice(all_depths(*_summed(gram, n), depth), depth - top + 1)][::-1]


def train(table: DataFrame, *, depth: int = DEPTH, word_share: float = WORD_SHARE) -> Model:
    """The model of a table of counts (stored)."""
    top = min(SUFFIX, depth)
    sums = table.groupBy("d").agg(F.sum("n").alias("n"), F.count("*").alias("k")).collect()
    totals = {r["d"]: (r["n"], r["k"]) for r in sums}
    tokens, distinct = totals.get(_WORD, (0, 0))
    parts = max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(totals.get(depth, (0, 0))[1] / _PART))

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _part([b for b in batches if b.num_rows], depth, top)
        if tables:
            nodes, _, _, _, weighted = _climb(tables, top)
            for key, n, value in ((nodes[0][0], np.zeros(len(weighted), np.int64), weighted), (*tables[0], np.zeros(len(tables[0][0])))):
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(value)], ["key", "n", "weighted"])

    deepest = table.filter(F.col("d") == depth).select("gram", "n")
    climbed = stored(deepest.repartition(parts, _part_column(parts, top)).mapInArrow(climb, "key long, n long, weighted double"), "ctw-roots")
    roots = climbed.filter(F.col("n") == 0).select(F.col("key").alias("node"), "weighted").toArrow()
    order = np.argsort(roots["node"].to_numpy(), kind="stable")
    found = climbed.filter(F.col("n") > 0).select("key", "n").toArrow()  # grams of the suffixes
    tables = [(g, c) for _, g, c in all_depths(*_summed(found["key"].to_numpy(), found["n"].to_numpy()), top)][::-1]
    nodes, blocks, above, children, _ = _climb(tables, 0, roots["weighted"].to_numpy()[order])
    levels, (share, base) = _descend(tables, nodes, blocks, above, children)
    least = max(1, math.ceil(word_share * tokens))
    words = table.filter((F.col("d") == _WORD) & ((F.col("n") >= least) | (F.col("gram") == END_HASH))).select("gram", "n").toArrow()
    hashes, counts = (words[c].to_numpy() for c in ("gram", "n"))
    by_hash = np.argsort(hashes, kind="stable")
    suffixes = roots["node"].to_numpy()[order]
    return Model(depth, levels[:top], suffixes, share, base, parts, int(tokens), int(distinct), hashes[by_hash], counts[by_hash])


_SCORED = "row long, doc_id long, n_bytes long, n_tokens long, n_known long, known_score double, bits double, rare array<long>, rare_n array<long>"


def scored(docs: DataFrame, size: int, model: Model, table: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, n_known, base_score, score, bits_per_byte) of every row; the scores are log10 probabilities."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    log_all = math.log10(model.tokens + model.distinct + 1)
    depth, top = model.depth, min(SUFFIX, model.depth)
    blocks = max(1, math.ceil(size / _BLOCK))
    parts = max(model.parts, 4 * blocks)

    def dealt_out(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order that puts a block's distinct grams, ascending, part by part, and the parts in that order."""
        part = _part_numbers(gram, parts, top).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        order = np.argsort(part, kind="stable")
        return order, part[order].astype(np.int64)

    def ask(rows: pa.Table) -> pa.Table:
        grams, held = [], 0
        for _, batch in runs((serialized(t.as_py(), depth) for t in rows["text"]), depth):
            grams.append(count_grams(batch, depth)[0])
            held += len(grams[-1])
            if held > 2 * _FLUSH:
                grams, held = [_distinct(grams)], 0
        gram = _distinct(grams)
        order, part = dealt_out(gram)
        first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        asked = [g.tobytes() for g in np.split(gram[order], first[1:])]
        block = np.full(len(first), rows["block"][0].as_py(), np.int64)
        return pa.table({"part": part[first], "block": block, "grams": pa.array(asked, pa.binary())})

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, tree, levels = shared.value, [], None

        def grown() -> list[Level]:
            tables = _part(tree, depth, top)
            if not tables:
                return own.levels
            climbed = _climb(tables, top)[:4]
            at = np.searchsorted(own.nodes, climbed[0][0][0])
            return own.levels + _descend(tables, *climbed, (own.share[at], own.base[at]))[0]

        for batch in batches:  # ascending by block, the tree's rows have -1
            first = int(np.searchsorted(batch.column("block").to_numpy(), 0))
            if first:
                tree.append(batch.slice(0, first))
            if first == batch.num_rows:
                continue
            if levels is None:
                levels = grown()
                tree.clear()
            rows = batch.slice(first)
            grams = [np.frombuffer(g.as_buffer(), dtype=np.int64) for g in rows.column("grams")]
            keys, lengths, place = _folded(np.concatenate(grams))
            distinct = _unmixed(keys)
            order = np.argsort(distinct)
            found = np.empty(len(distinct), dtype=np.float32)
            found[order] = gram_bits(levels, distinct[order])
            bits = np.empty(len(place), dtype=np.float32)
            bits[place] = np.repeat(found, lengths)
            bits = [x.tobytes() for x in np.split(bits, np.cumsum([len(g) for g in grams])[:-1])]
            yield pa.RecordBatch.from_arrays([rows.column("part"), rows.column("block"), pa.array(bits, pa.binary())], ["part", "block", "bits"])

    def score(part: pa.Table, answers: pa.Table) -> pa.Table:
        own, count = shared.value, len(part)
        logs = np.log10(own.counts + 1.0)
        end = _find(own.words, np.array([END_HASH])) if len(own.words) else (0, False)
        tokens = np.ones(count, dtype=np.int64)
        known, total = np.full(count, int(np.sum(end[1]))), np.full(count, float(np.sum(logs[end[0]])) if np.sum(end[1]) else 0.0)
        rest = []  # the other words, by text and hash
        folded, bits, sizes = [], np.zeros(count), np.zeros(count, dtype=np.int64)
        for at, texts in _some(part["text"], depth):
            for rows, batch in runs(texts, depth):
                grams, starts = _grams(batch, depth)
                rows = np.array(rows) + at
                folded.append((rows, starts, *_folded(grams)))
                np.add.at(sizes, rows, [len(t) - depth for t in batch])
                del grams, batch
            rows, codes, hashes = _coded(texts)
            rows += at
            hit, weight = np.zeros(len(hashes), dtype=bool), np.zeros(len(hashes))
            if len(own.words):
                known_at, hit = _find(own.words, hashes)
                weight = np.where(hit, logs[known_at], 0.0)
            tokens += np.bincount(rows, minlength=count)
            known += np.bincount(rows, weights=hit[codes], minlength=count).astype(np.int64)
            total += np.bincount(rows, weights=weight[codes], minlength=count)
            missed = np.flatnonzero(~hit[codes])
            rest.append((rows[missed], hashes[codes[missed]]))
        row, word = (np.concatenate(x) for x in zip(*rest, strict=True))
        by_text = np.lexsort((word, row))
        row, word = row[by_text], word[by_text]
        first = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (word[1:] != word[:-1])))) if len(row) else np.zeros(0, dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=count)))).astype(np.int32)
        lists = [pa.ListArray.from_arrays(ends, x) for x in (word[first], np.diff(np.append(first, len(row))))]
        key = _distinct([f[2] for f in folded])
        gram = _unmixed(key)
        ascending = np.argsort(gram)
        order = ascending[dealt_out(gram[ascending])[0]]
        value = np.empty(len(key), dtype=np.float32)
        answers = answers.sort_by("part")
        value[order] = np.concatenate([np.frombuffer(b.as_buffer(), dtype=np.float32) for b in answers["bits"]])
        del gram, ascending, order
        while folded:
            rows, starts, keys, lengths, place = folded.pop()
            np.add.at(bits, rows, _sums(value[np.searchsorted(key, keys)], lengths, place, starts))
        place = (part["block"][0].as_py() << 36) + np.arange(count)
        columns = [pa.array(place), part["doc_id"], *map(pa.array, (sizes, tokens, known, total, bits)), *lists]
        return pa.table(columns, names=[c.split()[0] for c in _SCORED.split(", ")])

    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    own = own.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("long"))
    asked = own.groupBy("block").applyInArrow(ask, "part long, block long, grams binary")
    tree = table.filter(F.col("d") == depth).select(_part_column(parts, top).alias("part"), F.lit(-1).cast("long").alias("block"), "gram", "n")
    dealt = tree.unionByName(asked, allowMissingColumns=True).repartition(parts, "part").sortWithinPartitions("block")
    answered = dealt.mapInArrow(answer, "part long, block long, bits binary")
    rows = own.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(score, _SCORED)
    rows = stored(rows, "ctw-scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("one")).select("row", F.col("one.rare").alias("gram"), F.col("one.rare_n").alias("times"))
    vocabulary = table.filter(F.col("d") == _WORD).select("gram", "n")
    sums = rare.join(vocabulary, "gram").groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_score")
    )
    base = F.col("known_score") + F.coalesce("rare_score", F.lit(0.0)) - F.col("n_tokens") * F.lit(log_all)
    return rows.join(sums, "row", "left").select(
        "doc_id",
        "n_bytes",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        base.alias("base_score"),
        (F.col("bits") * math.log10(2)).alias("score"),
        (-F.col("bits") / F.col("n_bytes")).alias("bits_per_byte"),
    )


def language_model_scores(docs: DataFrame, learn, *, doc_id: str = "doc_id", text: str = "text", depth: int = DEPTH, **shares) -> tuple[DataFrame, Model]:
    """Scores of all rows by a model of the rows for which ``learn`` holds."""
    size = text_bytes(docs, text=text)
    table = stored(counted(docs.filter(learn), size, text=text, depth=depth), "ctw-counts")
    model = train(table, depth=depth, **shares)
    return scored(docs, size, model, table, doc_id=doc_id, text=text), model
