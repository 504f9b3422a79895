"""SimHash near-duplicates by anchor-point covering.

A fingerprint is 64 bits, a link is a distance of at most ``max_distance`` bits. Anchors are the codewords of a covering
code: two perfect binary Golay codes side by side on 46 of the bits. A Golay code of 23 bits has covering radius 3, so
every 23-bit block has exactly one codeword within 3 bits: the product of both is the fingerprint's home anchor. If two
fingerprints differ by ``t`` bits, of which ``a`` lie in the first block and ``b`` in the second, then the home of one lies
within 3 + a and 3 + b bits of the other. So it is enough to replicate each fingerprint to the anchors within those radii,
for all a + b <= t (about 61 anchors for t = 2), and to compare per anchor its residents with its visitors.

Equal fingerprints are one before anything is replicated. An anchor with more than ``HOT`` residents is not compared pair
by pair: two fingerprints are within 2s bits exactly if some point lies within s bits of both, so its visitors are
replicated to all points within s bits (65 for s = 1) and each point links its few visitors to the smallest one. The work
stays linear in the size of such a group, and no link between components is lost.

Defined cases: null and empty texts, and texts without a word, have fingerprint zero and are linked like all others. Fewer
words than a shingle form one shingle. Repeated rows share a component. Rows without an id take part, but an id-less
group has no component id. Extra columns do not matter: only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import ragged, unused, whole, words_of
from transferlens.session import stored

BLOCK = 23
RADIUS = 3
# Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEED = 42
#: Residents up to which an anchor compares all of them with its visitors.
HOT = 64
_STEP = 1 << 15


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Bit i is set if it is set in over half of the XXH64 values of the text's shingles; as a signed 64-bit number."""
    words = words_of(text)
    if not words:
        return 0
    spans = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else [b" ".join(words)]
    digests = [xxhash.xxh64_digest(s, SEED) for s in spans]
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(digests), _STEP):
        octets = np.frombuffer(b"".join(digests[at : at + _STEP]), dtype=np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(digests)).view(">i8")[0])


def with_fingerprint(df: DataFrame, name: str = "fingerprint", text: str = "text", shingle: int = 3) -> DataFrame:
    @F.arrow_udf("long")
    def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:  # one text at a time becomes a Python object
            yield pa.array((fingerprint(t.as_py(), shingle) for t in part), pa.int64())

    return df.withColumn(name, fingerprints(F.col(text)))


def fingerprint_text(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _remainder(block: np.ndarray) -> np.ndarray:
    """Syndrome: the block modulo the generator."""
    for bit in range(BLOCK - 1, 10, -1):
        block = np.where(block >> bit & 1, block ^ (GENERATOR << (bit - 11)), block)
    return block


@cache
def _offsets(extra: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each syndrome the differences to all codewords within RADIUS + extra bits, nearest first.

    Returns the differences, where each syndrome's begin, and how many there are up to each extra radius.
    """
    bits = [[sum(at) for at in combinations([1 << k for k in range(BLOCK)], n)] for n in range(RADIUS + extra + 1)]
    blocks = np.sort(np.concatenate([np.array(b, dtype=np.int32) for b in bits]))  # not all 2**BLOCK are laid out to find them
    weight = np.bitwise_count(blocks)
    syndrome, over = _remainder(blocks), np.maximum(weight.astype(np.int64) - RADIUS, 0)
    order = np.lexsort((blocks, over, syndrome))
    syndrome, over = syndrome[order], over[order]
    starts = np.searchsorted(syndrome, np.arange(1 << 11))
    upto = np.stack([np.bincount(syndrome[over <= e], minlength=1 << 11) for e in range(extra + 1)])
    return blocks[order].astype(np.int64), starts, upto


def anchors(prints: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
    """All anchors that the fingerprints visit when they differ by up to ``extra`` bits: (row of the fingerprint, anchor)."""
    bits = prints.view(np.uint64)
    sides = [((bits >> np.uint64(k * BLOCK)) & np.uint64((1 << BLOCK) - 1)).astype(np.int64) for k in (0, 1)]
    differences, starts, upto = _offsets(extra)
    left, right = (_remainder(side) for side in sides)
    rows, found = [], []
    for e in range(extra + 1):  # exactly e bits more than the radius on the left, up to extra - e on the right
        skip = upto[e - 1][left] if e else np.zeros(len(left), dtype=np.int64)
        n_left = upto[e][left] - skip
        row = np.repeat(np.arange(len(prints)), n_left)
        word = sides[0][row] ^ differences[ragged(starts[left] + skip, n_left)]
        n_right = upto[extra - e][right][row]
        other = differences[ragged(starts[right][row], n_right)]
        row, word = np.repeat(row, n_right), np.repeat(word, n_right)
        rows.append(row)
        found.append(word << BLOCK | (sides[1][row] ^ other))
    return np.concatenate(rows), np.concatenate(found)


def _at_anchors(prints: DataFrame, extra: int) -> DataFrame:
    """(anchor, print): each fingerprint at its home (extra 0) or at all anchors it visits."""

    def replicate(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            values = part["print"].to_numpy()
            for at in range(0, len(values), 4096):
                rows, found = anchors(values[at : at + 4096], extra)
                yield pd.DataFrame({"anchor": found, "print": values[at : at + 4096][rows]})

    return prints.mapInPandas(replicate, "anchor long, print long")


def links(prints: DataFrame, max_distance: int = 2, hot: int = HOT) -> DataFrame:
    """(a, b) with a > b: links that connect all distinct fingerprints within ``max_distance`` bits of each other.

    ``prints`` has one distinct column ``print``. Pairs of a hot anchor are given as stars, all others as they are.
    """
    homes = stored(_at_anchors(prints, 0), "simhash-homes")
    visits = _at_anchors(prints, max_distance)
    residents = homes.groupBy("anchor").count()
    calm = homes.join(residents.filter(F.col("count") <= hot).select("anchor"), "anchor", "left_semi")
    near = (
        calm.withColumnRenamed("print", "b")
        .join(visits.withColumnRenamed("print", "a"), "anchor")
        .filter((F.col("a") > F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance))
        .select("a", "b")
    )
    crowded = residents.filter(F.col("count") > hot).select("anchor")
    busy = visits.join(crowded, "anchor", "left_semi").select("print").distinct()
    return near.unionByName(_stars(busy, max_distance))


def _stars(prints: DataFrame, max_distance: int) -> DataFrame:
    """Links of distinct fingerprints through the points halfway between them; for odd distances checked one by one."""
    half = (max_distance + 1) // 2
    flips = [0]
    for _ in range(half):
        flips = sorted({f ^ (1 << bit) for f in flips for bit in range(64)} | set(flips))
    signed = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    points = prints.select("print", F.explode(F.array(*[F.col("print").bitwiseXOR(F.lit(f)) for f in signed])).alias("point"))
    if max_distance % 2 == 0:
        low = points.groupBy("point").agg(F.collect_set("print").alias("prints")).filter(F.size("prints") > 1)
        pairs = low.select(F.explode("prints").alias("a"), F.array_min("prints").alias("b"))
        return pairs.filter(F.col("a") > F.col("b")).distinct()
    other = points.withColumnRenamed("print", "b")
    pairs = points.withColumnRenamed("print", "a").join(other, "point").filter(F.col("a") > F.col("b"))
    return pairs.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance).select("a", "b").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a, b) reaches, by alternating stars.

    Every round hangs the larger neighbours of a node, then its smaller ones, on the smallest of them; each round is
    written to the shared folder. It ends when a round changes nothing. Minima are combined before they are shuffled.
    """
    edges = stored(edges.select("a", "b").distinct(), "simhash-edges")
    mark = _mark(edges)
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").filter(F.col("b") > F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = stored(small.unionByName(least.withColumnRenamed("least", "b")).distinct(), "simhash-edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"no fixed point after {rounds} rounds")


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes, to see whether two sets of links are the same."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def near_duplicates(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2, hot: int = HOT
) -> DataFrame:
    """One row (doc_id, text_hash, print, root, component_id) per row of ``docs``.

    ``component_id`` is the smallest id reachable over links; ``root``, a fingerprint, tells components apart also where none has an id.
    """
    ids = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("text_hash"), F.col(text).alias("text"))
    prints = stored(with_fingerprint(ids, "print", "text", shingle).select("doc_id", "text_hash", "print"), "simhash-prints")
    groups = prints.groupBy("print").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(groups.select("print"), max_distance, hot))
    rooted = groups.join(roots.withColumnRenamed("node", "print"), "print", "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(rooted.join(lowest, "root").select("print", "root", "component_id"), "print", "left")


def one_of_each(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """One row of ``docs`` for each component, columns as they came, whatever their names.

    It is the row with the smallest id, of rows with equal ids that with the smallest hash of its text; rows without an id come last.
    Of rows equal in id and text one stays.
    """
    found = near_duplicates(docs, doc_id=doc_id, text=text, **settings)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    key = unused(docs, "_row")
    first = found.groupBy("root").agg(F.min(place).alias("first")).select(F.struct("first.doc_id", "first.text_hash").alias(key)).distinct()
    keyed = docs.withColumn(key, F.struct(F.col(f"`{doc_id}`").alias("doc_id"), F.xxhash64(whole(F.col(f"`{text}`"))).alias("text_hash")))
    # both steps are by the key, so texts are shuffled once
    return keyed.join(first, key, "left_semi").dropDuplicates([key]).drop(key)
