import itertools
import tracemalloc

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from transferlens.llm import simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    spans = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def signed(value):
    return value - (1 << 64) if value >= 1 << 63 else value


def brute_components(prints, distance):
    """Smallest index reachable over links."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(prints)), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= distance:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", None, "one", "Two Words", "a b c", "a b c d " * 40, "é ß a b  c", "x\x0by\x1cz   w"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == signed(brute_print(text))


def test_fingerprint_is_sparks_hash(spark):
    value = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert simhash.fingerprint("A b C") == value


def test_every_near_pair_meets_at_a_home():
    rng = np.random.default_rng(3)
    left = rng.integers(-(1 << 63), 1 << 63, 400, dtype=np.int64)
    right = left.copy()
    for k in range(len(right)):
        for bit in rng.choice(64, rng.integers(0, 3), replace=False):
            right[k] ^= np.int64(signed(1 << int(bit)))
    rows, home = simhash.anchors(left, 0)
    assert list(rows) == list(range(len(left)))  # a perfect code: exactly one home
    rows, visits = simhash.anchors(right, 2)
    seen = set(zip(rows.tolist(), visits.tolist(), strict=True))
    assert all((k, int(h)) in seen for k, h in enumerate(home))
    assert len(seen) == len(rows)


@pytest.mark.parametrize("hot", [64, 1])
@pytest.mark.parametrize("distance", [1, 2, 3])
def test_components_equal_brute_force(spark, distance, hot):
    rng = np.random.default_rng(5)
    prints = []
    for _ in range(6):  # clouds around centres, so that chains and hot anchors occur
        centre = int(rng.integers(0, 1 << 63))
        for _ in range(25):
            value = centre
            for bit in rng.choice(64, rng.integers(0, 4), replace=False):
                value ^= 1 << int(bit)
            prints.append(value)
    prints += [0, 0, 1, 3]
    distinct = sorted(set(prints))
    frame = spark.createDataFrame([(signed(p),) for p in distinct], "print long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(frame, distance, hot)).collect()}
    got = [roots.get(signed(p), signed(p)) for p in distinct]
    want = brute_components(distinct, distance)
    groups = {}
    for g, w in zip(got, want, strict=True):
        groups.setdefault(w, set()).add(g)
    assert all(len(g) == 1 for g in groups.values()) and len(set(got)) == len(groups)


TEXTS = [
    (7, "the quick brown fox jumps over the lazy dog again and again " * 5),
    (3, "the quick brown fox jumps over the lazy dog again and again " * 5),
    (3, "the quick brown fox jumps over the lazy dog again and again " * 5),
    (9, None),
    (8, ""),
    (None, " \n "),
    (5, "something else entirely with other words in it and no copy anywhere"),
]


def test_near_duplicates_with_nulls_ties_and_repeats(spark):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in TEXTS], "doc_id long, text string, print string, anchor int")
    rows = [(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(rows, key=key) == sorted([(7, 3), (3, 3), (3, 3), (9, 8), (8, 8), (None, 8), (5, 5)], key=key)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 5, 8]


def test_one_row_of_an_idless_group_stays(spark):
    docs = spark.createDataFrame([(None, "only words without an id here"), (None, "only words without an id here"), (1, "x")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in simhash.one_of_each(docs).collect()) == ["1", "None"]


@pytest.mark.parametrize("order", [1, -1])
def test_equal_ids_with_other_texts_lose_no_component(spark, order):
    a, b, c = ("%s words of a text that no other text shares with it at all" % w for w in ("one two", "red blue green", "left right up down"))
    rows = [(1, a), (2, b), (2, c), (3, b), (7, None), (7, "mail me at someone please whenever you like to"), (None, c), (None, "alone without id " * 4)][::order]
    names = "doc_id long, text string, _row string, _row_ string, print string, root string, text_hash string, first string"
    docs = spark.createDataFrame([(*r, *"xyzuvw") for r in rows], names).repartition(3)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert found == sorted([(1, a), (2, b), (2, c), (7, None), (7, rows[5 if order == 1 else 2][1]), (None, "alone without id " * 4)], key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_offsets_are_made_without_all_blocks():
    tracemalloc.start()
    blocks, starts, upto = simhash._offsets.__wrapped__(2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(blocks) == sum(map(len, (list(itertools.combinations(range(simhash.BLOCK), n)) for n in range(simhash.RADIUS + 3))))
    assert peak < 8e6  # 2**23 blocks of four bytes are 34 MB
