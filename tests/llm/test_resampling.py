"""Importance resampling against a plain version, with the interning table alone."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.compare import duck, compare
from transferlens.llm import queries, resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})
BUCKETS = 10_000


def features(text, low=1, high=1):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[k : k + n]) for n in range(low, high + 1) for k in range(len(words) - n + 1)]


def bucket(run):
    return zlib.crc32(run.encode("utf-8", "surrogatepass")) % BUCKETS


def brute(docs, target, ngrams=(1, 1), least=20, percent=10, seed=2024):
    s, t = [0] * BUCKETS, [0] * BUCKETS
    for counts, texts in ((s, [x for _, x in docs]), (t, target)):
        for text in texts:
            for run in features(text, *ngrams)[1]:
                counts[bucket(run)] += 1
    gains = [math.floor(1000 * math.log((b + 1) * (sum(s) + BUCKETS) / ((a + 1) * (sum(t) + BUCKETS)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for doc, text in docs:
        words, runs = features(text, *ngrams)
        weight = sum(gains[bucket(r)] for r in runs)
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        rows.append([doc, len(words), len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    eligible = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    for place, row in enumerate(eligible[: percent * len(eligible) // 100]):
        row[5] = place + 1
    return sorted(map(repr, rows))


def texts():
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "GAMMA", "x1", "日本", "é", "ÀB", "don't", "a_b", "z" * 40, "\x7f", "tok\x00en"]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) + rng.choice(["", "\n", "..", " "]) for _ in range(300)]


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 2), (2, 3)])
def test_equals_brute_force(spark, ngrams):
    bodies = texts()
    docs = [(k, t) for k, t in enumerate(bodies)] + [(7, bodies[7]), (7, bodies[7]), (None, bodies[20]), (None, None), (900, None), (901, ""), (902, "..")]
    target = [*bodies[:5], None, ""]
    frame = spark.createDataFrame([(*d, "clash", 5) for d in docs], "doc_id long, text string, score string, _place int").repartition(3)
    out = resampling.importance(frame, spark.createDataFrame([(t,) for t in target], "text string"), ngrams=ngrams)
    got = sorted(repr([r["doc_id"], r["n_words"], r["n_features"], r["weight"], r["score"], r["rank"]]) for r in out.collect())
    assert got == brute(docs, target, ngrams)


@pytest.mark.parametrize("ngrams", [(1, 1), (1, 3), (2, 2)])
def test_long_texts_are_cut_between_words(ngrams):
    text = " ".join(texts()) + " " + "w" * 5000 + " end " + "v" * 900
    words, runs = features(text, *ngrams)
    rows = list(resampling.interned([None, text, "", "one two three"], *ngrams, BUCKETS, chunk=700))
    assert len(rows) > 10
    counted = np.zeros((2, 4), dtype=int)
    held = np.zeros(BUCKETS, dtype=int)
    for table, at, n_words, n_grams in rows:
        np.add.at(counted[0], at, n_words)
        np.add.at(counted[1], at, n_grams)
        held += table.bucket_counts(BUCKETS)
    other = features("one two three", *ngrams)[1]
    assert counted.tolist() == [[0, len(words), 0, 3], [0, len(runs), 0, len(other)]]
    want = np.bincount([bucket(r) for r in runs + other], minlength=BUCKETS)
    assert (held == want).all()


def test_equal_hashes_are_told_apart_by_their_bytes(monkeypatch):
    grams = [b"a", b"b", b"a", b"c", b"b", b"a"]
    monkeypatch.setattr(resampling.xxhash, "xxh64_intdigest", lambda gram: 5)
    table = resampling.GramTable(grams, BUCKETS)
    assert [len(set(table.slot[[k for k, g in enumerate(grams) if g == w]])) for w in (b"a", b"b", b"c")] == [1, 1, 1]
    assert len(set(table.slot)) == 3 and sorted(table.count[table.used]) == [1, 2, 3]
    assert all(table.bucket[s] == zlib.crc32(g) % BUCKETS for s, g in zip(table.slot, grams, strict=True))


def test_no_documents_no_target(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.importance(none, none).collect() == []
    docs = [(k, "a b c d " * 6) for k in range(30)]
    out = resampling.importance(spark.createDataFrame(docs, "doc_id long, text string"), none).collect()
    assert sorted(repr([r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")]) for r in out) == brute(docs, [])


def test_resample_keeps_rows_and_columns(spark):
    bodies = texts()
    rows = [(k, t, "x", k) for k, t in enumerate(bodies)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string, drawn long")
    target = spark.createDataFrame([(bodies[0],)], "text string")
    ranked = {r["doc_id"] for r in resampling.importance(docs, target).filter("rank is not null").collect()}
    kept = resampling.resample(docs, target)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == ranked and ranked


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(spark, duck(folder), folder, "op13_importance_resampling", queries.QUERIES, queries.CHECKS) is None
