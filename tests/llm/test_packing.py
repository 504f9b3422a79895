import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from transferlens.llm import packing

TEXTS = [
    "",
    None,
    "Hello WORLD, it's 2024!",
    "café café ß ﬁ İ ΣΣ",
    "a<|endoftext|>b <|startoftext|> c",
    "tab\tnew\nline\x0bv\x0cf\x1cs\x85n x y",
    "word " * 9000,
    "x" * 30_000,
    " ́combining after space",
    "\U0001f600\U0001f468‍\U0001f469 mixed 你好",
]


@pytest.fixture(scope="module")
def whole_text():
    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_word_cache_equals_whole_text_encoding(whole_text):
    own = packing.WordTokenizer(public_tokenizers.path(packing.VOCABULARY))
    for text in TEXTS * 2:
        assert own.encode(text).tolist() == [*whole_text.encode(text or "", add_special_tokens=False).ids, 1]


def test_best_fit_equals_a_plain_one():
    rng = random.Random(2)
    sizes = [rng.randint(1, 100) for _ in range(400)]
    rooms, want = [], []
    for size in sizes:
        fits = [(room, k) for k, room in enumerate(rooms) if room >= size]
        if fits:
            least = min(fits)[0]
            want.append(least)
            rooms[next(k for r, k in fits if r == least)] -= size
        else:
            want.append(100)
            rooms.append(100 - size)
    bins, offsets, n = packing.best_fit(np.array(sizes), 100)
    assert [100 - o for o in offsets] == want and n == len(rooms)


@pytest.mark.parametrize("groups", [1, 6])
def test_packing_is_gapless_whole_and_tight(spark, whole_text, groups):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choices(["alpha", "beta", "gammadelta", "omega!"], k=rng.randint(0, 300))) for _ in range(150)]
    rows = [(k, t, "clash", k) for k, t in enumerate(texts)] + [(3, TEXTS[2], "again", 0), (None, "no id", "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string, item long")
    settings = {"length": 256, "group": 400 if groups == 1 else 30, "least_groups": groups}
    out = [r.asDict() for r in packing.pack(docs, ids=True, **settings).collect()]
    by_text = {}
    for r in out:
        assert 0 < r["length"] <= 256 and len(r["ids"]) == r["length"]
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        by_text.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["ids"]))
    for key, text, *_ in rows[: len(texts)]:
        if key == 3:
            continue  # an id with two texts
        ids = [*whole_text.encode(text or "", add_special_tokens=False).ids, 1]
        parts = sorted(by_text[key])
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert sum((i for _, _, i in parts), []) == ids and all(s == 256 * p for p, s, _ in parts)
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 256
    least = -(-sum(r["length"] for r in out) // 256)
    assert len(bins) <= 1.04 * least + 1


def test_evicted_words_are_encoded_again(whole_text, monkeypatch):
    monkeypatch.setattr(packing, "_CACHE", 40)
    own, rng = packing.WordTokenizer(public_tokenizers.path(packing.VOCABULARY)), random.Random(8)
    evictions = []
    monkeypatch.setattr(packing.WordTokenizer, "_evict", lambda self, f=packing.WordTokenizer._evict: (evictions.append(len(self.known)), f(self)))
    for _ in range(60):
        text = " ".join(["the", "of", *("".join(rng.choices("abcdefg", k=rng.randint(1, 4))) for _ in range(25))])
        assert own.encode(text).tolist() == [*whole_text.encode(text, add_special_tokens=False).ids, 1]
    assert len(evictions) > 3 and len(own.known) < 40 + 27 and b"the" in own.known


def test_a_worker_keeps_its_tokenizer():
    path = public_tokenizers.path(packing.VOCABULARY)
    assert packing._tokenizer(path, 1) is packing._tokenizer(path, 1)


def test_merging_goes_on_over_rounds_that_merge_little(spark):
    """Bins of 51 and 49 parts meet only when they are dealt to one group, so a round merges few of them."""
    cut = spark.range(600).selectExpr("id as doc_id", "id as item", "0 as piece", "0L as start", "IF(id % 100 = 0, 45L, 55L) as length", "1L as ids_crc32")
    out = packing.placed(cut, length=100, group=50, least_groups=12)
    assert out.select("sequence_id").distinct().count() == 594
    assert out.count() == 600 and out.select("item").distinct().count() == 600


def test_items_that_never_fit_together_end(spark):
    cut = spark.range(500).selectExpr("id as doc_id", "id as item", "0 as piece", "0L as start", "60L as length", "1L as ids_crc32")
    out = packing.placed(cut, length=100, group=40, least_groups=4)
    assert out.select("sequence_id").distinct().count() == 500


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs).count() == 0
