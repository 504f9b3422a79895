import random
import re

from transferlens.llm import decontamination as D


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def brute(docs, items):
    """Windows of 12 tokens (or the whole item of 10 or 11) with at most 2 differing tokens."""
    out = {}
    for key, text in docs:
        d = words(text)
        for item, body in items:
            t = words(body)
            if len(t) < 10:
                continue
            n = min(12, len(t))
            least = 10 if n == 12 else -(-n * 10 // 12)
            found = {
                (a, sum(x == y for x, y in zip(d[a : a + n], t[b : b + n], strict=True)))
                for a in range(len(d) - n + 1)
                for b in range(len(t) - n + 1)
            }
            found = {f for f in found if f[1] >= least}
            if found:
                out[key, item] = (len(found), min(f[0] for f in found), max(f[1] for f in found))
    return out


def vocabulary(rng, n):
    return [rng.choice("abcdefgh") + str(k) for k in range(n)]


def cases():
    rng = random.Random(11)
    pool = vocabulary(rng, 400)
    items = [(k, " ".join(rng.choices(pool, k=rng.choice([5, 9, 10, 11, 12, 20, 40])))) for k in range(30)] + [(99, None), (98, "")]
    docs = [(-1, None), (-2, ""), (-3, "short text"), (-4, items[0][1])]
    for k in range(60):
        body = rng.choices(pool, k=rng.randint(0, 60))
        if k % 2:
            passage = (words(rng.choice(items)[1]) or ["z"])[:]
            for at in rng.sample(range(len(passage)), min(len(passage), rng.randint(0, 3))):
                passage[at] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = [w.upper() + rng.choice(["", "!!", ","]) for w in passage]
        docs.append((k, " ".join(body)))
    return docs, items


def test_overlaps_equal_brute_force(spark):
    docs, items = cases()
    frame = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    for limit in (D.BROADCAST, -1):  # broadcast and shuffled
        D.BROADCAST, before = limit, D.BROADCAST
        try:
            rows = D.overlaps(frame, bench).collect()
        finally:
            D.BROADCAST = before
        assert {(r["doc_id"], r["item_id"]): (r["n_windows"], r["first_token"], r["matched_tokens"]) for r in rows} == want
    bad = {d for d, _ in want}
    kept = D.clean(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in bad)
    assert len(want) > 10


def test_one_substitution_anywhere_in_an_item_of_ten_tokens(spark):
    item = [f"w{k}" for k in range(10)]
    items = [(1, " ".join(item)), (2, " ".join(f"v{k}" for k in range(20)))]
    docs = [(k, " ".join(["before", *item[:k], "changed", *item[k + 1 :], "after"])) for k in range(10)]
    rows = D.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]): (r["n_windows"], r["first_token"], r["matched_tokens"]) for r in rows} == want and len(want) == 10


def test_repeated_rows_null_ids_and_empty_tables(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    bench = spark.createDataFrame([(1, item), (1, item), (2, item)], "item_id long, text string")
    docs = spark.createDataFrame([(5, item), (5, item), (5, "clean"), (None, item), (6, None)], "doc_id long, text string")
    rows = {(r["doc_id"], tuple(r["item_ids"])) for r in D.contaminated(docs, bench).collect()}
    assert rows == {(5, (1, 2)), (None, (1, 2))}
    assert sorted(str(r["text"]) for r in D.clean(docs, bench).collect()) == ["None", "clean"]
    assert D.clean(docs.limit(0), bench).count() == 0
    assert D.clean(docs, bench.limit(0)).count() == 5


def test_benchmark_hashes_alone_keep_the_hits(spark, monkeypatch):
    docs, items = cases()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items + items[:10], "item_id long, text string")
    want = brute(docs, items)
    monkeypatch.setattr(D, "BROADCAST", -1)
    for limit in (D.BROADCAST_HASHES, 0):  # hashes broadcast, and all placements shuffled
        monkeypatch.setattr(D, "BROADCAST_HASHES", limit)
        found = D.overlaps(frame, bench)
        assert {(r["doc_id"], r["item_id"]): (r["n_windows"], r["first_token"], r["matched_tokens"]) for r in found.collect()} == want
        assert ("LeftSemi" in found._jdf.queryExecution().toString()) == bool(limit)


def test_clean_seeks_equal_items_once(spark):
    passage = " ".join(f"w{k}" for k in range(15))
    docs = spark.createDataFrame([(k, f"d{k} {passage}") for k in range(40)] + [(99, "nothing of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, passage) for k in range(40)], "item_id long, text string")
    assert [r["doc_id"] for r in D.clean(docs, bench).collect()] == [99]
    assert {len(r["item_ids"]) for r in D.contaminated(docs, bench).collect()} == {40}


def runs_of(item, doc):
    return [k for k in range(len(doc) - len(item) + 1) if doc[k : k + len(item)] == item]


def test_short_items_are_found_whole(spark, monkeypatch):
    docs, items = cases()
    rng = random.Random(5)
    items = items + [(200 + n, " ".join(f"s{n}x{k}" for k in range(n))) for n in range(3, 10)]
    for n in range(3, 10):
        run = [f"s{n}x{k}" for k in range(n)]
        docs += [(1000 + n, " ".join(["a", *run, "b", *run])), (2000 + n, " ".join(run)), (3000 + n, " ".join([*run[:-1], "other", "b"]))]
        docs.append((4000 + n, " ".join(["q"] * rng.randint(0, 30) + run)))
    want = brute(docs, items)
    for item, text in items:
        if 5 <= len(words(text)) < 10:
            want |= {(d, item): (len(at), at[0], len(words(text))) for d, body in docs if (at := runs_of(words(text), words(body)))}
    assert {d for d, _ in want} >= {1005, 2005, 4009} and not {d for d, _ in want} & {1004, 2004, 3007}
    frame, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for limit in (D.BROADCAST, -1):
        monkeypatch.setattr(D, "BROADCAST", limit)
        rows = D.overlaps(frame, bench, least_item=5).collect()
        assert {(r["doc_id"], r["item_id"]): (r["n_windows"], r["first_token"], r["matched_tokens"]) for r in rows} == want
    bad = {d for d, _ in want}
    assert sorted(r["doc_id"] for r in D.clean(frame, bench, least_item=5).collect()) == sorted(d for d, _ in docs if d not in bad)
    only = bench.filter("item_id > 200")
    assert {r["doc_id"] for r in D.contaminated(frame, only, least_item=5).collect()} == {d for d, i in want if i > 200}


def test_items_of_equal_tokens_are_each_reported(spark):
    passage = " ".join(f"w{k}" for k in range(15))
    bench = spark.createDataFrame([(1, passage), (2, passage.upper() + "!"), (None, passage), (2, passage)], "item_id long, text string")
    docs = spark.createDataFrame([(7, passage), (8, "nothing of it")], "doc_id long, text string")
    rows = D.overlaps(docs, bench).collect()
    assert sorted((r["doc_id"], str(r["item_id"]), r["n_windows"]) for r in rows) == [(7, "1", 4), (7, "2", 4), (7, "None", 4)]
