"""Quality bands, licences, shards, and the pipeline."""

import collections
import random
import re
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import compare, duck
from transferlens.llm import decontamination, licenses, pii, quality, queries, sharding, simhash

FOLDER = "/root/testdata/sf0.001"

# ---- quality -----------------------------------------------------------------------------------

SPACE = r"[\x20\x09-\x0D]"


def brute_figures(text):
    text = text or ""
    words = [w for w in re.split(SPACE + "+", text) if w]
    windows = collections.Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered)


PROSE = " ".join(random.Random(5).choices(["%s%s" % (a, b) for a in "abcdefghij" for b in ("ra", "tion", "el", "om")], k=900))
QUALITY = [
    None, "", " \t\n", "one two", "a b c a b c", "a a a a", "x\x0by z\x0cw\x1cq  r", "l1\nl1\n \nl1\r\nl2 \nl2", PROSE, "same line of text here\n" * 200,
    "#*$ %& |<> " * 9, "".join(random.Random(6).choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/ ", k=20_000)), "你好 \U0001f600 " * 30,
]


def test_base_figures_and_bands(spark):
    rows = [(k, t, 9, "clash") for k, t in enumerate(QUALITY)]
    out = {r["doc_id"]: r for r in quality.with_verdict(spark.createDataFrame(rows, "doc_id long, text string, n_words int, source string").drop("n_words")).collect()}
    for k, text in enumerate(QUALITY):
        r, want = out[k], brute_figures(text)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want, k
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert out[8]["kept"] and out[1]["ratio"] is None


def test_bands_reject_repetition_noise_and_bad_parts():
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    noise = random.Random(1).randbytes(12_000)
    prose = PROSE.encode()
    assert quality.compression(prose, packer)[2]
    assert not quality.compression(prose[:500] * 40, packer)[2]
    assert not quality.compression(noise, packer)[2]
    assert quality.compression(noise[:100], packer)[2]  # too short for a band
    mixed = b" ".join(random.Random(9).choices(prose.split(), k=1000))[: quality.CHUNK]
    ratio, share, good = quality.compression(mixed + b"ab " * (quality.CHUNK * 2 // 3), packer)
    assert share >= 0.5 and not good
    assert quality.band(100) is None and quality.band(700) == quality.BANDS[1][1:]


def _letters(rng, letters, size):
    return " ".join("".join(rng.choices(letters, k=rng.randint(3, 9))) for _ in range(size // 5))[:size]


LOWER = "abcdefghijklmnopqrstuvwxyz"


@pytest.mark.parametrize(
    ("letters", "sizes"),
    [(LOWER + LOWER.upper() + "0123456789+/", (400, 800, 1500, 3000, 60_000)), (LOWER, (1500, 3000, 6000, 60_000)), ("0123456789abcdef", (4500, 12_000, 60_000))],
)
def test_incompressible_texts_are_out_of_band(letters, sizes):
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    for size in sizes:
        n_words, *_, repeated, ratio, _, good = quality.figures(_letters(random.Random(size), letters, size), packer)
        assert n_words >= 50 and 2 * repeated <= n_words and not good, (size, ratio)


def test_half_repeated_texts_are_out_of_band(spark):
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    texts = [r["text"] for r in queries.table(spark, FOLDER, "documents").select("text").collect() if r["text"]]
    prose = [t for t in texts if (f := quality.figures(t, packer))[0] >= 50 and 2 * f[4] <= f[0]]
    assert prose and all(quality.figures(t, packer)[-1] for t in prose)
    for size in (1500, 3000, 6000, 20_000):
        words = " ".join(t for t in prose if len(t) < 4000).split()[: size // 12]
        line = words[:12]
        text = " ".join(words + line * (len(words) * 7 // 10 // 12))
        n_words, *_, repeated, ratio, _, good = quality.figures(text, packer)
        assert n_words >= 50 and 2 * repeated <= n_words and not good, (size, ratio)


# ---- shards ------------------------------------------------------------------------------------


def test_shards_are_whole_even_and_gapless(spark):
    rng = random.Random(8)
    rows = []
    for k in range(3000):
        text = "copy of a text " * 30 if k % 3 == 0 else "t%d " % k * rng.randint(0, 200)
        rows.append((k, text, rng.choice(["src0", "src1", None]), rng.choice(["en", "de"]), "clash"))
    rows += [(5, None, "src0", "en", ""), (5, None, "src0", "en", ""), (None, "", None, None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, shard string")
    out = sharding.shards(docs, leaves=16).collect()
    body = lambda t: (t or "").encode()
    want = collections.Counter((k, len(body(t)) + 1, zlib.crc32(body(t))) for k, t, *_ in rows)
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    shards = collections.defaultdict(list)
    for r in out:
        shards[r["shard"]].append(r)
    assert sorted(shards) == list(range(16)) and {r["law"] for r in out} == {"bytes"}
    assert all(sorted(r["slot"] for r in rs) == list(range(len(rs))) for rs in shards.values())
    sizes = [sum(r["size"] for r in rs) for rs in shards.values()]
    assert max(sizes) < 1.06 * sum(sizes) / 16 and min(sizes) > 0.94 * sum(sizes) / 16
    places = collections.defaultdict(set)  # small groups of copies stay together
    for r in out:
        places[r["text_crc32"]].add(r["shard"])
    hot = zlib.crc32(body("copy of a text " * 30))
    assert all(len(s) == 1 for crc, s in places.items() if crc != hot)


def test_target_bytes_odd_leaves_and_empty(spark):
    docs = spark.createDataFrame([(k, "x" * (k + 1), "s", "en") for k in range(400)], "doc_id long, text string, source string, lang string")
    out = sharding.shards(docs, target_bytes=12_000).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(out) == 7 and all(0.9 < r["n"] * 7 / 80_600 < 1.1 for r in out)
    assert sharding.shards(docs.limit(0), leaves=4).count() == 0
    assert sharding.shards(docs.limit(2), leaves=4).count() == 2


# ---- licences ----------------------------------------------------------------------------------


def test_notices_within_longer_lines_and_over_lines(spark):
    words = "some quite ordinary words that stand beside it here and there in one long line of plain prose".split()
    beside = lambda notice, n: " ".join([*words[: n // 2], notice, *words[n // 2 : n]])
    notices = {name: texts[0] for name, texts in licenses.TEMPLATES.items()}
    rows = [(f"{name}/{n}", beside(notice, n), name) for name, notice in notices.items() for n in (0, 4, 8, 12)]
    rows += [(f"{name}/long", " ".join([*words * 9, notice, *words * 9]), name) for name, notice in notices.items()]
    rows += [(f"{name}/flow", "\n".join(f"{words[0]} {notice} {words[1]}".split()), name) for name, notice in notices.items()]
    rows += [("v2", "This work is licensed under the GNU General Public License, version 2.", None), ("cc3", "Licensed under CC BY 3.0.", None)]
    rows += [("v3", "This work is licensed under the GNU General Public License, v3.", "GPL-3.0"), ("no", "It was released under the new license.", None)]
    rows += [(f"none/{k}", " ".join(random.Random(k).choices(words, k=30)), None) for k in range(40)]
    docs = spark.createDataFrame([(k, t, f"d{k}/{name}") for k, (name, t, _) in enumerate(rows)], "doc_id long, text string, path string")
    out = {r["doc_id"]: r["own_license"] for r in licenses.scan(docs, F.col("path")).collect()}
    assert {rows[k][0]: v for k, v in out.items()} == {name: want for name, _, want in rows}


def test_headers_files_and_inheritance(spark):
    mit = "Released under the MIT License."
    gpl = "This work is licensed under the GNU General Public License, version 3."
    prose = "some words that are not about it at all\nand another line"
    rows = [
        (1, f"{prose}\n{mit}\n{prose}", "a/b/x.txt"),
        (2, prose, "a/b/y.txt"),
        (3, gpl, "a/LICENSE"),
        (4, prose, "a/b/c/z.txt"),
        (5, "LICENSED!! UNDER!! THE APACHE License, Version 2.0", "q/w.txt"),
        (6, None, "q/e.txt"),
        (7, "", None),
        (8, "my driving licence is in the car and the dog ate the rest of what was in there today", "q/r.txt"),
        (9, mit, "a/b/c/COPYING"),
        (10, mit, "a/b/c/COPYING"),
        (11, prose, "LICENSE.md"),
        (12, prose * 9 + " word " * 300 + "Licensed under CC BY-NC 4.0. " + "other " * 300, "n/long.txt"),
    ]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, path string, license string")
    out = {r["doc_id"]: r for r in licenses.scan(docs, F.col("path")).collect()}
    own = {k: r["own_license"] for k, r in out.items()}
    assert own[1] == own[9] == "MIT" and own[3] == "GPL-3.0" and own[5] == "Apache-2.0"
    assert own[2] is own[6] is own[7] is own[8] is own[11] is None
    assert (out[2]["license"], out[2]["inherited_from"]) == ("GPL-3.0", "a/LICENSE")
    assert (out[4]["license"], out[4]["inherited_from"]) == ("MIT", "a/b/c/COPYING")
    assert out[1]["license"] == "MIT" and out[1]["inherited_from"] is None
    assert (out[6]["license"], out[6]["inherited_from"]) == ("Apache-2.0", "q/w.txt") and out[7]["license"] is None
    assert out[3]["is_license_file"] and not out[1]["is_license_file"]
    assert licenses.scan(docs.limit(0), F.col("path")).count() == 0


# ---- queries and pipeline ----------------------------------------------------------------------


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_query_equals_check(spark, name):
    assert compare(spark, duck(FOLDER), FOLDER, name, queries.QUERIES, queries.CHECKS) is None


def test_every_query_is_registered():
    assert [n.split("_")[0] for n in queries.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", ["op2_decontamination", "op5_license_scan", "op6_pii", "op9_sharding"])
def test_native_plans_hold_no_python(spark, name, capsys):
    queries.QUERIES[name](spark, FOLDER).explain("simple")
    plan = capsys.readouterr().out
    for banned in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert banned not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    names, kept = docs.columns, docs
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data", "packing"]
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, FOLDER)
        assert kept.columns == names
        now = {r["doc_id"]: r["text"] for r in kept.collect()}
        assert len(now) == kept.count()
        if name == "near_duplicates":
            prints = {k: simhash.fingerprint(t) for k, t in before.items()}
            for k in before:  # whoever went has a link to someone; whoever stayed is the least of its links
                near = [j for j in before if bin((prints[k] ^ prints[j]) & (1 << 64) - 1).count("1") <= 2]
                assert k in now or min(near) < k or len(near) > 1
            ids = sorted(now)
            assert all(bin((prints[a] ^ prints[b]) & (1 << 64) - 1).count("1") > 2 for n, a in enumerate(ids) for b in ids[:n])
        if name == "decontamination":
            assert decontamination.contaminated(kept, bench).count() == 0
        if name == "personal_data":
            assert set(now) == set(before)
            assert pii.report(kept).agg(F.sum("n_email"), F.sum("n_ip"), F.sum("n_card"), F.sum("n_phone")).first() == (0, 0, 0, 0)
        before = now
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert {r["doc_id"] for r in packed.collect()} == set(before)
    assert corpus_pipeline.run(spark, FOLDER).count() == packed.count()


CLASHES = "_score string, _score_ string, _id string, _hash string, _spans string, _bad_id string, _bad_hash string, _row string, score string, spans string, text_hash string"


def test_stages_keep_columns_whose_names_clash(spark):
    docs = queries.table(spark, FOLDER, "documents")
    names = [c.split()[0] for c in CLASHES.split(", ")]
    more = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, clashing = stage(spark, docs, FOLDER), stage(spark, more, FOLDER)
        assert clashing.columns == more.columns
        assert sorted(r["doc_id"] for r in plain.collect()) == sorted(r["doc_id"] for r in clashing.collect()), name
        assert clashing.filter(" or ".join(f"{n} != concat('{n}', doc_id)" for n in names)).count() == 0, name


def test_stages_take_nulls_repeats_and_an_empty_table(spark):
    docs = queries.table(spark, FOLDER, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", None, 0), (5, "a b", None, "s", 3), (5, "a b", None, "s", 3)], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0, name
        out = stage(spark, odd, FOLDER)
        assert out.count() == {"near_duplicates": 2}.get(name, 4), name
