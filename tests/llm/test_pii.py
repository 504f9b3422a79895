import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from transferlens.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group(0))
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m.group(0).split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return sorted(out)


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{e}" for a, _, k, e in found).encode()).hexdigest()


TEXTS = [
    None,
    "",
    "no data here",
    "a@b.c_d@e.f x@y.z 1.2.3.4.5.6.7.8 +1 (2) 3-4 555 5555 55, 999.1.1.1 0255.0.0.1",
    "﷐+44 20 7946 0958﷑ 4111 1111 1111 1111 4111-1111-1111-1112 \U0001f600 a.b@c.d.e. ",
    "1" * 40 + " 12.12.12.12",
    "write to a@b.co\nor a@b.co" * 3,
    "x" * 50_000 + "@y.zz " + "7" * 9_000 + " " + "1." * 6_000 + " a@" + "b." * 9_000 + "c",
    "call (212) 555-1234 or mail bob (at) foo (dot) com; ssn 123-45-6789 iban DE89 3704 0044 0532 0130 00",
    "card 4111111111111111+1 (222) 333-4444 10.0.0.1@x.yz",
]


def test_base_spans_equal_brute_force(spark):
    rows = [(k, t, "clash", k % 2) for k, t in enumerate(TEXTS)] + [(3, TEXTS[3], "again", 0), (None, TEXTS[6], "", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kind string, start int")
    found = pii.report(docs).collect()
    assert len(found) == len(rows)
    for r in found:
        text = TEXTS[6] if r["doc_id"] is None else TEXTS[r["doc_id"]]
        want = brute(text)
        assert r["base_sha256"] == digest(want), (r, want)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(w[2] == k for w in want) for k in PATTERNS]
        assert {f"{k}:{a}:{e}" for a, _, k, e in want} <= set(filter(None, r["spans"].split(",")))
    added = next(r["spans"] for r in found if r["doc_id"] == 8)
    assert {s.split(":")[0] for s in added.split(",")} == {"phone", "email", "ssn", "iban"}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="aB1. @+-()4,\n2", max_size=60), min_size=20, max_size=60))
def test_random_texts(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(docs).collect():
        assert r["base_sha256"] == digest(brute(texts[r["doc_id"]])), texts[r["doc_id"]]


def test_redaction(spark):
    docs = spark.createDataFrame(
        [(1, "mail a@b.co now", "en", "s", 15), (2, "clean", None, "s", 5), (3, None, "en", None, None), (4, "x@y.zz10.0.0.1", "en", "s", 14)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert rows[1] == ("mail [EMAIL] now", 16) and rows[2] == ("clean", 5) and rows[3] == (None, None)
    assert rows[4][0].startswith("[EMAIL]")
    assert pii.redacted(docs.limit(0)).count() == 0 and pii.report(docs.limit(0)).count() == 0


def test_estimation_trusts_agreeing_labelers():
    good, bad, odd = (1, 1, 1, 1), (-1, -1, 0, 1), (1, -1, 0, -1)
    counts = {("card", good): 50, ("card", bad): 400, ("phone", good): 30, ("phone", odd): 20}
    model, belief = pii.estimate(counts)
    assert belief["card", good] > 0.95 and belief["card", bad] < 0.05
    assert model.tables["pattern"][True][1] > model.tables["pattern"][False][1]
    kinds, weights = pii.train(counts, belief)
    score = lambda k, v: sum(a * b for a, b in zip(weights, pii._features(k, v, kinds), strict=True))
    assert score("card", good) > 0 > score("card", bad)


@pytest.mark.parametrize(("digits", "good"), [("4111111111111111", True), ("4111111111111112", False), ("79927398713", True)])
def test_check_digit(spark, digits, good):
    assert spark.createDataFrame([(digits,)], "d string").select(pii.luhn("d")).first()[0] is good
