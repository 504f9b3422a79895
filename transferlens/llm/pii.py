"""Personal data by weak supervision, in DataFrame functions only.

Candidates come from patterns: the strict ones of ``BASE``, whose valid matches always count, and loose ones (``LOOSE``) that find
further spans. Labelers vote on each candidate: a pattern labeler (is the form valid, with check digits), a gazetteer labeler
(top-level domains, issuer prefixes, calling codes, reserved networks), a context labeler (cue words before the span) and a
boundary labeler (is it cut out of a longer run). Votes are 1, 0 (abstains) or -1.

Candidates with equal kind and votes are counted over the whole corpus; those few counts (at most 81 patterns for each kind)
are all that expectation-maximisation needs: it estimates each labeler's reliability without any labels (Dawid and Skene's model,
kinds sharing the reliabilities, each kind with its own share of true spans) and gives every pattern a
probability. They are the soft labels on which the final span classifier, a logistic model of votes and kind, is trained. Loose
spans that it accepts, and that overlap no base span and no earlier loose one, are added.

Positions: matches are put between two marker characters, the text is split there, and lengths of the parts are summed by a
window over the parts of one document. Only documents with a candidate get that far, and only part lengths, matches and 40
characters of context are shuffled.

Defined cases: null and empty texts have no spans. Rows that repeat id and text have equal spans. Characters that a text shares with
the markers are first replaced by others of the same length. Counts and positions are code points. The patterns use
possessive and look-behind forms of the given ones that find the same matches without backtracking, so long runs take linear time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from transferlens.llm.common import unused, whole
from transferlens.session import stored

KINDS = ("email", "ip", "card", "phone")
#: Java forms of the base patterns. A match starts a run, or goes on where the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Loose candidates by the kind they would be.
LOOSE = {
    "email_masked": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[\[(]\x20?at\x20?[\])]\x20?[A-Za-z0-9-]{1,64}+(?:\x20?[\[(]\x20?dot\x20?[\])]\x20?[A-Za-z0-9-]{2,24}+)++",
    "phone_local": r"(?<![0-9+])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "phone_double_zero": r"(?<![0-9])00[1-9][0-9]{0,2}[\x20-][0-9]{2,4}(?:[\x20-][0-9]{2,4}){1,3}+(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
}
# Cue words of the context labeler, for and against each group of kinds.
CUES = {
    "email": ("mail|contact|write|reply|escrib|correo|courriel|schreib", "version|import|decorat"),
    "ip": ("ip|host|server|address|adresse|direcci|login|client", "version|release|section|chapter|v|firmware"),
    "card": ("card|visa|master|amex|credit|karte|carte|tarjeta", "isbn|order|serial|invoice|tracking|sha|hash"),
    "phone": ("phone|call|tel|fax|mobile|cell|anruf|appel|llam", "order|serial|score|range|isbn"),
    "ssn": ("ssn|social|security|tax", "order|serial|part|isbn"),
    "iban": ("iban|account|konto|compte|cuenta|bank", "serial|sha|hash|key|token"),
}
# Gazetteers.
DOMAINS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|eu|nl|pl|ch|at|be|us|ca|br|mx|jp|cn|in|au"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))"
CALLING = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED = r"^0*(?:0|10|127|224|239|240|255)\."
VOTERS = ("pattern", "gazetteer", "context", "boundary")
_OPEN, _CLOSE, _STANDIN = "\ufdd0", "\ufdd1", "\ufffd"
_CONTEXT = 40


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right."""
    values = F.transform(F.reverse(F.split(digits, "")), lambda c: c.cast("int"))
    doubled = F.transform(values, lambda v, k: F.when(k % 2 == 0, v).when(v > 4, 2 * v - 9).otherwise(2 * v))
    return F.aggregate(doubled, F.lit(0), lambda s, v: s + v) % 10 == 0


def _part_small(part: Column) -> Column:
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def valid(kind: Column, match: Column) -> Column:
    """Whether a match of a base pattern counts."""
    digits = F.length(_digits(match))
    ip = F.forall(F.split(match, r"\."), _part_small)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", ip)
        .when(kind == "card", digits.between(14, 19) & luhn(F.when(digits.between(14, 19), _digits(match)).otherwise(F.lit("0"))))
        .when(kind == "phone", digits.between(10, 15))
        .otherwise(F.lit(False))
    )


def _parts(text: Column, pattern: str) -> Column:
    """The text around and in the matches, in turn."""
    return F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), f"[{_OPEN}{_CLOSE}]", -1)


def candidates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, match, before, after): matches of all patterns; end is exclusive.

    Patterns run only on texts that hold a character they need.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), whole(F.col(text)).alias("text"))
    rows = rows.filter(F.col("text").rlike(r"[0-9@]|[\[(]\x20?at\x20?[\])]")).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.translate("text", _OPEN + _CLOSE, _STANDIN * 2).alias("text")
    )
    digit, masked = F.col("text").rlike("[0-9]"), F.col("text").rlike(r"[\[(]\x20?at\x20?[\])]")
    needs = {"email": F.col("text").contains("@"), "phone": F.col("text").contains("+"), "email_masked": masked}
    lists = [
        F.struct(F.lit(kind).alias("kind"), F.when(needs.get(kind, digit), _parts(F.col("text"), pattern)).alias("parts"))
        for kind, pattern in {**BASE, **LOOSE}.items()
    ]
    lists = F.filter(F.array(*lists), lambda one: F.size(one["parts"]) > 1)
    flat = rows.select("doc_id", "text_hash", F.explode(lists).alias("one")).select("doc_id", "text_hash", "one.kind", F.posexplode("one.parts").alias("at", "part"))
    odd = F.col("at") % 2 == 1
    narrow = flat.select(
        "doc_id",
        "text_hash",
        "kind",
        "at",
        F.length("part").alias("n"),
        F.when(odd, F.col("part")).alias("match"),
        F.when(~odd, F.right("part", F.lit(_CONTEXT))).alias("tail"),
        F.when(~odd, F.left("part", F.lit(1))).alias("head"),
    ).dropDuplicates(["doc_id", "text_hash", "kind", "at"])
    order = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("at")
    placed = narrow.select(
        "*",
        F.sum(F.col("n").cast("long")).over(order).alias("end"),
        F.lag("tail").over(order).alias("before"),
        F.lead("head").over(order).alias("after"),
    )
    return placed.filter(F.col("match").isNotNull()).select(
        "doc_id", "text_hash", "kind", (F.col("end") - F.col("n")).alias("start"), "end", "match", "before", "after"
    )


def _group(kind: Column) -> Column:
    return F.regexp_extract(kind, "^[a-z]+", 0)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(no, F.lit(-1)).when(yes, F.lit(1)).otherwise(F.lit(0))


def with_votes(spans: DataFrame) -> DataFrame:
    """Candidates with a column for each labeler."""
    kind, match, digits = F.col("kind"), F.col("match"), _digits(F.col("match"))
    group = _group(kind)
    loose = ~kind.isin(*KINDS)
    area = F.substring(digits, 1, 3)
    formed = (
        F.when(~loose, valid(kind, match))
        .when(kind == "ssn", ~area.isin("000", "666") & (area < "900") & (F.substring(digits, 4, 2) != "00") & (F.substring(digits, 6, 4) != "0000"))
        .when(group == "phone", F.length(digits).between(9, 15))
        .when(kind == "iban", _mod97(match))
        .otherwise(F.lit(True))
    )
    known = (
        F.when(kind == "email", F.lower(match).rlike(rf"\.(?:{DOMAINS})$"))
        .when(kind == "email_masked", F.lower(match).rlike(rf"(?:{DOMAINS})$"))
        .when(kind == "card", digits.rlike(ISSUERS))
        .when(kind == "phone", digits.rlike(CALLING))
        .when(kind == "phone_double_zero", F.substring(digits, 3, 15).rlike(CALLING))
        .when(kind == "ip", ~match.rlike(RESERVED))
    )
    before = F.lower(F.coalesce("before", F.lit("")))
    near = [F.when(group == g, before.rlike(rf"(?<![a-z])(?:{pair[0]})[a-z]*[^a-z0-9]{{0,12}}(?:[a-z]+[^a-z0-9]{{1,4}})?$")) for g, pair in CUES.items()]
    far = [F.when(group == g, before.rlike(rf"(?<![a-z])(?:{pair[1]})[a-z]*[^a-z0-9]{{0,6}}$")) for g, pair in CUES.items()]
    joined = F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")
    false = F.lit(False)
    return spans.select(
        "*",
        _vote(formed, ~formed).alias("pattern"),
        _vote(F.coalesce(known, false), F.coalesce(~known, false)).alias("gazetteer"),
        _vote(F.coalesce(*near, false), F.coalesce(*far, false)).alias("context"),
        _vote(~F.coalesce(joined, false), F.coalesce(joined, false)).alias("boundary"),
    )


def _mod97(match: Column) -> Column:
    """Check digits of an account number: letters stand for 10 to 35, the first four characters go last."""
    bare = F.regexp_replace(match, " ", "")
    turned = F.split(F.concat(F.substring(bare, 5, 40), F.substring(bare, 1, 4)), "")
    step = lambda s, c: F.when(c.between("0", "9"), (s * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97)
    return F.when(F.length(bare).between(15, 34), F.aggregate(turned, F.lit(0), step) == 1).otherwise(F.lit(False))


@dataclass
class Reliability:
    """What expectation-maximisation found: P(vote | true or not) of each labeler, and each kind's share of true spans."""

    tables: dict[str, dict[bool, dict[int, float]]]
    shares: dict[str, float]


def estimate(counts: dict[tuple[str, tuple[int, ...]], int], rounds: int = 100) -> tuple[Reliability, dict[tuple[str, tuple[int, ...]], float]]:
    """Reliabilities and the probability of every (kind, votes) pattern, from the patterns' counts.

    A labeler that abstains says nothing. One that votes starts out right 8 times of 10.
    """
    start = {True: {1: 0.8, -1: 0.2}, False: {1: 0.2, -1: 0.8}}
    model = Reliability({v: {c: dict(t) for c, t in start.items()} for v in VOTERS}, {k: 0.5 for k, _ in counts})
    belief: dict[tuple[str, tuple[int, ...]], float] = {}
    for _ in range(rounds):
        before = dict(belief)
        for kind, votes in counts:
            odds = math.log(model.shares[kind] / (1 - model.shares[kind]))
            for voter, vote in zip(VOTERS, votes, strict=True):
                if vote:
                    odds += math.log(model.tables[voter][True][vote] / model.tables[voter][False][vote])
            belief[kind, votes] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
        for k, voter in enumerate(VOTERS):
            for truth in (True, False):
                weights = {v: 1.0 + 9 * start[truth][v] for v in (1, -1)}  # a prior worth eleven spans
                for (kind, votes), n in counts.items():
                    if votes[k]:
                        weights[votes[k]] += n * (belief[kind, votes] if truth else 1 - belief[kind, votes])
                total = sum(weights.values())
                model.tables[voter][truth] = {v: w / total for v, w in weights.items()}
        for kind in model.shares:
            own = [(n, belief[k, v]) for (k, v), n in counts.items() if k == kind]
            model.shares[kind] = (1 + sum(n * b for n, b in own)) / (2 + sum(n for n, _ in own))
        if before and max(abs(belief[x] - before[x]) for x in belief) < 1e-9:
            break
    return model, belief


def _features(kind: str, votes: tuple[int, ...], kinds: list[str]) -> list[float]:
    return [1.0, *(float(kind == k) for k in kinds), *(float(v == 1) for v in votes), *(float(v == -1) for v in votes)]


def train(counts: dict[tuple[str, tuple[int, ...]], int], belief: dict[tuple[str, tuple[int, ...]], float], rounds: int = 1500) -> tuple[list[str], list[float]]:
    """The span classifier: weights of a ridge logistic model fitted to the soft labels, by gradient steps on pattern counts.

    Every kind weighs the same, however many candidates it has.
    """
    kinds = sorted({k for k, _ in counts})
    total = {kind: sum(n for (k, _), n in counts.items() if k == kind) for kind in kinds}
    rows = [(_features(k, v, kinds), belief[k, v], n / total[k]) for (k, v), n in counts.items()]
    weights = [0.0] * (1 + len(kinds) + 2 * len(VOTERS))
    scale = sum(w for _, _, w in rows) or 1.0
    for _ in range(rounds):
        grad = [1e-3 * w for w in weights]
        for x, y, w in rows:
            error = w / scale * (1 / (1 + math.exp(-max(-40.0, min(40.0, sum(a * b for a, b in zip(weights, x, strict=True)))))) - y)
            for k, value in enumerate(x):
                grad[k] += error * value
        weights = [w - 2.0 * g for w, g in zip(weights, grad, strict=True)]
    return kinds, weights


def accepted(kinds: list[str], weights: list[float]) -> Column:
    """Whether the classifier takes a candidate for personal data."""
    score = F.lit(weights[0])
    for k, name in enumerate(kinds):
        score = score + F.when(F.col("kind") == name, F.lit(weights[1 + k])).otherwise(F.lit(0.0))
    for k, voter in enumerate(VOTERS):
        up, down = weights[1 + len(kinds) + k], weights[1 + len(kinds) + len(VOTERS) + k]
        score = score + F.when(F.col(voter) == 1, F.lit(up)).when(F.col(voter) == -1, F.lit(down)).otherwise(F.lit(0.0))
    return score > 0


#: Loose kinds are reported as the kind they are a form of.
_REPORTED = {"email_masked": "email", "phone_local": "phone", "phone_double_zero": "phone"}


def spans(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, base): all base spans and the added ones."""
    voted = stored(with_votes(candidates(docs, doc_id=doc_id, text=text)).drop("match", "before", "after"), "pii-votes")
    rows = voted.groupBy("kind", *VOTERS).count().collect()
    counts = {(r["kind"], tuple(r[v] for v in VOTERS)): r["count"] for r in rows}
    _, belief = estimate(counts)
    kinds, weights = train(counts, belief)
    base = F.col("kind").isin(*KINDS)
    kept = voted.filter(F.when(base, F.col("pattern") == 1).otherwise(accepted(kinds, weights))).withColumn("base", base)
    # a loose span goes if it meets a base span, or a loose one that begins before it
    own = Window.partitionBy("doc_id", "text_hash")
    past = own.orderBy("start", F.desc("base"), "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    ahead = own.orderBy("start", F.desc("base"), "end", "kind").rowsBetween(1, Window.unboundedFollowing)
    reach = F.max("end").over(past)
    next_base = F.min(F.when(F.col("base"), F.col("start"))).over(ahead)
    clear = (F.coalesce(reach, F.lit(-1)) <= F.col("start")) & (next_base.isNull() | (next_base >= F.col("end")))
    named = F.col("kind")
    for loose, kind in _REPORTED.items():
        named = F.when(F.col("kind") == loose, F.lit(kind)).otherwise(named)
    return kept.withColumn("clear", clear).filter(F.col("base") | F.col("clear")).select("doc_id", "text_hash", named.alias("kind"), "start", "end", "base")


def _rank(kind: Column) -> Column:
    out = F.lit(len(KINDS))
    for k, name in enumerate(KINDS):
        out = F.when(kind == name, F.lit(k)).otherwise(out)
    return out


def per_document(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text_hash, spans): the sorted spans of each document that has some, as structs (start, rank, kind, end, base)."""
    one = F.struct("start", _rank(F.col("kind")).alias("rank"), "kind", "end", "base")
    found = spans(docs, doc_id=doc_id, text=text)
    return found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(one)).alias("spans"))


#: Documents with spans up to which they are broadcast (a few hundred bytes each).
BROADCAST = 100_000


def _with_spans(docs: DataFrame, doc_id: str, text: str, spans: str) -> DataFrame:
    """``docs`` with the column ``spans``, null for those without. Texts are shuffled only if too many have spans to be broadcast."""
    own, digest = unused(docs, "_id"), unused(docs, "_hash")
    found = per_document(docs, doc_id=doc_id, text=text).select(F.col("doc_id").alias(own), F.col("text_hash").alias(digest), F.col("spans").alias(spans))
    found = stored(found, "pii-found")
    found = F.broadcast(found) if found.count() <= BROADCAST else found
    same = F.col(doc_id).eqNullSafe(F.col(own)) & (F.xxhash64(whole(F.col(text))) == F.col(digest))
    return docs.join(found, same, "left").drop(own, digest)


def _is(kind: str):
    return lambda one: one == kind


def joined(spans: Column) -> Column:
    """kind:start:end of every span, with commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base spans, the digest of their places, and all spans as text."""
    none = F.from_json(F.lit("[]"), "array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>")
    found = per_document(docs, doc_id=doc_id, text=text).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash", "spans": "_spans"})
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    rows = rows.join(found, same, "left").select("doc_id", F.coalesce("_spans", none).alias("all"))
    base = F.filter("all", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("all")).alias("spans"))


def redacted(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans become one, named after the first.

    ``n_chars`` is set to the new length where the text has changed. Other columns stay, whatever their names.
    """
    spans = unused(docs, "_spans")
    rows = _with_spans(docs, doc_id, text, spans)
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(F.col(text), (state["at"] + 1).cast("int"), (span["start"] - state["at"]).cast("int"))
        more = F.concat(state["parts"], F.array(gap, F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))))
        fresh = span["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.when(fresh, more).otherwise(state["parts"]).alias("parts"))

    rest = lambda s: F.concat(F.array_join(s["parts"], ""), F.substring(F.col(text), (s["at"] + 1).cast("int"), F.length(text)))
    changed = F.col(spans).isNotNull()
    new = F.when(changed, F.aggregate(spans, start, step, rest)).otherwise(F.col(text))
    out = rows.withColumn(text, new)
    if n_chars and n_chars in docs.columns:
        out = out.withColumn(n_chars, F.when(changed, F.length(text).cast(docs.schema[n_chars].dataType)).otherwise(F.col(n_chars)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
