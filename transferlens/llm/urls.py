"""URL filter: rules first, then a character language-model ratio.

Rules allow or block a host with all its subdomains below a path prefix; the longest fitting rule decides. All other URLs are
judged by two variable-order Markov models over characters, one of accepted and one of rejected URLs. Each interpolates the orders
0 to ``ORDER`` by Witten-Bell smoothing: a context that is followed by many different characters trusts its own counts less. The
verdict is the log-likelihood difference per character against a threshold, calibrated where it separates labelled URLs kept from the fit best.

Labelled are the URLs that a rule decides, and as rejected also those whose host has a label of ``REJECTED_WORDS``. All distinct ones
are learned from, but for one in ``CALIBRATION`` by hash; all of those calibrate. Tasks count the runs of up to ``ORDER`` + 1
characters of their URLs, Spark adds the counts up, and the models hold each distinct run once, whatever the number of URLs.
The models read what rules leave open: the host without its last label and the labels before it that a rule names (of a host of such
labels only, the first stays), the path and the query string, digits as one character.

Defined cases: a null URL, or one without ``://``, has empty host and path; no rule fits it, and with nothing to judge it is allowed.
Without labels of both classes every URL that no rule decides is allowed. Repeated rows get equal verdicts.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.session import stored

ORDER = 4
CALIBRATION = 5
#: Cells of a ratio of 1 in which calibration URLs are counted.
GRID = 10_000
# Words in host names that mark rejected URLs when labels are drawn.
REJECTED_WORDS = ("adult", "ads", "bet", "bets", "casino", "cheap", "pills", "poker", "porn", "sex", "spam", "track", "tracker", "xxx")
_CACHE = 1 << 20
#: URLs that are counted at once, and distinct runs that a task holds.
_ROWS = 2_000
_HELD = 1 << 18


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def rules_of(text: str) -> list[Rule]:
    """From lines or comma-separated items like ``block net/``."""
    out = []
    for item in filter(None, (i.strip() for i in re.split(r"[,\n]", text))):
        verdict, _, place = item.partition(" ")
        host, slash, path = place.partition("/")
        out.append(Rule(verdict, host.lower(), slash + path))
    return out


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # or the end, A-Z lower-cased."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def query_of(url: Column) -> Column:
    """The query string with its ?, up to # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)


def rule_of(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """Text of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def named_labels(rules: Sequence[Rule]) -> frozenset[str]:
    return frozenset(label for rule in rules for label in rule.host.split("."))


def _shown(host: str, path: str, named: frozenset[str] = frozenset()) -> str:
    """What the models read of a host and its path and query, between a start and an end mark."""
    labels = host.split(".")
    n = len(labels) - 1
    while n and labels[n - 1] in named:
        n -= 1
    name = ".".join(labels[:n] or labels[:1])
    return "^" + re.sub(r"[0-9]", "0", name + path) + "$"


def gram_counts(texts: Iterable[str], order: int) -> Counter[str]:
    """How often each run of up to ``order`` + 1 characters ends at a character behind the start mark."""
    counts: Counter[str] = Counter()
    for text in texts:
        counts.update(text[at - k : at + 1] for at in range(1, len(text)) for k in range(min(order, at) + 1))
    return counts


class Markov:
    """Witten-Bell interpolation of the orders 0 to ``order``."""

    def __init__(self, texts: Sequence[str] = (), order: int = ORDER, grams: Mapping[str, int] | None = None) -> None:
        self.order = order
        counts: dict[str, dict[str, int]] = defaultdict(dict)
        for gram, n in (gram_counts(texts, order) if grams is None else grams).items():
            counts[gram[:-1]][gram[-1]] = n
        self.counts = dict(counts)
        self.totals = {c: sum(n.values()) for c, n in self.counts.items()}
        self.alphabet = 1 + len(self.counts.get("", {}))

    def probability(self, context: str, char: str) -> float:
        p = 1 / self.alphabet
        for k in range(len(context) + 1):
            own = self.counts.get(context[len(context) - k :])
            if own is None:
                break
            kinds, total = len(own), self.totals[context[len(context) - k :]]
            p = (own.get(char, 0) + kinds * p) / (total + kinds)
        return p


@dataclass
class Model:
    accepted: Markov
    rejected: Markov
    threshold: float = 0.0

    def ratio(self, text: str, cache: dict[str, float]) -> float:
        """Mean over characters of log P(accepted) - log P(rejected)."""
        total, order = 0.0, self.accepted.order
        for at in range(1, len(text)):
            gram = text[max(0, at - order) : at + 1]
            value = cache.get(gram)
            if value is None:
                value = math.log(self.accepted.probability(gram[:-1], gram[-1]) / self.rejected.probability(gram[:-1], gram[-1]))
                if len(cache) > _CACHE:
                    cache.clear()
                cache[gram] = value
            total += value
        return total / max(1, len(text) - 1)


def calibrated(accepted: list[float], rejected: list[float]) -> float:
    """The threshold with the best mean of both classes' recalls, in the middle of its gap."""
    return _threshold(Counter(accepted), Counter(rejected))


def _threshold(accepted: Mapping[float, int], rejected: Mapping[float, int]) -> float:
    """That of :func:`calibrated`, from how often each value occurs."""
    points = sorted({*accepted, *rejected})
    n_accepted, n_rejected = sum(accepted.values()), sum(rejected.values())
    best, threshold = -1.0, 0.0
    below = [0, 0]
    for k, value in enumerate(points):
        worth = below[0] / max(1, n_rejected) + (n_accepted - below[1]) / max(1, n_accepted)
        if worth > best:
            best, threshold = worth, (value + points[k - 1]) / 2 if k else value - 1e-9
        below[0] += rejected.get(value, 0)
        below[1] += accepted.get(value, 0)
    return threshold


def _ratio_of(model: Model, named: frozenset[str], df: DataFrame, host: Column, rest: Column) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def ratio(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        cache: dict[str, float] = {}
        for hosts, rests in parts:
            yield pd.Series([shared.value.ratio(_shown(h, r, named), cache) for h, r in zip(hosts, rests, strict=True)], dtype="float64")

    return ratio(host, rest)


def train(pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", order: int = ORDER, words: Sequence[str] = REJECTED_WORDS) -> Model | None:
    """Both models and the threshold; None without labelled URLs of both classes."""
    rows = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), query_of(F.col(url)).alias("query"))
    rows = rows.withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    blocked = [r.text for r in rules if r.verdict == "block"]
    marked = F.col("host").rlike(r"(?:^|[.-])(?:" + "|".join(words) + r")(?:[.-]|$)") if words else F.lit(False)
    label = F.when(marked | F.col("rule").isin(blocked), F.lit("block")).when(F.col("rule").isNotNull(), F.lit("allow"))
    rows = rows.withColumn("label", label).filter(F.col("label").isNotNull())
    rows = rows.select("host", F.concat("path", "query").alias("rest"), "label").distinct()
    rows = stored(rows.withColumn("probe", F.pmod(F.xxhash64("host", "rest"), F.lit(CALIBRATION)) == 0), "url-labels")
    sums = {(r["label"], r["probe"]): r["n"] for r in rows.groupBy("label", "probe").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(sums.get((name, False), 0) + sums.get((name, True), 0) < 2 for name in ("allow", "block")):
        return None
    # with few URLs a class may be on one side only: then all are learned from and calibrate
    learn, probe = (rows.filter(~F.col("probe")), rows.filter("probe")) if len(sums) == 4 else (rows, rows)
    named = named_labels(rules)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter[str]] = defaultdict(Counter)

        def emit() -> Iterator[pa.RecordBatch]:
            for name, own in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(own)), pa.array(list(own)), pa.array(list(own.values()))], ["label", "gram", "n"])
            held.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                by_name: dict[str, list[str]] = defaultdict(list)
                for row in batch.slice(at, _ROWS).to_pylist():
                    by_name[row["label"]].append(_shown(row["host"], row["rest"], named))
                for name, texts in by_name.items():
                    held[name].update(gram_counts(texts, order))
                if sum(map(len, held.values())) > _HELD:
                    yield from emit()
        yield from emit()

    found = learn.select("host", "rest", "label").mapInArrow(count, "label string, gram string, n long")
    grams: dict[str, dict[str, int]] = {"allow": {}, "block": {}}
    for batch in found.groupBy("label", "gram").agg(F.sum("n").alias("n")).toArrow().to_batches():
        for name, gram, n in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            grams[name][gram] = n
    model = Model(*(Markov(order=order, grams=grams.pop(name)) for name in ("allow", "block")))
    cell = F.round(_ratio_of(model, named, probe, F.col("host"), F.col("rest")) * GRID).cast("long").alias("cell")
    ratios: dict[str, dict[float, int]] = {"allow": {}, "block": {}}
    for r in probe.select("label", cell).groupBy("label", "cell").agg(F.count(F.lit(1)).alias("n")).collect():
        ratios[r["label"]][r["cell"] / GRID] = r["n"]
    model.threshold = _threshold(ratios["allow"], ratios["block"])
    return model


def judged(pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", **settings) -> DataFrame:
    """``pages`` with host, path, rule, ratio (null where a rule decides) and verdict."""
    model = train(pages, rules, url=url, **settings)
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    out = out.withColumn("rule", rule_of(rules, F.col("host"), F.col("path")))
    open_ = F.col("rule").isNull() & (F.col("host") != "")
    if model is None:
        out = out.withColumn("ratio", F.lit(None).cast("double"))
    else:
        out = out.withColumn("ratio", F.when(open_, _ratio_of(model, named_labels(rules), pages, F.col("host"), F.concat("path", query_of(F.col(url))))))
    verdict = F.when(F.col("ratio") < F.lit(model.threshold if model else 0.0), F.lit("block")).otherwise(F.lit("allow"))
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(verdict)
    return out.withColumn("verdict", verdict)
