"""Toxicity by a convolutional text classifier.

Words and their first ``PREFIX`` bytes are hashed to buckets with learned embeddings, of which a word has the sum: a word form
never seen still shares its stem. Filters of several widths slide over the whole text, each filter
keeps its maximum, and a logistic layer turns the maxima into a logit. All labelled rows are learned from. They are dealt by a
hash of their id into parts of about 2 * ``per_class`` rows; in each of ``ROUNDS`` rounds every part trains the common model on its
own rows in plain numpy (Adam, gradients through the maxima only, each row in turn) and the changes are averaged. One row in
``CALIBRATION`` is kept from the fit: on all of these the logit is calibrated to a probability, and a threshold is chosen
for each language. Language, source, id and labels are no inputs of the score; the language picks the threshold only.

The filters are linear up to the maximum, so scoring needs no multiplication: embedding times filter is tabulated once
per worker for each bucket with an embedding of its own, and a text costs a few table look-ups per word. Long texts are cut into overlapping runs
whose maxima are combined, so memory is bounded by the run, not by the text, and nothing is cut off. Buckets seen in
fewer than ``least_docs`` documents of the fit share one embedding, which then also stands for words never seen.

Defined cases: null and empty texts are scored like a text of padding only. Rows without a label are not learned from.
With labels of one class only, or none, every score is that class's share (0 without labels). Languages with few
calibration rows, and null, use the threshold of all languages. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.session import stored

#: Leading bytes of a word that have a bucket of their own.
PREFIX = 4
_WORD = re.compile(rb"[a-z0-9\x80-\xff]+")
#: One labelled row in so many calibrates.
CALIBRATION = 4
#: Rounds of training on the parts, and cells of a logit of 1 in which calibration rows are counted.
ROUNDS = 4
GRID = 64
#: A language's own threshold needs as many calibration rows of either class.
LEAST_ROWS = 20
_RUN = 1 << 16
_CACHE = 1 << 15
_ROWS = 500


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    size: int = 16
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 12
    per_class: int = 1500  # half the rows of a part
    steps: int = 700
    batch: int = 32
    rate: float = 0.005
    decay: float = 1e-4
    dropout: float = 0.15
    least_docs: int = 3
    seed: int = 7


@dataclass
class Model:
    settings: Settings
    embedding: np.ndarray
    filters: list[np.ndarray]  # of each width: (width, size, filters)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def tables(self) -> list[list[np.ndarray]]:
        return [[np.ascontiguousarray(self.embedding @ f) for f in filters] for filters in self.filters]


_seen: dict[bytes, int] = {}


def _hashes(word: bytes) -> int:
    """Of the word in the low 32 bits, of its beginning in the high ones: one number takes less memory than a pair."""
    return zlib.crc32(b"^" + word[:PREFIX]) << 32 | zlib.crc32(word)


def token_ids(text: str | None, buckets: int) -> np.ndarray:
    """(words, 2): buckets 2.. of the lower-cased words and of their prefixes; punctuation does not count.

    Bucket 0 is padding, 1 stands for what is rare.
    """
    words = _WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    if len(_seen) > _CACHE:
        _seen.clear()
    get = _seen.get
    out = [get(w) or _seen.setdefault(w, _hashes(w)) for w in words]
    both = np.array(out, dtype="<u8").view("<u4").reshape(-1, 2)
    return (both % np.uint32(buckets - 2) + np.uint32(2)).astype(np.int32)


def _padded(ids: np.ndarray, widest: int) -> list[np.ndarray]:
    """Runs of a text that overlap by all but one of the widest filter's places, with padding at the end."""
    ids = np.concatenate([ids, np.zeros((widest, 2), dtype=np.int32)])
    return [ids[at : at + _RUN] for at in range(0, max(1, len(ids) - widest), _RUN - widest)]


def _narrowed(model: Model, used: np.ndarray) -> tuple[Model, np.ndarray]:
    """``model`` with the embeddings of the buckets ``used`` only, padding and the rare among them, and each bucket's row there."""
    used = used.copy()
    used[:2] = True
    rows = np.where(used, np.cumsum(used) - 1, 1).astype(np.int32)
    return replace(model, embedding=model.embedding[used]), rows


def _for_scoring(model: Model) -> tuple[Model, np.ndarray]:
    """Buckets with the embedding of the rare ones share one row, so that a worker's tables hold what was learned and no more."""
    if model.constant is not None:
        return model, np.zeros(0, dtype=np.int32)
    return _narrowed(model, (model.embedding != model.embedding[1]).any(axis=1))


def maxima(model: Model, tables: list[list[np.ndarray]], texts: list[np.ndarray]) -> np.ndarray:
    """For each text the maximum of every filter."""
    widths, n_filters = model.settings.widths, model.settings.filters
    widest = max(widths)
    out = np.full((len(texts), len(widths) * n_filters), -np.inf, dtype=np.float32)
    runs = [(row, run) for row, ids in enumerate(texts) for run in _padded(ids, widest)]
    at = 0
    while at < len(runs):
        end, total = at, 0
        while end < len(runs) and (end == at or total + len(runs[end][1]) <= _RUN):
            total += len(runs[end][1])
            end += 1
        owners = [row for row, _ in runs[at:end]]
        ids = np.concatenate([run for _, run in runs[at:end]])
        lengths = np.array([len(run) for _, run in runs[at:end]])
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        for k, (width, table) in enumerate(zip(widths, tables, strict=True)):
            values = table[0][ids[:, 0]]
            values += table[0][ids[:, 1]]
            for place in range(1, width):
                for column in (0, 1):
                    values[: len(ids) - place] += table[place][ids[place:, column]]
            if width > 1:  # windows that would reach into the next text
                tail = np.concatenate([starts + lengths - place for place in range(1, width)])
                values[tail] = -np.inf
            best = np.maximum.reduceat(values, starts, axis=0)
            np.maximum.at(out, (np.array(owners)[:, None], np.arange(k * n_filters, (k + 1) * n_filters)[None, :]), best)
        at = end
    return out


def logits(model: Model, tables: list[list[np.ndarray]], texts: list[np.ndarray]) -> np.ndarray:
    hidden = np.maximum(maxima(model, tables, texts) + model.bias, 0)
    return hidden @ model.weights + model.offset


def scores(model: Model, tables: list[list[np.ndarray]], texts: list[np.ndarray]) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    return _scaled(model, logits(model, tables, texts).astype(np.float64))


def _scaled(model: Model, logit: np.ndarray) -> np.ndarray:
    a, b = model.scale
    return 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))


class _Adam:
    def __init__(self, shape, rate: float) -> None:
        self.rate, self.t = rate, 0
        self.m, self.v = np.zeros(shape, np.float32), np.zeros(shape, np.float32)

    def step(self, value: np.ndarray, grad: np.ndarray, rows=slice(None)) -> None:
        self.t += 1
        self.m[rows] = 0.9 * self.m[rows] + 0.1 * grad
        self.v[rows] = 0.99 * self.v[rows] + 0.01 * grad * grad
        value[rows] -= self.rate * (self.m[rows] / (1 - 0.9**self.t)) / (np.sqrt(self.v[rows] / (1 - 0.99**self.t)) + 1e-8)


def start(settings: Settings) -> Model:
    """The model before training."""
    rng = np.random.default_rng(settings.seed)
    size, n_filters, widths = settings.size, settings.filters, settings.widths
    embedding = rng.normal(0, 0.1, (settings.buckets, size)).astype(np.float32)
    embedding[0] = 0
    filters = [rng.normal(0, 0.5 / np.sqrt(w), (w, size, n_filters)).astype(np.float32) for w in widths]
    hidden = len(widths) * n_filters
    weights = rng.normal(0.2, 0.1, hidden).astype(np.float32)
    return Model(settings, embedding, filters, np.full(hidden, -0.1, np.float32), weights, 0.0)


def _shown_in_turn(rng: np.random.Generator, rows: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """``n`` rows at a time without end; all come before one comes again."""
    left = np.zeros(0, dtype=np.int64)
    while True:
        while len(left) < n:
            left = np.concatenate([left, rng.permutation(rows)])
        yield left[:n]
        left = left[n:]


def fit(model: Model, texts: list[np.ndarray], labels: np.ndarray, steps: int, seed: int) -> Model:
    """``model`` trained further on token ids; classes are shown equally often, every text at least once."""
    settings = model.settings
    rng = np.random.default_rng([settings.seed, seed])
    size, n_filters, widths = settings.size, settings.filters, settings.widths
    embedding, filters = model.embedding.copy(), [f.copy() for f in model.filters]
    bias, weights, offset = model.bias.copy(), model.weights.copy(), np.array([model.offset], np.float32)
    adams = [_Adam(embedding.shape, settings.rate), *(_Adam(f.shape, settings.rate) for f in filters)]
    rest = [(v, _Adam(v.shape, settings.rate)) for v in (bias, weights, offset)]
    groups = [g for g in (np.flatnonzero(labels == c) for c in (0, 1)) if len(g)]
    shown = [_shown_in_turn(rng, g, settings.batch // len(groups)) for g in groups]
    widest = max(widths)
    for _ in range(max(steps, math.ceil(max(map(len, groups)) / (settings.batch // len(groups))))):  # no text is left out
        rows = np.concatenate([next(s) for s in shown])
        parts = []
        for r in rows:
            ids = texts[r]
            parts.append(np.concatenate([ids[rng.random(len(ids)) >= settings.dropout], np.zeros((widest, 2), np.int32)]))
        ids = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        starts = np.concatenate(([0], ends[:-1]))
        x = embedding[ids[:, 0]] + embedding[ids[:, 1]]
        places, best = [], []
        for width, f in zip(widths, filters, strict=True):
            n = len(ids) - width + 1
            conv = sum(x[j : n + j] @ f[j] for j in range(width))
            where = np.stack([s + conv[s : e - width + 1].argmax(axis=0) for s, e in zip(starts, ends, strict=True)])
            places.append(where)
            best.append(conv[where, np.arange(n_filters)[None, :]])
        top = np.concatenate(best, axis=1) + bias
        h = np.maximum(top, 0)
        p = 1 / (1 + np.exp(-np.clip(h @ weights + offset, -30, 30)))
        g = ((p - labels[rows]) / len(rows)).astype(np.float32)
        dh = np.where(top > 0, g[:, None] * weights[None, :], 0).astype(np.float32)
        touched, changes = [], []
        for k, (width, f) in enumerate(zip(widths, filters, strict=True)):
            part, where = dh[:, k * n_filters : (k + 1) * n_filters], places[k]
            grad = settings.decay * f
            for j in range(width):
                at = where + j
                grad[j] += np.einsum("bfs,bf->sf", x[at], part)
                change = (part[:, :, None] * f[j].T[None]).reshape(-1, size)
                for column in (0, 1):
                    touched.append(ids[at, column].ravel())
                    changes.append(change)
            adams[k + 1].step(f, grad)
        touched, changes = np.concatenate(touched), np.concatenate(changes)
        own, inverse = np.unique(touched, return_inverse=True)
        total = np.zeros((len(own), size), np.float32)
        np.add.at(total, inverse, changes)
        total += settings.decay * embedding[own]
        total[own == 0] = 0
        adams[0].step(embedding, total, own)
        for (value, adam), grad in zip(rest, (dh.sum(axis=0), h.T @ g + settings.decay * weights, np.array([g.sum()])), strict=True):
            adam.step(value, grad.astype(np.float32))
    return Model(settings, embedding, filters, bias, weights, float(offset[0]))


def _platt(logit: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit, slightly drawn to (1, 0)."""
    a, b = 1.0, 0.0

    def loss(a: float, b: float) -> float:
        z = a * logit + b
        return float((weight * (np.logaddexp(0, z) - labels * z)).sum() + 0.025 * (a - 1) ** 2 + 0.005 * b * b)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -40, 40)))
        r, w = weight * (p - labels), weight * p * (1 - p) + 1e-9
        grad = np.array([(r * logit).sum() + 0.05 * (a - 1), r.sum() + 0.01 * b])
        hess = np.array([[(w * logit * logit).sum() + 0.05, (w * logit).sum()], [(w * logit).sum(), w.sum() + 0.01]])
        change, part = np.linalg.solve(hess, grad), 1.0
        while part > 1e-6 and loss(a - part * change[0], b - part * change[1]) > loss(a, b):
            part /= 2
        a, b = a - part * change[0], b - part * change[1]
        if np.abs(change).max() * part < 1e-8:
            break
    return float(max(a, 0.05)), float(b)


def best_threshold(score: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the largest weighted F1, in the middle of the gap below it."""
    order = np.argsort(-score, kind="stable")
    s, positive, w = score[order], labels[order] == 1, weight[order]
    hit, taken = np.cumsum(w * positive), np.cumsum(w)
    f1 = 2 * hit / (taken + (w * positive).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    k = int(f1.argmax())
    return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)


def _dense(model: Model) -> np.ndarray:
    """All parameters but the embedding."""
    return np.concatenate([*(f.ravel() for f in model.filters), model.bias, model.weights, [model.offset]]).astype(np.float32)


def _with_parameters(model: Model, embedding: np.ndarray, dense: np.ndarray) -> Model:
    ends = np.cumsum([f.size for f in model.filters] + [model.bias.size, model.weights.size])
    *filters, bias, weights, offset = np.split(dense.astype(np.float32), ends)
    filters = [f.reshape(own.shape) for f, own in zip(filters, model.filters, strict=True)]
    return Model(model.settings, embedding, filters, bias, weights, float(offset[0]))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """Number, token ids and labels of each part."""
    for batch in batches:
        for k in range(batch.num_rows):
            ids, sizes, labels = (zlib.decompress(batch[name][k].as_buffer()) for name in ("ids", "sizes", "labels"))
            ends = np.cumsum(np.frombuffer(sizes, dtype=np.int64))
            ids = np.frombuffer(ids, dtype=np.int32).reshape(-1, 2)
            yield batch["part"][k].as_py(), np.split(ids, ends[:-1]), np.frombuffer(labels, dtype=np.int32)


def _rare(parts: DataFrame, settings: Settings) -> np.ndarray:
    """Buckets seen in fewer than ``least_docs`` of all documents of the fit."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(settings.buckets, dtype=np.int64)
        for _, texts, _ in _rows(batches):
            for ids in texts:
                seen[np.unique(ids)] += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], ["bucket", "n"])

    found = parts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    rare = np.ones(settings.buckets, dtype=bool)
    rare[found["bucket"].to_numpy()[found["n"].to_numpy() >= settings.least_docs]] = False
    rare[:2] = False
    return rare


def _round(parts: DataFrame, n_parts: int, model: Model, rare: np.ndarray, number: int, steps: int) -> Model:
    """Each part trains on its own from ``model``; the changes are averaged, those of an embedding over the parts that saw it."""
    shared = parts.sparkSession.sparkContext.broadcast((model, rare))
    slices = min(64, n_parts)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, unknown = shared.value
        for part, texts, labels in _rows(batches):
            used = np.zeros(len(unknown), dtype=bool)
            for ids in texts:
                used[ids] = True
            # a text of rare and unseen buckets trains row 1, padding is row 0; rows of no text can't change
            before, rows = _narrowed(own, used & ~unknown)
            after = fit(before, [rows[ids] for ids in texts], labels, steps, number * n_parts + part)
            change = after.embedding - before.embedding
            used[:2] = True
            keys, moved = np.flatnonzero(used & ~unknown), change.any(axis=1)
            keys, change = keys[moved], change[moved]
            out = [(0, b"", (_dense(after) - _dense(own)).tobytes())]
            out += [(1 + k, keys[keys % slices == k].tobytes(), change[keys % slices == k].tobytes()) for k in range(slices)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], ["slice", "keys", "change"])

    def add(rows: pa.Table) -> pa.Table:
        name = rows["slice"][0].as_py()
        if name == 0:
            changes = [np.frombuffer(c, dtype=np.float32).astype(np.float64) for c in rows["change"].to_pylist()]
            mean, keys = np.mean(changes, axis=0).astype(np.float32), b""
        else:
            total, seen = np.zeros((own_buckets, size)), np.zeros(own_buckets, dtype=np.int64)
            for at, change in zip(rows["keys"], rows["change"], strict=True):
                at = np.frombuffer(at.as_buffer(), dtype=np.int64) // slices
                total[at] += np.frombuffer(change.as_buffer(), dtype=np.float32).reshape(-1, size)
                seen[at] += 1
            at = np.flatnonzero(seen)
            mean, keys = (total[at] / seen[at, None]).astype(np.float32), (at * slices + name - 1).tobytes()
        return pa.table({"slice": [name], "keys": pa.array([keys], pa.binary()), "change": pa.array([mean.tobytes()], pa.binary())})

    size, own_buckets = model.settings.size, model.settings.buckets // slices + 1
    kinds = "slice long, keys binary, change binary"
    embedding, dense = model.embedding.copy(), _dense(model)
    for row in parts.mapInArrow(learn, kinds).groupBy("slice").applyInArrow(add, kinds).toArrow().to_pylist():
        change = np.frombuffer(row["change"], dtype=np.float32)
        if row["slice"] == 0:
            dense = dense + change
        else:
            embedding[np.frombuffer(row["keys"], dtype=np.int64)] += change.reshape(-1, size)
    shared.unpersist()
    return _with_parameters(model, embedding, dense)


def train(
    docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), *, doc_id="doc_id", text="text", lang="lang", label="toxic"
) -> Model:
    """Model of all rows of ``docs`` that ``labels`` marks by id.

    An id counts once: of its labels the largest, of its texts the smallest.
    """
    spark = docs.sparkSession
    marks = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    rows = rows.join(marks, F.col("doc_id") == F.col("_id"))
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text"), F.min_by("lang", "text").alias("lang"))
    rows = stored(rows.withColumn("probe", F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0), "toxicity-labelled")
    sums = {(r["label"], r["probe"]): r["n"] for r in rows.groupBy("label", "probe").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {c: sum(n for (own, _), n in sums.items() if own == c) for c in {own for own, _ in sums}}
    if len(counts) < 2:
        return Model(settings, *(np.zeros(0),) * 4, 0.0, constant=float(next(iter(counts), 0)))
    apart = len(sums) == 4  # with few rows a class may be on one side only: then all are learned from and calibrate
    learn, probe = (rows.filter(~F.col("probe")), rows.filter("probe")) if apart else (rows, rows)
    size = {c: sums[c, False] if apart else counts[c] for c in (0, 1)}
    n_parts = math.ceil(sum(size.values()) / (2 * settings.per_class))
    # a rare class is shown in several parts, so that none is without it
    times = F.lit(0)
    for c in (0, 1):
        times = F.when(F.col("label") == c, F.lit(min(n_parts, math.ceil(LEAST_ROWS * n_parts / size[c])))).otherwise(times)
    dealt = learn.select("doc_id", "label", "text", F.explode(F.sequence(F.lit(1), times)).alias("copy"))
    dealt = dealt.withColumn("part", F.pmod(F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(n_parts)) + F.col("copy") - 1, F.lit(n_parts)))

    def packed(own: pa.Table) -> pa.Table:  # compressed, since a part is a single value all the way to the file and back
        own = own.sort_by("doc_id")
        ids = [token_ids(t.as_py(), settings.buckets) for t in own["text"]]
        blob = {"ids": np.concatenate(ids), "sizes": np.array([len(i) for i in ids], np.int64), "labels": own["label"].to_numpy().astype(np.int32)}
        return pa.table({"part": [own["part"][0].as_py()], **{k: pa.array([zlib.compress(v, 1)], pa.binary()) for k, v in blob.items()}})

    kinds = "part long, ids binary, sizes binary, labels binary"
    parts = stored(dealt.repartition(n_parts, "part").groupBy("part").applyInArrow(packed, kinds), "toxicity-parts")  # a file each, read by every round
    rare, model = _rare(parts, settings), start(settings)
    for number in range(ROUNDS):
        model = _round(parts, n_parts, model, rare, number, settings.steps * (number + 1) // ROUNDS - settings.steps * number // ROUNDS)
    model.embedding[rare] = model.embedding[1]
    return _calibrate(model, probe, counts)


def _calibrate(model: Model, probe: DataFrame, counts: dict[int, int]) -> Model:
    """Scale and thresholds from all calibration rows, counted by language, label and logit (to 1 / ``GRID``)."""
    cell = F.round(F.least(F.greatest(_logit("text", model, probe), F.lit(-60.0)), F.lit(60.0)) * GRID).cast("int").alias("cell")
    found = probe.select("lang", "label", cell).groupBy("lang", "label", "cell").agg(F.count(F.lit(1)).alias("n")).toArrow().to_pandas()
    found = found.sort_values(["cell", "label", "lang"], kind="stable").reset_index(drop=True)
    labels, n = found["label"].to_numpy(), found["n"].to_numpy()
    logit = found["cell"].to_numpy() / GRID
    weight = n * np.array([counts[c] / n[labels == c].sum() for c in (0, 1)])[labels]
    weight = weight / (weight.sum() / n.sum())
    model.scale = _platt(logit, labels, weight)
    score = _scaled(model, logit)
    model.threshold = best_threshold(score, labels, weight)
    for name, at in found.groupby("lang").indices.items():
        if min(n[at][labels[at] == c].sum() for c in (0, 1)) >= LEAST_ROWS:
            model.thresholds[str(name)] = best_threshold(score[at], labels[at], weight[at])
    return model


def _logit(text: str, model: Model, df: DataFrame) -> Column:
    return _of_texts(F.col(text), model, df, lambda *found: logits(*found).astype(np.float64))


def with_score(df: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """``df`` with the probability that the whole text is toxic."""
    return df.withColumn(name, _of_texts(F.col(text), model, df, scores))


def _of_texts(text: Column, model: Model, df: DataFrame, value: Callable[..., np.ndarray]) -> Column:
    """``value`` of the model, its tables and token ids, for a few rows at a time: neither texts nor ids of a whole batch are held."""
    shared = df.sparkSession.sparkContext.broadcast(_for_scoring(model))

    @F.arrow_udf("double")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own, rows = shared.value
        tables = own.tables() if own.constant is None else []
        for batch in batches:
            out = np.zeros(len(batch))
            for at in range(0, len(batch), _ROWS):
                texts = batch.slice(at, _ROWS).to_pylist()
                ids = [token_ids(t, own.settings.buckets) for t in texts]
                out[at : at + _ROWS] = value(own, tables, ids if own.constant is not None else [rows[i] for i in ids])
            yield pa.array(out)

    return found(text)


def threshold_of(model: Model, lang: Column) -> Column:
    out = F.lit(model.threshold)
    for name, value in model.thresholds.items():
        out = F.when(lang == name, F.lit(value)).otherwise(out)
    return out
