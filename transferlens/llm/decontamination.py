"""Benchmark decontamination by spaced-seed hashing, in DataFrame functions only.

A seed is a fixed mask over consecutive tokens that ignores some places: two token runs that differ in ignored places only
have the same hash. The masks slide over every token of every training text and benchmark item; hashes are joined, and
around each hit the two texts are laid side by side without gaps. An overlap is a window of ``WINDOW`` tokens that holds the hit
and in which at most ``WINDOW`` - ``LEAST`` tokens differ, so a passage is found although words in it were substituted.

The first mask has period 3: whatever two tokens of a window are substituted, one of its three placements in the window
avoids both, so every overlap of ``WINDOW`` tokens with at most two substitutions is found. The second mask adds overlaps whose
substitutions are bunched. An item of ``SPAN`` tokens has one placement only; the third mask, without the end places and used for
such items alone, finds it when its first or last token was substituted. Items of ``least_item`` to ``SPAN`` - 1 tokens, if asked
for, are sought by the hash of their whole run of tokens, and have to be there as they are.

One pass over the documents does it all: the tokens' hashes are laid side by side by ``arrays_zip``, so each row that meets the
benchmark carries its surroundings and is verified where it is. No text is shuffled. What is broadcast is counted first: up to
``BROADCAST`` placements of the benchmark go out with their surroundings and nothing of the documents is shuffled; up to
``BROADCAST_HASHES`` distinct hashes go out alone, and only the placements that they keep are shuffled to the benchmark's; beyond that
all placements are.

Defined cases: null and empty texts and texts of fewer tokens than a window have no overlap and are kept; so do benchmark items
of fewer tokens than ``least_item``, and items shorter than a window are windows themselves. Tokens are lower-cased runs without ASCII
punctuation, space and control characters. Rows that repeat an id count as one document if their texts are equal, else as several.
Items of equal tokens are sought once and reported under each of their ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferlens.llm.common import unused, whole
from transferlens.session import stored

#: Places that count, of each mask; both span ten tokens.
MASKS = ((0, 3, 6, 9), (0, 1, 4, 8, 9))
SPAN = 10
#: Of items of ``SPAN`` tokens.
INNER = tuple(range(1, SPAN - 1))
WINDOW = 12
LEAST = 10
#: Least tokens of an item that documents of a corpus are searched for; shorter runs stand in clean texts too.
SHORT_ITEM = 5
#: Benchmark placements up to which they are broadcast with their surroundings (about 160 bytes each), distinct hashes alone (about
#: 50 bytes each; 4 million are those of about 2 million benchmark tokens), and found documents (about 40 bytes each).
BROADCAST = 250_000
BROADCAST_HASHES = 4_000_000
BROADCAST_FOUND = 1_000_000
#: Places around a hit that its windows reach.
LANES = range(SPAN - WINDOW, WINDOW)


def tokens(text: Column) -> Column:
    """64-bit hashes of the tokens."""
    words = F.split(F.lower(whole(text)), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _lane(place: int) -> str:
    return f"t{place}".replace("-", "m")


def _masks(least_item: int) -> dict[int, tuple[int, ...]]:
    """Places by mask; masks behind those of ``SPAN`` tokens are whole runs of fewer tokens."""
    return dict(enumerate((*MASKS, INNER, *[tuple(range(n)) for n in range(least_item, SPAN)])))


def _span(mask: int, places: tuple[int, ...]) -> int:
    return SPAN if mask <= len(MASKS) else len(places)


def _seeds(df: DataFrame, keys: list[str], at: str, size: str, masks: dict[int, tuple[int, ...]]) -> DataFrame:
    """(keys, size, at, lanes, mask, hash): every placement of every mask, with the tokens around it (null beyond the ends)."""
    span = min(_span(*m) for m in masks.items())
    before, after = [F.array_repeat(F.lit(None).cast("long"), WINDOW - n) for n in (SPAN, span)]
    n = F.size("tokens") - (span - 1)
    padded = df.filter(F.size("tokens") >= span).select(*keys, n.alias("n"), F.concat(before, "tokens", after).alias("padded"))
    lanes = F.arrays_zip(*[F.slice("padded", k + 1, F.col("n")).alias(_lane(place)) for k, place in enumerate(LANES)])
    rows = padded.select(*keys, (F.col("n") + span - 1).alias(size), F.posexplode(lanes).alias(at, "lane")).select(*keys, size, at, "lane.*")

    def seed(mask: int, places: tuple[int, ...]) -> Column:
        return F.struct(F.lit(mask).alias("mask"), F.xxhash64(F.lit(mask), *[_lane(p) for p in places]).alias("hash"))

    placed = F.array(*[F.when(F.col(at) + _span(*m) <= F.col(size), seed(*m)) if _span(*m) > span else seed(*m) for m in masks.items()])
    return rows.select("*", F.inline(F.filter(placed, lambda x: x.isNotNull()) if len({_span(*m) for m in masks.items()}) > 1 else placed))


def _class(benchmark: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """Items with their tokens and, as ``item``, what items of equal tokens share."""
    items = benchmark.select(F.col(item_id).alias("item_id"), tokens(F.col(item_text)).alias("tokens"))
    return items.withColumn("item", F.struct(F.xxhash64("tokens").alias("a"), F.xxhash64(F.lit(1), "tokens").alias("b")))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    least_item: int = SPAN,
) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, first_token, matched_tokens): verified overlaps of a document and an item.

    ``matched_tokens`` is the largest number of equal tokens in a window, ``first_token`` the first place in the document. Items of
    fewer than ``SPAN`` tokens are sought from ``least_item`` tokens on.
    """
    items, masks, inner = _class(benchmark, item_id, item_text), _masks(least_item), len(MASKS)
    seeds = _seeds(items.dropDuplicates(["item"]), ["item"], "q", "m", masks)
    whole_run = (F.col("mask") > inner) & (F.col("m") == F.col("mask") - inner - 1 + least_item) & (F.col("q") == 0)
    seeds = seeds.filter((F.col("mask") < inner) | ((F.col("mask") == inner) & (F.col("m") == SPAN)) | whole_run)
    seeds = stored(seeds.withColumnsRenamed({_lane(p): f"i_{_lane(p)}" for p in LANES}), "decontamination-seeds")
    small = seeds.count() <= BROADCAST
    texts = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(whole(F.col(text))).alias("text_hash"), tokens(F.col(text)).alias("tokens")
    )
    rare = {r["mask"] for r in seeds.filter(F.col("mask") >= inner).select("mask").distinct().collect()}  # at most SPAN
    runs = _seeds(texts, ["doc_id", "text_hash"], "p", "n", {m: places for m, places in masks.items() if m < inner or m in rare})
    if not small:
        hashes = seeds.select("hash").distinct()
        if hashes.count() <= BROADCAST_HASHES:
            runs = runs.join(F.broadcast(hashes), "hash", "left_semi")
    hits = runs.join(F.broadcast(seeds) if small else seeds, ["mask", "hash"])
    windows = F.filter(F.array(*[_window(back) for back in range(WINDOW - SPAN + 1)]), lambda w: w["equal"] >= w["least"])
    good = hits.select("doc_id", "text_hash", "item", F.inline(windows)).select("doc_id", "text_hash", "item", "at", "equal").distinct()
    found = good.groupBy("doc_id", "text_hash", "item").agg(
        F.count("*").alias("n_windows"), F.min("at").cast("long").alias("first_token"), F.max("equal").cast("long").alias("matched_tokens")
    )
    members = items.select("item", "item_id").distinct()
    return found.join(members, "item").select("doc_id", "text_hash", "item_id", "n_windows", "first_token", "matched_tokens")


def _window(back: int) -> Column:
    """The window that begins ``back`` places before the hit: its start in the document, equal tokens, and how many it needs."""
    start, begin = F.col("p") - back, F.col("q") - back
    length = F.least(F.lit(WINDOW), F.col("m"))
    inside = (start >= 0) & (begin >= 0) & (start + length <= F.col("n")) & (begin + length <= F.col("m"))
    equal = F.lit(0)
    for k in range(WINDOW):
        lane = _lane(k - back)
        equal = equal + F.when((F.lit(k) < length) & (F.col(lane) == F.col(f"i_{lane}")), 1).otherwise(0)
    least = F.when(length == WINDOW, F.lit(LEAST)).when(length < SPAN, length).otherwise(F.ceil(length * (LEAST / WINDOW)).cast("int"))
    return F.struct(start.alias("at"), F.when(inside, equal).otherwise(F.lit(-1)).alias("equal"), least.alias("least"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **names) -> DataFrame:
    """One row per document that holds a passage of the benchmark: its items, how many, and its strongest overlap."""
    return (
        overlaps(docs, benchmark, **names)
        .groupBy("doc_id", "text_hash")
        .agg(
            F.array_sort(F.collect_set("item_id")).alias("item_ids"),
            F.sum("n_windows").alias("n_windows"),
            F.min("first_token").alias("first_token"),
            F.max("matched_tokens").alias("matched_tokens"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """The rows of ``docs`` without such a passage; columns as they came, whatever their names. Equal items are sought once."""
    benchmark = benchmark.dropDuplicates([names.get("item_text", "text")])
    bad_id, bad_hash = unused(docs, "_bad_id"), unused(docs, "_bad_hash")
    bad = contaminated(docs, benchmark, doc_id=doc_id, text=text, **names).select(F.col("doc_id").alias(bad_id), F.col("text_hash").alias(bad_hash))
    bad = stored(bad, "decontamination-found")
    bad = F.broadcast(bad) if bad.count() <= BROADCAST_FOUND else bad
    same = F.col(doc_id).eqNullSafe(F.col(bad_id)) & (F.xxhash64(whole(F.col(text))) == F.col(bad_hash))
    return docs.join(bad, same, "left_anti")
