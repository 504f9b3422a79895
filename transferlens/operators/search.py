"""Fuzzy search of tokens by symbol and name, with Spark's own levenshtein."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOL_WEIGHT = 2.0
NAME_WEIGHT = 1.0


def terms(text: Column | str) -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")


def allowed_edits(term: str) -> int:
    """Edits a query term may need: none up to 2 characters, one up to 5, else two."""
    return 0 if len(term) <= 2 else 1 if len(term) <= 5 else 2


def _closeness(term: str) -> Callable[[Column], Column]:
    def score(word: Column) -> Column:
        distance = F.levenshtein(word, F.lit(term), allowed_edits(term))
        return F.when(distance >= 0, 1.0 - distance / F.lit(float(len(term)))).otherwise(0.0)

    return score


def _field_score(field: Column, query: list[str]) -> Column:
    best = [F.coalesce(F.array_max(F.transform(field, _closeness(t))), F.lit(0.0)) for t in query]
    return sum(best, F.lit(0.0))


def fuzzy_search(tokens: DataFrame, query: str, size: int = 10) -> DataFrame:
    """Best ``size`` tokens for ``query``: the better of the weighted symbol and name scores.

    Each query term scores its closest word in the field; one scan and a per-task top-n.
    """
    wanted = [t for t in re.split(r"[\W_]+", query.lower()) if t]
    score = F.greatest(
        _field_score(terms("symbol"), wanted) * SYMBOL_WEIGHT,
        _field_score(terms("token_name"), wanted) * NAME_WEIGHT,
    )
    return (
        tokens.withColumn("score", F.round(score, 6))
        .where(F.col("score") > 0)
        .orderBy(F.desc("score"), F.asc("token_address"))
        .limit(size)
        .select("token_address", "symbol", "token_name", "decimals", "score")
    )
