"""Quality rules: compression bands.

A text that repeats itself compresses far better than prose, noise far worse. The zstandard ratio (bytes by compressed bytes) is
taken of the whole text and of fixed chunks of ``CHUNK`` bytes, and held against the band of the length's class: short texts compress
less, so the limits widen with the length. The whole-text verdict sees repetition at any distance that zstandard's window
covers; the chunks see a part that is out of band in a text that is fine on the whole: it is rejected if chunks with
``CHUNK_SHARE`` of its bytes or more are out of band. Texts below the first class have no band.

Before that stand exact base rules: fewer than 50 words, or over half of the words within 3-word windows that the text has twice.

Defined cases: null texts count as empty, and empty ones have no words, ratio null, and fail the base rules. A line counts as
repeated if an earlier line equals it and it has a word. Repeated rows get equal verdicts. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 4096
LEVEL = 3
#: From so many bytes on: (least ratio, largest ratio). Below the first there is no band. The limits lie just outside the range of the
#: clean texts of their class; where random lower-case letters (from 1,024 bytes on) or hex digits (from 4,096 on) compress worse than all
#: of these, between the two. Shorter ones compress like prose and are not told apart.
BANDS = (
    (256, 1.25, 2.1), (512, 1.4, 2.25), (724, 1.5, 2.4), (1024, 1.64, 2.6), (1448, 1.68, 2.7), (2048, 1.76, 2.85),
    (2896, 1.87, 3.4), (4096, 1.92, 3.4), (5793, 2.0, 3.4), (8192, 2.05, 3.4), (16384, 2.1, 3.4), (32768, 2.15, 3.4),
)
CHUNK_SHARE = 0.2
LEAST_WORDS = 50
REPEATED_PERCENT = 50
_SPACE = " \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_GAPS = re.compile(f"[{re.escape(_SPACE)}]")
_FIGURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, ratio double, bad_chunk_share double, in_band boolean"


def band(size: int) -> tuple[float, float] | None:
    found = None
    for least, low, high in BANDS:
        if size >= least:
            found = low, high
    return found


def _in_band(size: int, ratio: float) -> bool:
    limits = band(size)
    return limits is None or limits[0] <= ratio <= limits[1]


def compression(data: bytes, packer: zstandard.ZstdCompressor) -> tuple[float | None, float, bool]:
    """Ratio of the whole, share of bytes in chunks out of band, and the verdict."""
    if not data:
        return None, 0.0, True
    ratio = len(data) / len(packer.compress(data))
    bad = 0
    if len(data) > CHUNK:
        for at in range(0, len(data), CHUNK):
            chunk = data[at : at + CHUNK]
            if not _in_band(len(chunk), len(chunk) / len(packer.compress(chunk))):
                bad += len(chunk)
    share = bad / len(data)
    return ratio, share, _in_band(len(data), ratio) and share < CHUNK_SHARE


def repeated_words(words: list) -> int:
    """Words in 3-word windows that occur twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    names: dict = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), dtype=np.int64, count=len(words))
    if len(names) < 1 << 21:
        windows = ids[:-2] << 42 | ids[1:-1] << 21 | ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        pairs = np.unique(np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1), axis=0, return_inverse=True, return_counts=True)
        inverse, counts = pairs[1].ravel(), pairs[2]
    again = counts[inverse] > 1
    covered = np.zeros(len(words), dtype=bool)
    for k in range(3):
        covered[k : n + k] |= again
    return int(covered.sum())


def figures(text: str | None, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [line for line in text.split("\n") if line.strip(_SPACE)]
    symbols = len(data) - len(data.translate(None, _SYMBOLS))
    word_chars = len(text) - len(data) + len(data.translate(None, _SPACE.encode()))
    return (len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated_words(words), *compression(data, packer))


def with_verdict(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the base figures, the compression figures, ``base_failed`` and ``kept``."""

    @F.pandas_udf(_FIGURES)
    def measure(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = [column.split()[0] for column in _FIGURES.split(", ")]
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for part in texts:
            out = pd.DataFrame([figures(t, packer) for t in part], columns=names)
            yield out.astype({"ratio": "float64"})

    out = df.withColumn("_figures", measure(F.col(text))).select("*", "_figures.*").drop("_figures")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & F.col("in_band"))
