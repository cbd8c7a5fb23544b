"""Statistics of whole texts that the quality classifier and the quality rules learn from."""

from collections import Counter
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm.texts import arrow_rows

_WHITE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_LATER_BYTES = bytes(range(0x80, 0xC0))  # all but the first byte of a character
_UPPER, _LOWER, _DIGITS = (
    bytes(range(first, last + 1)) for first, last in (b"AZ", b"az", b"09")
)
_MARKS = b"!?"
_STOPS = b".,;:"
WINDOW = 5

STATISTICS = (
    "log_words",
    "word_length",
    "symbols",
    "marks",
    "stops",
    "upper",
    "digits",
    "other",
    "bars",
    "line_words",
    "dup_lines",
    "repeat_words",
    "same_as_last",
    "new_words",
    "short_words",
    "capital_words",
)


@dataclass(frozen=True)
class Counts:
    """Whole-text counts; words are runs of characters other than ASCII white space."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int


def _size_without(text: bytes, dropped: bytes) -> int:
    return len(text.translate(None, dropped))


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window of words which occurs twice or more, the first one included."""
    windows = list(zip(*(words[i:] for i in range(window)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = end = 0
    for start, found in enumerate(windows):
        if found in often:
            covered += start + window - max(start, end)
            end = start + window
    return covered


def count(text: bytes, words: list[bytes]) -> Counts:
    lines = [line for line in text.split(b"\n") if line.strip()]
    return Counts(
        n_words=len(words),
        word_chars=_size_without(text, _WHITE + _LATER_BYTES),
        n_symbols=len(text) - _size_without(text, _SYMBOLS),
        n_dup_lines=len(lines) - len(set(lines)),
        n_repeat_words=repeated_words(words),
    )


def describe(text: bytes) -> tuple[Counts, list[float]]:
    """Counts, and statistics in the order of ``STATISTICS``.

    Shares enter as square roots, which spreads the values near zero. A text without words has
    zeros only.
    """
    words = text.split()
    counts = count(text, words)
    n = len(words)
    if not n:
        return counts, [0.0] * len(STATISTICS)
    size = len(text)

    def share(of: bytes) -> float:
        return (size - _size_without(text, of)) / size

    upper, lower = share(_UPPER), share(_LOWER)
    symbols, marks, stops, digits = share(_SYMBOLS), share(_MARKS), share(_STOPS), share(_DIGITS)
    known = upper + lower + symbols + marks + stops + digits + share(_WHITE)
    later = share(_LATER_BYTES)
    lines = 1 + text.count(b"\n")
    shares = {
        "symbols": symbols,
        "marks": marks,
        "stops": stops,
        "upper": upper / (upper + lower + 1e-9),
        "digits": digits,
        "other": max(0.0, 1 - known - 2 * later),
        "bars": text.count(b"|") / size,
        "dup_lines": counts.n_dup_lines / lines,
        "repeat_words": counts.n_repeat_words / n,
        "same_as_last": sum(a == b for a, b in pairwise(words)) / n,
        "new_words": len(set(words)) / n,
        "short_words": sum(len(w) < 4 for w in words) / n,
        "capital_words": sum(map(bytes.isupper, words)) / n,
    }
    plain = {
        "log_words": np.log1p(n),
        "word_length": np.log1p(counts.word_chars / n),
        "line_words": np.log1p(n / lines),
    }
    roots = {name: value**0.5 for name, value in shares.items()}
    return counts, [float((plain | roots)[name]) for name in STATISTICS]


def matrix(texts: list[bytes]) -> tuple[list[Counts], np.ndarray]:
    """Counts and statistics of some texts; one row of the array per text."""
    both = [describe(text) for text in texts]
    values = np.array([x for _, x in both]).reshape(len(texts), len(STATISTICS))
    return [c for c, _ in both], values


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Statistics and labels of at most ``rows`` labelled documents, to fit a model on.

    Takes the documents whose hashed id is smallest, so reruns agree. Documents whose crc32 of the
    id as text is a multiple of 5 are held out, and so are those with contradicting labels. ``rows``
    bounds what reaches the driver: that many rows of a few numbers.
    """
    key = F.crc32(F.col("doc_id").cast("string"))
    chosen = (
        labels.select("doc_id", F.col(label).alias("_label"))
        .filter(F.col("_label").isin(0, 1) & (key % 5 != 0))
        .groupBy("doc_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .filter(F.col("_label") == F.col("_other"))
        .select("doc_id", "_label")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    wanted = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # ``rows`` rows

    def make(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(list(matrix(texts)[1]), pa.list_(pa.float64()))]

    found = arrow_rows(wanted, ["doc_id", "_label"], "text", make, "stats array<double>")
    got = (
        found.orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("stats")).limit(rows).collect()
    )
    values = np.array([r["stats"] for r in got]).reshape(len(got), len(STATISTICS))
    return values, np.array([r["_label"] for r in got], dtype=int)
