"""Quality rules on repetition: how much of a text lies in n-grams and lines it repeats.

Beside them stand a least number of words and a largest number of marks per word.

Words are the runs of ``[^\\x20\\x09-\\x0D]``. Each word becomes a 64-bit number and every
n-gram a polynomial of its words, rolled from one length to the next in numpy:
``H[n][i] = H[n-1][i] * base + word[i+n-1]``. An n-gram can only repeat where the shorter
one did, so a text without a repeated 3-gram costs one sort.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from addrloom.llm.rows import mapped, texts, whole_row

_BLANK = b" \t\n\r\x0b\x0c"
_NOT_FIRST_BYTES = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class RepetitionLimits:
    """Largest shares of a text's word characters (or lines) that may be repeated."""

    min_words: int = 50
    max_repeat_words_percent: int = 50
    # Marks like ``#`` and ``|`` per word.
    symbols_per_word: float = 0.5
    # Shares of characters inside n-grams that occurred before in the text, by n.
    ngram_chars: dict[int, float] = field(
        default_factory=lambda: {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
    )
    line_share: float = 0.30
    line_chars: float = 0.20


def _repeated(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur twice or more, and which occurred before."""
    again, later = np.zeros(len(values), bool), np.zeros(len(values), bool)
    sorted_ = np.sort(values)
    if (sorted_[1:] == sorted_[:-1]).any():
        order = np.argsort(values, kind="stable")
        sorted_ = values[order]
        same = sorted_[1:] == sorted_[:-1]
        later[order[1:][same]] = True
        again |= later
        again[order[:-1][same]] = True
    return again, later


def _covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in the n-grams that start at the given places."""
    edge = np.zeros(words + 1, np.int32)
    edge[starts] += 1
    edge[starts + n] -= 1  # starts are distinct, so are the ends
    return np.cumsum(edge[:-1]) > 0


def ngram_coverage(words: list[bytes], lengths: list[int]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each n of ``lengths`` (ascending) the words inside repeated n-grams: with and without the first ones."""
    values = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    found = {}
    starts, rolled, n = np.arange(len(words)), values, 1
    for length in lengths:
        while n < length:
            fits = starts + n < len(words)
            starts = starts[fits]
            rolled = rolled[fits] * _BASE + values[starts + n]
            n += 1
        again, later = _repeated(rolled)
        after_first = _covered(starts[later], length, len(words))
        starts, rolled = starts[again], rolled[again]
        found[length] = _covered(starts, length, len(words)), after_first
    return found


def measure(data: bytes | None, limits: RepetitionLimits) -> tuple:
    """All measures of one text and the verdict; null is a text without words."""
    data = data or b""
    words = data.split()
    word_chars = len(data.translate(None, _BLANK + _NOT_FIRST_BYTES))
    n_symbols = len(data) - len(data.translate(None, _SYMBOLS))
    seen: set[bytes] = set()
    n_lines = n_dup_lines = dup_line_chars = 0
    for line in data.split(b"\n"):
        if not line or line.isspace():
            continue
        n_lines += 1
        if line in seen:
            n_dup_lines += 1
            dup_line_chars += len(line.translate(None, _BLANK + _NOT_FIRST_BYTES))
        else:
            seen.add(line)
    cover = ngram_coverage(words, sorted({3, *limits.ngram_chars}))
    n_repeat_words = int(cover[3][0].sum())
    worst = 0.0
    within = True
    if cover[min(cover)][1].any():  # what repeats at any length does so at the shortest
        chars = np.fromiter((len(w.translate(None, _NOT_FIRST_BYTES)) for w in words), np.int64, len(words))
        for n, most in limits.ngram_chars.items():
            share = int(chars[cover[n][1]].sum()) / word_chars
            worst = max(worst, share)
            within &= share <= most
    within &= n_symbols <= limits.symbols_per_word * len(words)
    line_share = dup_line_chars / word_chars if word_chars else 0.0
    within &= n_dup_lines <= limits.line_share * n_lines and line_share <= limits.line_chars
    failed = len(words) < limits.min_words or 100 * n_repeat_words > limits.max_repeat_words_percent * len(words)
    return (
        len(words), word_chars, n_symbols, n_dup_lines, n_repeat_words, failed, bool(within and not failed), worst, line_share,
    )


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, kept boolean, worst_ngram_share double, dup_line_char_share double"
)


def repetition_measures(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limits: RepetitionLimits | None = None
) -> DataFrame:
    """One row per row of ``docs``: its id, the measures and whether it is kept.

    A null or empty text has no words and is rejected. Repeated rows give repeated
    results, a null id stays null, an empty table gives an empty one. A text is measured
    whole, whatever its length.
    """
    limits = limits or RepetitionLimits()
    rows = texts(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("data"))
    return mapped(rows, MEASURES, lambda data: measure(data, limits), ["doc_id"])


def keep_by_repetition(docs: DataFrame, text_col: str = "text", limits: RepetitionLimits | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns as they are.

    Rows with a null or empty text go, repeated rows fare alike. An empty
    table gives an empty one.
    """
    limits = limits or RepetitionLimits()
    judged = mapped(docs.select(whole_row(docs)), MEASURES, lambda data: measure(data, limits), ["row"], f"row.{text_col}")
    return judged.where("kept").select("row.*")
