"""Weak supervision for document quality.

Each rule looks at counts of the whole text and votes good, votes bad or
abstains.  Expectation-maximisation over the vote patterns of all documents
estimates the share of good documents and every rule's accuracy on good and
on bad ones; a document's posterior probability of being good decides.  No
single rule can reject, and a rule that disagrees with the others counts less.

The pattern table has at most 3 ** len(RULES) rows (729 here) whatever the
number of documents; that table alone reaches the driver and is broadcast.

Null, empty or wordless text has all counts zero and fails the base check.
Repeated rows are judged each; very long texts are counted whole.  Only
``doc_id`` and ``text`` are read, so other columns may have any name.  An empty
table gives an empty result.  Five-word windows are told apart by 64-bit
hashes of a chunk's words, which are not verified word by word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, binary_array, give_back, id_type, pieces, stage, text_bytes, text_slices, words_of

#: Words of a window that counts as a repeat when found twice in a text.
WINDOW = 5
#: Documents with fewer words fail the base check.
MIN_WORDS = 10
#: Percentage of words in repeated windows above which the base check fails.
MAX_REPEAT_PERCENT = 20
#: Posterior probability of good quality from which a document is kept.
KEEP_FROM = 0.5
#: Bounds on estimated accuracies: a rule is better than chance, never certain.
ACCURACY = (0.55, 0.995)
ROUNDS = 200

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
          "n_marks")

# Characters that the contract counts as symbols.
SYMBOLS = "#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[0xC0:] = True  # the first byte of a character outside ASCII
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)

# (rule, good when, bad when); neither: it abstains.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols <= 0.05 * n_words", "n_symbols > 0.3 * n_words"),
    "repeats": ("n_repeat_words <= 0.05 * n_words", "n_repeat_words > 0.15 * n_words"),
    "lines": ("n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    "capitals": ("n_upper <= 0.2 * n_letters", "n_upper > 0.5 * n_letters"),
    "marks": ("n_marks <= 0.1 * n_words", "n_marks > 0.5 * n_words"),
    "word_length": ("word_chars between 2.5 * n_words and 14 * n_words",
                    "word_chars < 1.5 * n_words or word_chars > 20 * n_words"),
}


def _repeated(words: pa.Array, first: np.ndarray) -> np.ndarray:
    """Per row, words inside windows that the row holds twice or more."""
    total = len(words)
    if total < WINDOW:
        return np.zeros(len(first) - 1, np.int64)
    ids = words.dictionary_encode().indices.to_numpy().astype(np.uint64)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    n = total - WINDOW + 1
    key = row[:n].astype(np.uint64) * _MIX[5]
    for i in range(WINDOW):
        key = (key ^ (key >> np.uint64(29))) * _MIX[i] + ids[i:i + n]
    inside = row[:n] == row[WINDOW - 1:]
    at = np.flatnonzero(inside)
    twice = at[pd.Series(key[at]).duplicated(keep=False).to_numpy()]
    cover = np.zeros(total + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    hit = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return hit[first[1:]] - hit[first[:-1]]


def _per_row(mask: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[ends[1:]] - total[ends[:-1]]


def _counts(texts: pa.Array) -> list[np.ndarray]:
    data, ends = text_bytes(texts)
    words, first, starts, _ = words_of(data, ends)
    feed = data == 10
    line_starts, line_stops, first_line = pieces(data, ends, feed)
    # a line counts if a word begins in it
    worded = np.searchsorted(starts, line_stops) > np.searchsorted(starts, line_starts)
    lines = binary_array(data[~feed], line_stops - line_starts).dictionary_encode().indices.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(first_line))
    again = pd.Series(row * (len(lines) + 1) + lines).duplicated(keep="first").to_numpy() & worded
    per_line = lambda mask: _per_row(mask, first_line)
    upper, letter = _UPPER[data], _LETTER[data]
    spaces = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    return [np.diff(first), _per_row(((data & 0xC0) != 0x80) & ~spaces, ends), _per_row(_IS_SYMBOL[data], ends),
            per_line(again), _repeated(words, first), per_line(worded), _per_row(upper, ends),
            _per_row(letter, ends), _per_row(data == 33, ends)]


def text_counts(documents: DataFrame) -> DataFrame:
    """doc_id and the counts that rules look at, over every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE_BYTES):
            columns = [part.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in _counts(part.column("text")))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *COUNTS])
        give_back()

    return documents.select("doc_id", "text").mapInArrow(run, ", ".join([f"doc_id {id_type(documents)}", *(f"{c} long" for c in COUNTS)]))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words")


def votes(rules: dict[str, tuple[str, str]] = RULES) -> Column:
    """One letter per rule: g(ood), b(ad) or - (abstains)."""
    return F.concat(*(F.when(F.expr(bad), "b").when(F.expr(good), "g").otherwise("-")
                      for good, bad in rules.values()))


def estimate(patterns: dict[str, int], rounds: int = ROUNDS) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over vote patterns and their counts.

    Returns the share of good documents, the rules' accuracies (row 0 on bad
    documents, row 1 on good ones) and each pattern's posterior of good.
    """
    if not patterns:
        return 0.5, np.zeros((2, 0)), {}
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], float)
    good = np.array([[c == "g" for c in p] for p in names], float)
    bad = np.array([[c == "b" for c in p] for p in names], float)
    share, accuracy = 0.8, np.full((2, good.shape[1]), 0.8)
    for _ in range(rounds):
        log_good = np.log(share) + good @ np.log(accuracy[1]) + bad @ np.log(1 - accuracy[1])
        log_bad = np.log(1 - share) + bad @ np.log(accuracy[0]) + good @ np.log(1 - accuracy[0])
        posterior = 1 / (1 + np.exp(np.clip(log_bad - log_good, -500, 500)))
        w1, w0 = weight * posterior, weight * (1 - posterior)
        share = float(np.clip(w1.sum() / weight.sum(), 0.02, 0.98))
        # two pseudo-votes at 0.8 hold rules that never voted
        right = np.stack([w0 @ bad, w1 @ good]) + 1.6
        voted = np.stack([w0 @ (bad + good), w1 @ (bad + good)]) + 2
        accuracy = np.clip(right / voted, *ACCURACY)
    return share, accuracy, dict(zip(names, posterior.tolist(), strict=True))


def judge(documents: DataFrame, rules: dict[str, tuple[str, str]] = RULES, keep_from: float = KEEP_FROM) -> DataFrame:
    """doc_id, the counts, ``votes``, ``posterior`` (of good quality),
    ``base_failed`` and ``kept``."""
    counted = stage(text_counts(documents).withColumn("votes", votes(rules)), "quality")
    patterns = {r.votes: r.n for r in counted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior = estimate(patterns)[2]
    table = documents.sparkSession.createDataFrame(list(posterior.items()), "votes string, posterior double")
    out = counted.join(F.broadcast(table), "votes").withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep_from))
