"""Spelling variants by permuterm rotations.

A word ``w`` marked with its end, ``w$``, has the rotations
``w[j:] $ w[:j]``.  Of a rotation, the last character is the one that an edit
at that place touches: without it, the rotation is a prefix (a *key*) that all
words share which have another character there (a replacement), or that is the
whole rotation of a word without one (an insertion or deletion).  All
rotations are dealt and sorted by key; one scan over the sorted groups gives
each word its near words.  A group holds at most one row per letter of the
alphabet and one whole rotation, however many words there are, so that no
group grows with the corpus.  A deleted character that repeats its left
neighbour gives the same word, so only the first of such a run counts.

The rotations of a word of m letters take m * m characters.  Keys of more than
:data:`TEXT_KEY` letters are therefore met by two polynomial sums first (equal
keys have equal sums); only rows that meet another are then told apart by the
text itself, under its SHA-256.

Null texts have no words; a null doc_id is the empty text in the checksum that
drops letters.  Repeated rows count each time.  Only ``doc_id`` and ``text``
are read, so other columns may have any name.  An empty table gives no rows.
Texts and words of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Fixed values of the contract: letters of a run, the share of runs that lose
#: a letter, the shortest word, the least count and the least ratio of a form.
LETTERS = "a-zÀ-ÿ"
DROP_EVERY = 31
MIN_LENGTH = 7
MIN_COUNT = 2
FORM_RATIO = 10

#: Keys of up to this many letters travel as text.
TEXT_KEY = 47

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def corpus_words(documents: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                 drop_every: int = DROP_EVERY) -> DataFrame:
    """``(word, n)``: the runs of letters, some without one letter, counted
    over all texts (partial counts before the shuffle)."""
    runs = F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))
    each = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), F.explode(runs).alias("run"))
    mark = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("mark") % F.char_length("run")).cast("int")
    short = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    word = F.when(F.col("mark") % drop_every == 0, short).otherwise(F.col("run"))
    counted = each.withColumn("mark", mark).select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") >= min_count) & (F.char_length("word") >= min_length))


def _text_keys(words: DataFrame, limit: int) -> DataFrame:
    """Rows ``(key, skipped, first, n, who)`` of all keys of at most ``limit``
    letters: whole rotations (``skipped`` null) and rotations less their last
    character."""
    m = F.char_length("word")
    cut = """inline(transform(sequence(if(m <= {0}, 0, m + 1), 2 * m), j -> if(j <= m,
        named_struct('key', concat(substr(word, j + 1), '$', substr(word, 1, j)), 'skipped', cast(null as string), 'first', false),
        named_struct('key', concat(substr(word, j - m + 1), '$', substr(word, 1, j - m - 1)), 'skipped', substr(word, j - m, 1),
                     'first', j = m + 1 or substr(word, j - m, 1) <> substr(word, j - m - 1, 1)))))""".format(limit)
    return (words.withColumn("m", m).where(F.col("m") <= limit + 1).select("n", F.expr(cut))
            .withColumn("who", F.lit(None).cast("long")))


def _sums(batches: Iterable[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(left, right, letters, at, skipped, first, n, who)`` of all keys
    of more than ``limit`` letters, under the sums of the parts before and
    after the place."""
    base = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        for who, word, n in zip(*(batch.column(c).to_pylist() for c in ("who", "word", "n"))):
            points = np.array([ord(c) for c in word], np.uint64)
            m = len(points)
            power = np.concatenate(([np.uint64(1)], np.cumprod(np.full(m, base))))[:m]
            zero = np.zeros(1, np.uint64)
            left = np.concatenate((zero, np.cumsum(points * power))).view(np.int64)
            right = np.concatenate((zero, np.cumsum(points[::-1] * power)))[::-1].copy().view(np.int64)
            first = np.concatenate(([True], points[1:] != points[:-1]))
            parts = []
            if m > limit:
                at = np.arange(m + 1)
                parts.append((left, right, np.full(m + 1, m), at, pa.nulls(m + 1, pa.string()), np.zeros(m + 1, bool)))
            if m - 1 > limit:
                parts.append((left[:-1], right[1:], np.full(m, m - 1), np.arange(m), pa.array(list(word)), first))
            for a, b, letters, at, skipped, own in parts:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(b), pa.array(letters, pa.int64()), pa.array(at, pa.int64()), skipped, pa.array(own),
                     pa.array(np.full(len(a), n)), pa.array(np.full(len(a), who))],
                    ["left", "right", "letters", "at", "skipped", "first", "n", "who"])


def _met(key: list[str]) -> tuple[Column, Column, Column]:
    """Per group: words with a skipped character, those of them whose skip
    counts as a deletion, and the count of the whole rotation's word."""
    group = Window.partitionBy(*key)
    return (F.count("skipped").over(group), F.count(F.when(F.col("first"), 1)).over(group),
            F.max(F.when(F.col("skipped").isNull(), F.col("n"))).over(group))


def _meets(rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows that have a near word in their group, with the group's counts."""
    longs, firsts, whole = _met(key)
    found = rows.withColumns({"longs": longs, "firsts": firsts, "whole_n": whole})
    gap = F.col("skipped").isNotNull()
    return found.where((gap & (F.col("longs") > 1)) | (gap & F.col("first") & F.col("whole_n").isNotNull())
                       | (~gap & (F.col("firsts") > 0)))


def _scan(rows: DataFrame) -> DataFrame:
    """Near words of every row ``(key, skipped, first, n, who)``: one row per
    kind of edit with the number of near words and the best of them, by count,
    then by character (words of a group differ there alone)."""
    each = F.struct(F.col("n").alias("near_n"), F.col("skipped").alias("near_skipped"), F.col("who").alias("near_who"))
    group = Window.partitionBy("key")
    order = group.orderBy(F.col("skipped").isNull(), F.col("n").desc(), "skipped")
    # what a row sees is taken before rows without a near word go
    seen = rows.withColumns({
        "rank": F.row_number().over(order), "best": F.first(each).over(order), "next": F.lead(each).over(order),
        "whole": F.max(F.when(F.col("skipped").isNull(), each)).over(group),
        "longer": F.min(F.when(F.col("first"), F.struct((-F.col("n")).alias("less"), "skipped", "who"))).over(group)})
    found = _meets(seen, ["key"])
    none = F.lit(None).cast("struct<n_near: bigint, near_n: bigint, near_skipped: string, near_who: bigint>")

    def near(count, best):
        return F.struct(count.cast("long").alias("n_near"), *(F.col(f"{best}.{c}").alias(c) for c in ("near_n", "near_skipped", "near_who")))

    gap = F.col("skipped").isNotNull()
    replaced = (F.when(gap & (F.col("longs") > 1) & (F.col("rank") == 1), near(F.col("longs") - 1, "next"))
                .when(gap & (F.col("longs") > 1), near(F.col("longs") - 1, "best")).otherwise(none))
    deleted = F.when(gap & F.col("first") & F.col("whole").isNotNull(), near(F.lit(1), "whole")).otherwise(none)
    inserted = F.when(~gap, F.struct(F.col("firsts").cast("long").alias("n_near"), (-F.col("longer.less")).alias("near_n"),
                                     F.col("longer.skipped").alias("near_skipped"), F.col("longer.who").alias("near_who"))).otherwise(none)
    edits = F.filter(F.array(replaced, deleted, inserted), lambda x: x.isNotNull())
    return found.select("key", "skipped", "who", F.inline(edits))


def _word(key: str, skipped: Column) -> Column:
    """The word of a text key: what follows the end mark, the character, what
    precedes it."""
    return F.concat(F.substring_index(key, "$", -1), F.coalesce(skipped, F.lit("")), F.substring_index(key, "$", 1))


def near_words(words: DataFrame, limit: int = TEXT_KEY) -> DataFrame:
    """``(word, n_near, near_n, near_word)`` of the words that have a near one
    (one character inserted, deleted or replaced): their number, and the near
    word of the greatest ``n``, the smallest of equal ones.

    ``words`` has distinct words and counts ``n``.
    """
    text = _scan(_text_keys(words, limit))
    rows = text.select(_word("key", F.col("skipped")).alias("word"), "n_near", "near_n",
                       _word("key", F.col("near_skipped")).alias("near_word"))
    rows = rows.unionByName(_near_long(words, limit))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_word"))
    found = rows.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return found.select("word", "n_near", (-F.col("best.less")).alias("near_n"), F.col("best.near_word").alias("near_word"))


def _near_long(words: DataFrame, limit: int) -> DataFrame:
    long = words.where(F.char_length("word") > limit).select(F.monotonically_increasing_id().alias("who"), "word", "n")
    long = stage(long, "spelling-long")
    sums = long.mapInArrow(lambda batches: _sums(batches, limit),
                           "left long, right long, letters long, at long, skipped string, first boolean, n long, who long")
    met = _meets(sums, ["left", "right", "letters"]).select("at", "skipped", "first", "n", "who")
    texts = met.join(long.select("who", "word"), "who")
    at = F.col("at").cast("int")
    rest = F.when(F.col("skipped").isNull(), F.col("word")).otherwise(
        F.concat(F.substr("word", F.lit(1), at), F.substr("word", at + 2)))
    keyed = texts.select(F.concat(F.col("at").cast("string"), F.lit(":"), F.sha2(rest, 256)).alias("key"),
                         "skipped", "first", "n", "who")
    near = _scan(keyed).select("who", "n_near", "near_n", "near_who")
    named = near.join(long.select("who", "word"), "who")
    return named.join(long.select(F.col("who").alias("near_who"), F.col("word").alias("near_word")), "near_who").select(
        "word", "n_near", "near_n", "near_word")


def follow(links: DataFrame) -> DataFrame:
    """``(word, root)``: the end of each chain of ``(word, form)``.

    Chains are walked by doubling: a step joins every word's present end with
    that one's own end.  A form has a greater count than its word, so that
    chains end; a step that moves none is the last.
    """
    ends = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = ends.select(F.col("word").alias("root"), F.col("root").alias("end"))
        moved = ends.join(further, "root", "left")
        step = stage(moved.select("word", F.coalesce("end", "root").alias("root"), F.col("end").isNotNull().alias("moved")), "spelling-roots")
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        ends = step.select("word", "root")


def variants(documents: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of the texts: the
    near word that is ``ratio`` times as frequent at least, and the end of the
    chain of forms."""
    words = stage(corpus_words(documents).repartition("word"), "spelling-words")
    near = stage(near_words(words), "spelling-near")
    seen = words.join(near, "word", "left")
    formed = F.col("near_n") >= ratio * F.col("n")
    forms = seen.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("near_word")).alias("form"),
                        F.when(formed, F.col("near_n")).alias("form_n"))
    roots = follow(forms.where(F.col("form").isNotNull()).select("word", "form"))
    out = forms.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
