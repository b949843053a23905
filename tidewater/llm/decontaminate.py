"""Benchmark decontamination by a prefix-filtered set join.

A window is ``window`` consecutive words of an item (an item of fewer words is
one window of all of them).  Its words are ordered by how rare they are in the
documents, and since all of them must be there, a prefix of one word, the
rarest, is necessary: only document words that are some window's rarest word
are joined.  The word's place gives the place where the window would have to
begin; places outside the text are dropped, and the rest is verified word by
word.

DataFrame functions only.  Document words stream through the join: the side
that is built holds the benchmark's windows, and is broadcast only if its
measured size is within ``BROADCAST_BYTES``; a larger one is shuffled.

Null, empty or wordless text has no words and no hits.  Repeated rows and
repeated ids are documents of their own; items are told apart by id, and equal
items all count.  Texts of any length are read whole.  Only ``doc_id``,
``item_id`` and ``text`` are read, so other columns may have any name.  Empty
tables give no hits.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

WINDOW = 10
#: Measured bytes up to which the benchmark's side of a join is broadcast.
BROADCAST_BYTES = 32 << 20

# What separates words (upper case is folded, not a separator).
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _fold(c: Column) -> Column:
    """A-Z to lower case, other letters as they are."""
    return F.when(F.lower(c) == c, c).otherwise(F.translate(c, string.ascii_uppercase, string.ascii_lowercase))


def _words(c: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), _GAP), "")


def _sized(df: DataFrame, text: str) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(text) + 64), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(item_id, passage, k): every window's words joined by spaces."""
    items = benchmark.select("item_id", F.transform(_words(F.col("text")), _fold).alias("w")).filter(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(window))
    at = items.withColumn("k", k).select("item_id", "w", "k", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("k") + 1)).alias("s"))
    return at.select("item_id", F.array_join(F.slice("w", F.col("s"), F.col("k")), " ").alias("passage"), "k").distinct()


def _rarest(passages: DataFrame, words: DataFrame) -> DataFrame:
    """Each passage with its rarest word in the documents and that word's
    place (from 0); passages with a word that no document has are dropped."""
    parts = passages.select("passage", "k", F.posexplode(F.split("passage", " ")).alias("place", "word"))
    vocabulary = _sized(stage(parts.select("word").distinct(), "vocabulary"), "word")
    counted = (words.select(_fold(F.col("word")).alias("word")).join(vocabulary, "word")
               .groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    ranked = parts.join(counted, "word").groupBy("passage", "k").agg(
        F.min(F.struct("n", "word", "place")).alias("first"), F.count(F.lit(1)).alias("found"))
    return ranked.filter("found = k").select("passage", "k", F.col("first.word").alias("token"), F.col("first.place").alias("place"))


def occurrences(documents: DataFrame, passages: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, passage, start, k) for every place where a
    passage occurs (words count from 1), and one row per document with a null
    passage that carries its word count."""
    texts = documents.select("doc_id", F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("w"))
    tokens = _rarest(passages, documents.select(F.explode(_words(F.col("text"))).alias("word")))
    mark = documents.sparkSession.createDataFrame([(None, 0, "", 0)], "passage string, k int, token string, place int")
    probes = _sized(stage(tokens.unionByName(mark), "tokens"), F.coalesce("passage", F.lit("")))
    # the empty word, in front of each text, meets the mark
    each = texts.select("row", "doc_id", "w", F.posexplode(F.concat(F.array(F.lit("")), "w")).alias("at", "word"))
    met = each.join(probes, _fold(F.col("word")) == F.col("token"))
    start = F.col("at") - F.col("place")
    inside = (start >= 1) & (start + F.col("k") - 1 <= F.size("w"))
    there = F.translate(F.array_join(F.slice("w", start, F.col("k")), " "), string.ascii_uppercase, string.ascii_lowercase)
    found = F.when(F.col("passage").isNull(), True).when(inside, there == F.col("passage")).otherwise(False)
    return met.filter(found).select("row", "doc_id", F.size("w").cast("long").alias("n_words"), "passage",
                                    start.alias("start"), "k")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, ``n_words``, ``n_hit`` (words inside occurring windows),
    ``n_items``, ``item_ids`` (sorted strings), ``contaminated``."""
    windows = stage(benchmark_windows(benchmark, window), "windows")
    found = stage(occurrences(documents, windows.select("passage", "k").distinct()), "occurrences")
    hits = found.filter("passage is not null")
    places = hits.select("row", F.explode(F.sequence("start", F.col("start") + F.col("k") - 1)).alias("place"))
    covered = places.distinct().groupBy("row").agg(F.count(F.lit(1)).alias("n_hit"))
    items = (hits.select("row", "passage").distinct().join(windows.select("item_id", "passage"), "passage")
             .select("row", F.col("item_id").cast("string").alias("item")).distinct()
             .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("item_ids")))
    # a null item id cannot be listed, but the words it hits count
    rows = found.filter("passage is null").select("row", "doc_id", "n_words")
    out = rows.join(covered, "row", "left").join(items, "row", "left")
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                      F.size(ids).cast("long").alias("n_items"), ids.alias("item_ids"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))
