"""Exact length histogram of encoded documents.

Documents are counted by encoded length (the tokenizer's ids plus the end
id); the histogram has one row per length that occurs, so sums over it answer
every question about a context limit exactly, without another pass over the
texts: documents and tokens that fit, totals after truncation, quantiles.

Null or empty text has length 1 (the end id); a very long text is encoded
whole.  Repeated rows count each.  Only ``text`` is read, so other columns may
have any name.  An empty table gives an empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, stage, text_slices
from .tokens import encoder, vocabulary_path

CHUNK = 6 << 20


def document_lengths(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """(n_tokens, n_docs): partial counts, one row per length and chunk."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(path)
        for part in text_slices(batches, limit=CHUNK):
            lengths, counts = np.unique(np.diff(codes.encode(part.column("text"))[1]) + 1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64()), pa.array(counts, pa.int64())],
                                             ["n_tokens", "n_docs"])
            give_back()

    return documents.select("text").mapInArrow(run, "n_tokens long, n_docs long")


def length_histogram(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """One row per encoded length: ``n_docs``, ``tokens`` (their sum); staged,
    so that texts are encoded once however often it is read."""
    counted = document_lengths(documents, vocabulary).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    return stage(counted.withColumn("tokens", F.col("n_tokens") * F.col("n_docs")), "lengths")


def context_totals(histogram: DataFrame, limits: list[int] | None = None) -> DataFrame:
    """Totals for every context limit, by prefix and suffix sums.

    ``limits`` defaults to every length that occurs (between two of them the
    totals are linear in the limit).  Columns: ``context_limit``, ``n_docs``
    of exactly that length, ``docs_within``, ``tokens_within``, ``docs_over``,
    ``truncated_total`` (sum of min(length, limit)), ``tokens_lost``,
    ``quantile`` (share of documents within the limit).

    The windows run over the histogram: one row per distinct length, at most
    the longest text's length, whatever the number of documents.
    """
    limits_in = histogram
    if limits is not None:
        asked = histogram.sparkSession.createDataFrame([(int(x),) for x in limits], "n_tokens long").distinct()
        limits_in = (histogram.withColumn("asked", F.lit(False))
                     .unionByName(asked.select("n_tokens", F.lit(0).cast("long").alias("n_docs"),
                                               F.lit(0).cast("long").alias("tokens"), F.lit(True).alias("asked")))
                     .groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"), F.sum("tokens").alias("tokens"),
                                              F.max("asked").alias("asked")))
    # The order of lengths is known, so the running sums are dealt by length
    # range: sums within a range plus the totals of the ranges below.
    ranged = limits_in.withColumn("range", F.floor(F.col("n_tokens") / 1024))
    inside = Window.partitionBy("range").orderBy("n_tokens")
    rows = ranged.withColumn("docs_in", F.sum("n_docs").over(inside)).withColumn("tokens_in", F.sum("tokens").over(inside))
    totals = ranged.groupBy("range").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    below = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = totals.select("range", F.coalesce(F.sum("d").over(below), F.lit(0)).alias("docs_below"),
                           F.coalesce(F.sum("t").over(below), F.lit(0)).alias("tokens_below"),
                           F.sum("d").over(everything).alias("all_docs"), F.sum("t").over(everything).alias("all_tokens"))
    out = rows.join(totals, "range").select(
        F.col("n_tokens").alias("context_limit"), "n_docs",
        (F.col("docs_below") + F.col("docs_in")).alias("docs_within"),
        (F.col("tokens_below") + F.col("tokens_in")).alias("tokens_within"), "all_docs", "all_tokens",
        *(["asked"] if limits is not None else []))
    if limits is not None:
        out = out.filter("asked").drop("asked")
    out = out.withColumn("docs_over", F.col("all_docs") - F.col("docs_within"))
    out = out.withColumn("truncated_total", F.col("tokens_within") + F.col("docs_over") * F.col("context_limit"))
    return out.select("context_limit", "n_docs", "docs_within", "tokens_within", "docs_over", "truncated_total",
                      (F.col("all_tokens") - F.col("truncated_total")).alias("tokens_lost"),
                      (F.col("docs_within") / F.col("all_docs")).alias("quantile"))


def quantile_length(histogram: DataFrame, q: float) -> DataFrame:
    """The shortest length that at least a share ``q`` of documents is within."""
    return (context_totals(histogram).filter((F.col("quantile") >= q) & (F.col("n_docs") > 0))
            .agg(F.min("context_limit").alias("n_tokens")))
