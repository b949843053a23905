"""Toxicity scores by a counterfactual-regularised linear classifier.

Features are the byte n-grams of the lower-cased text, present or not.  A
labelled sample (``SAMPLE_ROWS`` rows at most, those of the smallest hashes;
held-out rows never) is counted in Spark, and the n-grams most associated
with either label are kept.  Logistic regression over them adds a penalty on
score changes: in every sampled text that names a group, identity terms are
swapped for others, and the squared change of the logit is penalised, so that
naming a group does not by itself raise a score.

Null, empty or wordless text gets the score of the bias alone.  Repeated rows
are scored each; a doc_id labelled more than once is toxic if any label says
so, and one with several texts is learnt from by its smallest text.  Texts of
any length are read whole.  Only ``doc_id``, ``text`` and the labels are read,
so other columns may have any name.  Without labels of both kinds every score is the share of toxic ones (0
when there are none).  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, lower_ascii, text_bytes, text_slices

#: Labelled rows that the classifier is fitted on at most.
SAMPLE_ROWS = 12_000
#: n-grams that the classifier may use.
FEATURES = 3_000
#: A kept n-gram occurs in so many sampled documents at least.
MIN_DOCUMENTS = 3
#: ... and differs between the labels by so many standard errors.
MIN_EVIDENCE = 4.0
SIZES = (4, 5, 6)
BUCKETS = 1 << 22
RIDGE, COUNTERFACTUAL = 3e-4, 1.0

# Identity terms, swapped within each group.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("black", "white", "asian", "latino"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"),
    ("immigrants", "citizens", "refugees"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("african", "european", "american", "mexican", "chinese", "indian", "arab"),
)
_NEXT = {a: group[(i + 1) % len(group)] for group in IDENTITIES for i, a in enumerate(group)}
_TERM = re.compile(r"\b(" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")\b", re.I)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def swapped(text: str) -> str | None:
    """The text with identity terms exchanged, None if it has none."""
    out, n = _TERM.subn(lambda m: _NEXT[m.group().lower()], text)
    return out if n else None


def _buckets(data: np.ndarray, ends: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the n-grams present, each once; ``wanted`` masks
    buckets."""
    data = lower_ascii(data)
    row = np.repeat(np.arange(len(ends) - 1, dtype=np.int64), np.diff(ends))
    found = []
    code = np.zeros(len(data), np.uint64)
    for i in range(max(SIZES)):
        n = len(data) - i
        if n <= 0:
            break
        code = (code[:n] << np.uint64(8)) | data[i:]
        if i + 1 in SIZES:
            at = (((code ^ np.uint64(i)) * _MULTIPLIER) >> np.uint64(64 - 22)).astype(np.int64)
            keep = row[:n] == row[i:]
            if wanted is not None:
                keep &= wanted[at]
            found.append(row[:n][keep] * BUCKETS + at[keep])
    key = pd.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return key // BUCKETS, key % BUCKETS


@dataclass
class Classifier:
    """Kept buckets with their weights, and the bias."""

    bucket: np.ndarray
    weight: np.ndarray
    bias: float

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Weight per bucket, and whether a bucket is kept."""
        table, wanted = np.zeros(BUCKETS, np.float32), np.zeros(BUCKETS, bool)
        table[self.bucket], wanted[self.bucket] = self.weight, True
        return table, wanted

    def scores(self, texts: pa.Array, table: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        row, at = _buckets(*text_bytes(texts), wanted)
        logit = self.bias + np.bincount(row, weights=table[at], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _count(sample: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): sampled documents that hold each n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=1 << 20):
            toxic = part.column("toxic").to_numpy()
            row, at = _buckets(*text_bytes(part.column("text")))
            used, index = np.unique(at, return_inverse=True)
            pos = np.bincount(index, weights=toxic[row], minlength=len(used)).astype(np.int64)
            both = np.bincount(index, minlength=len(used))
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(pos), pa.array(both - pos)], ["bucket", "pos", "neg"])

    counted = sample.select("text", "toxic").mapInArrow(run, "bucket long, pos long, neg long")
    return counted.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def _rows(sample: DataFrame, bucket: np.ndarray) -> DataFrame:
    """toxic, and the kept n-grams (as indices) of the text and, if it names
    a group, of its counterfactual."""
    index = np.full(BUCKETS, -1, np.int32)
    index[bucket] = np.arange(len(bucket))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            others = pa.array([swapped(t) if t else None for t in part.column("text").to_pylist()], pa.string())
            out = [part.column("toxic")]
            for texts in (part.column("text"), others):
                row, at = _buckets(*text_bytes(texts), index >= 0)
                order = np.argsort(row, kind="stable")
                bounds = np.searchsorted(row[order], np.arange(len(texts) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(index[at[order]]))
                out.append(lists if texts is not others else pa.array(
                    [x if t is not None else None for x, t in zip(lists.to_pylist(), others.to_pylist(), strict=True)], lists.type))
            yield pa.RecordBatch.from_arrays(out, ["toxic", "own", "other"])

    return sample.select("text", "toxic").mapInArrow(run, "toxic int, own array<int>, other array<int>")


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Classifier:
    """Fit on the labelled rows outside the held-out fold.  The driver gets
    ``features`` counts and ``sample_rows`` lists of kept n-grams at most."""
    chosen = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (fold("doc_id") != 0))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).persist()
    try:
        share = sample.agg(F.avg("toxic").alias("p"), F.count(F.lit(1)).alias("n")).first()
        if not share.n or share.p in (0.0, 1.0):
            p = float(share.p or 0.0)
            return Classifier(np.zeros(0, np.int64), np.zeros(0, np.float32), 30.0 if p else -30.0)
        n1, n0 = share.p * share.n, (1 - share.p) * share.n
        # association: difference of the shares over its standard error
        p1, p0 = F.col("pos") / n1, F.col("neg") / n0
        pool = (F.col("pos") + F.col("neg")) / share.n
        z = (p1 - p0) / F.sqrt(pool * (1 - pool) * (1 / n1 + 1 / n0) + 1e-9)
        best = (_count(sample).filter(F.col("pos") + F.col("neg") >= MIN_DOCUMENTS).withColumn("z", F.abs(z)).filter(F.col("z") >= MIN_EVIDENCE)
                .orderBy(F.desc("z"), "bucket").limit(features).collect())
        bucket = np.array(sorted(r.bucket for r in best), np.int64)
        rows = _rows(sample, bucket).collect()
    finally:
        sample.unpersist()
    return _train(rows, bucket)


def _matrix(lists: list) -> tuple[np.ndarray, np.ndarray]:
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    return row, np.array([i for x in lists for i in x], np.int64)


def _train(rows: list, bucket: np.ndarray, rounds: int = 400, rate: float = 0.05) -> Classifier:
    y = np.array([r.toxic for r in rows], float)
    row, col = _matrix([r.own for r in rows])
    pairs = [r for r in rows if r.other is not None]
    prow, pcol = _matrix([list(r.own) + list(r.other) for r in pairs])
    sign = np.array([s for r in pairs for s in [1.0] * len(r.own) + [-1.0] * len(r.other)])
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w, b = np.zeros(len(bucket)), 0.0
    m, v = np.zeros(len(bucket) + 1), np.zeros(len(bucket) + 1)
    for t in range(1, rounds + 1):
        logit = b + np.bincount(row, weights=w[col], minlength=len(y))
        slope = balance * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / len(y)
        grad = np.bincount(col, weights=slope[row], minlength=len(w)) + RIDGE * w
        if pairs:
            change = np.bincount(prow, weights=sign * w[pcol], minlength=len(pairs))
            grad += COUNTERFACTUAL * np.bincount(pcol, weights=sign * change[prow], minlength=len(w)) / len(pairs)
        g = np.append(grad, slope.sum())
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return Classifier(bucket, w.astype(np.float32), float(b))


def score(documents: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, ``score`` and ``predicted`` of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, wanted = model.tables()
        for part in text_slices(batches, limit=2 << 20):
            s = model.scores(part.column("text"), table, wanted)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             ["doc_id", "score", "predicted"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")
