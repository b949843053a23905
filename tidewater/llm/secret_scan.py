"""Secret scans: fixed patterns plus a character convolutional network.

Patterns (assignments, access keys, long hex) give the base spans.  Every
run of ``LEAST`` or more key characters is a candidate; a small convolutional
network in numpy reads it with the characters around it, a run longer than
``BODY`` in windows that overlap by half, of which the best counts.  It is
trained on labelled findings: windows that a pattern marked against windows
that none did, ``TRAIN_ROWS`` of each kind at most (those of the smallest
hashes).  Scores are calibrated (Platt) on that sample's held-out part; the
threshold is the largest one that keeps ``RECALL`` of the base findings of all
documents, from a histogram of every finding's score, but not under one half:
a run that the network calls less likely than not is no finding.  Where that
floor costs recall, the share it keeps is logged.

Null or empty text has no findings.  Repeated rows are scanned each.  With no
labelled findings of both kinds nothing is learned, and only the base spans
are returned.  ``documents`` is read twice, texts of any length whole.  Only
``doc_id`` and ``text`` are read, so other columns may have any name (for
:func:`redact`, any but ``spans_``).  An empty table gives an empty result.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, give_back, id_type, pieces, stage, text_bytes, text_slices


# The base patterns and the order of kinds.
_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "net")

#: Key characters of the shortest candidate (a pattern's shortest value).
LEAST = 6
SIDE = 16
BODY = 40
WIDTH = 2 * SIDE + BODY
FILTERS, TAPS, HIDDEN = 24, 5, 16
#: Labelled findings of each kind that the network is trained on at most.
TRAIN_ROWS = 3_000
#: Share of the labelled findings that the threshold must keep.
RECALL = 0.99
BINS = 1_000
#: Windows that a numpy step looks at.
STEP = 4_096
_KEY = np.zeros(256, bool)
_KEY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")] = True


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base findings, in code points."""
    spans = [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    spans += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), m.end(), 2) for m in _HEX.finditer(text)]
    return sorted(spans)


def _suspects(texts: pa.Array) -> np.ndarray:
    """Rows that can hold a base finding; the others have none.

    An assignment needs ':' or '='; the other kinds are runs of 20 or more
    key characters."""
    data, ends = text_bytes(texts)
    starts, stops, _ = pieces(data, ends, ~_KEY[data])
    able = stops - starts >= 20
    rows = np.zeros(len(texts), bool)
    rows[np.searchsorted(ends, starts[able], side="right") - 1] = True
    rows[np.searchsorted(ends, np.flatnonzero((data == 58) | (data == 61)), side="right") - 1] = True
    return np.flatnonzero(rows)


class Candidates:
    """The windows of a batch's candidates and its base findings.

    The rows' characters stand in one array, as classes, SIDE zeros apart.
    ``start`` and ``stop`` are the windows' bodies there, in order, ``run``
    the candidate of each; candidates are (row, start, end) in code points."""

    def __init__(self, texts: pa.Array):
        rows = [t or "" for t in texts.to_pylist()]
        gap = "\0" * SIDE
        codes = np.frombuffer(f"{gap}{gap.join(rows)}{gap}".encode("utf-32-le"), "<u4")
        self.text = np.minimum(codes, 127).astype(np.uint8)
        size = np.array([len(t) for t in rows], np.int64) + SIDE
        self.offset = np.cumsum(size) - size + SIDE
        edge = np.diff(np.concatenate(([0], _KEY[self.text].view(np.int8), [0])))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        a, b = a[b - a >= LEAST], b[b - a >= LEAST]
        self.row = np.searchsorted(self.offset, a, side="right") - 1
        self.begin, self.end = a - self.offset[self.row], b - self.offset[self.row]
        # windows of BODY characters, half a BODY apart, the last at the end
        n = 1 + np.maximum(-(-(b - a - BODY) // (BODY // 2)), 0)
        self.run = np.repeat(np.arange(len(a)), n)
        self.first = np.cumsum(n) - n
        ahead = a[self.run] + (np.arange(len(self.run)) - self.first[self.run]) * (BODY // 2)
        self.stop = np.minimum(ahead + BODY, b[self.run])
        self.start = np.maximum(np.minimum(ahead, self.stop - BODY), a[self.run])
        self.base: list[list] = [[] for _ in rows]
        for i in _suspects(texts):
            self.base[i] = base_spans(rows[i])
        found = [(self.offset[i] + s, self.offset[i] + e) for i, own in enumerate(self.base) for s, e, _ in own]
        self.found = np.array(found, np.int64).reshape(-1, 2)
        far = np.concatenate(([-1], np.maximum.accumulate(self.found[:, 1])))
        self.labelled = far[np.searchsorted(self.found[:, 0], self.stop)] > self.start

    def windows(self, some: np.ndarray) -> np.ndarray:
        """These windows with their surroundings, WIDTH classes each."""
        a, b = self.start[some, None], self.stop[some, None]
        body = a + np.arange(BODY)
        return np.concatenate((self.text[a - SIDE + np.arange(SIDE)],
                               np.where(body < b, self.text[np.minimum(body, len(self.text) - 1)], 0).astype(np.uint8),
                               self.text[b + np.arange(SIDE)]), axis=1)

    def bins(self, net: CharNet) -> np.ndarray:
        """Every window's score as a bin; equal windows are scored once."""
        out = np.zeros(len(self.run), np.int64)
        for lo in range(0, len(out), STEP):
            x = self.windows(np.arange(lo, min(lo + STEP, len(out))))
            index, distinct = _distinct(x)
            out[lo:lo + STEP] = np.floor(net.probability(x[distinct]) * (BINS - 1))[index]
        return out

    def found_bins(self, bins: np.ndarray) -> np.ndarray:
        """Every base finding's best bin: each holds LEAST key characters."""
        lo = np.searchsorted(self.stop, self.found[:, 0], side="right")
        hi = np.searchsorted(self.start, self.found[:, 1])
        cuts = np.stack((lo, hi), axis=1).ravel()
        return np.maximum.reduceat(np.append(bins, 0), cuts)[::2] if len(cuts) else bins[:0]


def _hashes(x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), np.uint64)
    for word in np.ascontiguousarray(x).view("<u8").T:
        out = (out ^ word) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's place among the distinct rows, and a row for each of those."""
    _, distinct, index = np.unique(np.ascontiguousarray(x).view(f"V{x.shape[1]}").ravel(), return_index=True, return_inverse=True)
    return index, distinct


def _window(text: str, start: int, end: int) -> bytes:
    """The candidate with its surroundings as WIDTH character classes."""
    own = Candidates(pa.array([text]))
    own.start, own.stop = np.array([SIDE + start]), np.array([SIDE + min(end, len(text))])
    return own.windows(np.array([0])).tobytes()


def _samples(documents: DataFrame, train_rows: int) -> DataFrame:
    """(labelled, hash, window): of every task, the distinct windows of each
    label with the smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {label: (np.zeros(0, np.uint64), np.zeros((0, WIDTH), np.uint8)) for label in (True, False)}
        for part in text_slices(batches, limit=SLICE_BYTES):
            found = Candidates(part.column("text"))
            for lo in range(0, len(found.run), STEP):
                some = np.arange(lo, min(lo + STEP, len(found.run)))
                x = found.windows(some)
                own = _hashes(x)
                for label, (hashes, windows) in held.items():
                    mask = found.labelled[some] == label
                    if len(hashes) == train_rows and train_rows:
                        mask &= own < hashes[-1]
                    if mask.any():
                        hashes, place = np.unique(np.concatenate((hashes, own[mask])), return_index=True)
                        held[label] = hashes[:train_rows], np.concatenate((windows, x[mask]))[place[:train_rows]]
        for label, (hashes, windows) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(hashes), label)), pa.array(hashes.view(np.int64)),
                                              pa.array([w.tobytes() for w in windows], pa.binary())], ["labelled", "hash", "window"])
        give_back()

    return documents.select("doc_id", "text").mapInArrow(run, "labelled boolean, hash long, window binary")


def _found(documents: DataFrame, net: CharNet | None) -> DataFrame:
    """doc_id, base findings with their best bins, and the other candidates
    that the network calls likely: (start, end, bin)."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32())]))
    cand = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("bin", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE_BYTES):
            found = Candidates(part.column("text"))
            runs: list[list] = [[] for _ in found.base]
            marks = np.zeros(len(found.found), np.int64)
            if net is not None and len(found.run):
                bins = found.bins(net)
                marks = found.found_bins(bins)
                best = np.maximum.reduceat(np.where(found.labelled, -1, bins), found.first)
                for i in np.flatnonzero(best >= BINS // 2):
                    runs[found.row[i]].append({"start": int(found.begin[i]), "end": int(found.end[i]), "bin": int(best[i])})
            cuts = np.cumsum([0, *map(len, found.base)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([[dict(zip(("start", "end", "kind"), x, strict=True)) for x in r] for r in found.base], kind),
                 pa.ListArray.from_arrays(pa.array(cuts), pa.array(marks.astype(np.int32))), pa.array(runs, cand)],
                ["doc_id", "base", "bins", "runs"])
        give_back()

    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type(documents)}, base array<struct<start:int,end:int,kind:int>>, bins array<int>, runs array<struct<start:int,end:int,bin:int>>")


class CharNet:
    """Embedding-free character CNN: taps are looked up per character, rectified,
    the maximum over places goes through one hidden layer to a logit."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        self.weights = [r.normal(0, 0.3, (TAPS, 128, FILTERS)), np.zeros(FILTERS),
                        r.normal(0, 0.3, (FILTERS, HIDDEN)), np.zeros(HIDDEN), r.normal(0, 0.3, HIDDEN), np.zeros(1)]
        self.scale = (1.0, 0.0)

    def _forward(self, x: np.ndarray) -> tuple:
        taps, bias, w1, b1, w2, b2 = self.weights
        places = x.shape[1] - TAPS + 1
        conv = bias + sum(taps[t][x[:, t:t + places]] for t in range(TAPS))
        best = conv.argmax(axis=1)
        pooled = np.take_along_axis(conv, best[:, None, :], axis=1)[:, 0, :]
        top = np.maximum(pooled, 0)
        hidden = np.maximum(top @ w1 + b1, 0)
        return best, pooled, top, hidden, hidden @ w2 + b2[0]

    def _read(self, x: np.ndarray) -> np.ndarray:
        """The logits alone: two characters a look-up, in single precision."""
        taps, bias, w1, b1, w2, b2 = self.weights
        pair = [(taps[t][:, None] + taps[t + 1][None]).reshape(-1, FILTERS).astype(np.float32) for t in (0, 2)]
        last, places, out = (taps[4] + bias).astype(np.float32), x.shape[1] - TAPS + 1, []
        both = x[:, :-1].astype(np.int32) * 128 + x[:, 1:]
        for i in range(0, len(x), 256):
            own, two = x[i:i + 256], both[i:i + 256]
            conv = pair[0].take(two[:, :places], axis=0)
            conv += pair[1].take(two[:, 2:2 + places], axis=0)
            conv += last.take(own[:, 4:4 + places], axis=0)
            top = np.maximum(conv.max(axis=1), 0)
            out.append(np.maximum(top @ w1 + b1, 0) @ w2 + b2[0])
        return np.concatenate(out)

    def logits(self, windows: np.ndarray) -> np.ndarray:
        return self._read(windows) if len(windows) else np.zeros(0)

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 6, batch: int = 64, rate: float = 0.01, seed: int = 11) -> CharNet:
        """Adam on the log loss, over shuffled batches."""
        r = np.random.default_rng(seed)
        first, second, t = [np.zeros_like(w) for w in self.weights], [np.zeros_like(w) for w in self.weights], 0
        for _ in range(rounds):
            order = r.permutation(len(x))
            for i in range(0, len(order), batch):
                own = order[i:i + batch]
                best, pooled, top, hidden, logit = self._forward(x[own])
                slope = (1 / (1 + np.exp(-logit)) - y[own]) / len(own)
                taps, _, w1, _, w2, _ = self.weights
                to_hidden = np.outer(slope, w2) * (hidden > 0)
                to_pool = (to_hidden @ w1.T) * (pooled > 0)
                grads = [np.zeros_like(taps), to_pool.sum(0), top.T @ to_hidden, to_hidden.sum(0), hidden.T @ slope, np.array([slope.sum()])]
                rows, filters = np.arange(len(own))[:, None], np.arange(FILTERS)[None, :]
                for k in range(TAPS):
                    np.add.at(grads[0][k], (x[own][rows, best + k], filters), to_pool)
                t += 1
                for w, g, m, v in zip(self.weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        return self

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> CharNet:
        """Platt scaling by Newton steps, with smoothed targets."""
        z = self.logits(x)
        n1, n0 = y.sum(), len(y) - y.sum()
        target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
        a, b = 1.0, 0.0
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w, e = p * (1 - p) + 1e-6, p - target
            g = np.array([(e * z).sum() + 1e-3 * (a - 1), e.sum()])
            h = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
            a, b = np.array([a, b]) - np.linalg.solve(h, g)
        self.scale = (max(float(a), 1e-3), float(b))
        return self

    def probability(self, windows: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * self.logits(windows) + b, -30, 30)))


def _as_array(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), np.uint8).reshape(-1, WIDTH)


def train(documents: DataFrame, train_rows: int = TRAIN_ROWS) -> CharNet | None:
    """Fit on at most ``train_rows`` distinct windows of each label."""
    rows, sample = [], stage(_samples(documents, train_rows), "samples")
    for label in (True, False):
        rows += sample.filter(F.col("labelled") == label).distinct().orderBy("hash", "window").limit(train_rows).collect()
    y = np.array([float(r.labelled) for r in rows])
    if not len(y) or y.min() == y.max():
        return None
    x = _as_array([bytes(r.window) for r in rows])
    held = np.arange(len(x)) % 5 == 0
    if not (~held).any() or y[~held].min() == y[~held].max():
        held[:] = False
    net = CharNet().fit(x[~held], y[~held])
    return net.calibrate(x[held], y[held]) if held.any() else net


def scan(documents: DataFrame, train_rows: int = TRAIN_ROWS, recall: float = RECALL) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, end, kind) in code
    points, end exclusive, sorted; kind is a place in ``KINDS``."""
    net = train(documents, train_rows)
    found = _found(documents, net)
    if net is None:
        return found.select("doc_id", "base", F.col("base").alias("spans"))
    found = stage(found, "findings")
    counts = {r.bin: r.n for r in found.select(F.explode("bins").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    need, kept, threshold = recall * sum(counts.values()), 0, BINS
    for b in sorted(counts, reverse=True):
        kept, threshold = kept + counts[b], b
        if kept >= need:
            break
    # a run that the network calls less likely than not is no finding
    if threshold < BINS // 2:
        threshold = BINS // 2
        kept = sum(n for b, n in counts.items() if b >= threshold)
        logging.getLogger(__name__).warning("the floor of one half keeps %d of %d base findings", kept, sum(counts.values()))
    more = F.transform(F.filter("runs", lambda r: r["bin"] >= threshold),
                       lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end"), F.lit(KINDS.index("net")).alias("kind")))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def span_text(spans) -> F.Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def redact(documents: DataFrame, found: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``documents`` with the union of every document's spans replaced by
    ``mask`` and n_chars to match; ``found`` is :func:`scan` of them.  Rows of
    one doc_id must hold one text (the first row's spans serve)."""
    hit = found.filter(F.size("spans") > 0).groupBy("doc_id").agg(F.first("spans").alias("spans_"))
    # walk the sorted spans: state is the text built so far and where to go on
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    walked = F.aggregate(
        "spans_", start,
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, x["start"] - s["at"]), F.lit(mask)))
            .otherwise(s["out"]).alias("out"), F.greatest(s["at"], x["end"]).alias("at")),
        lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    text = F.when(F.col("spans_").isNull(), F.col("text")).otherwise(walked)
    out = documents.join(hit, "doc_id", "left").withColumn("text", text).drop("spans_")
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text").cast("long"))) if "n_chars" in documents.columns else out
