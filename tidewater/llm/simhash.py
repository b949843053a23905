"""SimHash fingerprints and their near-duplicate components.

A fingerprint takes the majority bit over the XXH64 hashes of all word
shingles.  Documents whose fingerprints differ in at most three bits are
linked; components of the links are found over distinct fingerprints.

Links come from a self-join of a binary trie.  If two fingerprints differ in
at most three bits, one of their four 16-bit quarters is equal; so each
fingerprint enters four tries, rotated so that another quarter leads, and a
trie's first 16 levels (the quarter) are walked with no error allowed.  Tries
with different leading quarters never meet, so they are dealt to tasks by it.
Below, node pairs are walked together, the differing bits of their paths add
up, and a pair over the budget is dropped with everything under it.  A task
returns a spanning forest of its links, never the pairs.

Work per fingerprint is bounded by the ball of three bits around it; equal
fingerprints are one entry, however many documents share them.

Null, empty or wordless text has fingerprint zero, and is linked like any
other; very long texts are hashed whole.  Repeated rows share a fingerprint.  A
null doc_id is no smallest one unless its component has no other (then
``component_id`` is null).  Only ``doc_id`` and ``text`` are read, so other
columns may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, give_back, id_type, lower_ascii, stage, text_bytes, text_slices, words_of

SHINGLE = 3
MAX_BITS = 3
SEED = 42
QUARTER = 16
#: Shingles hashed at a time; a text's may lie in several blocks.
BLOCK = 1 << 14
#: Node pairs walked at a time.
FRONT = 1 << 18


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id and the 64-bit fingerprint (a signed long) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches, limit=SLICE_BYTES):
            marks = _fingerprints(part.column("text"), shingle, seed)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(marks.view(np.int64))], ["doc_id", "mark"])
        give_back()

    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type(documents)}, mark long")


def _fingerprints(texts: pa.Array, shingle: int, seed: int) -> np.ndarray:
    from xxhash import xxh64_intdigest

    data, ends = text_bytes(texts)
    words, first, starts, stops = words_of(lower_ascii(data), ends)
    if not len(words):
        return np.zeros(len(texts), np.uint64)
    # all words joined by spaces; a shingle is a slice of them
    size = stops - starts
    at = np.concatenate(([0], np.cumsum(size + 1)))
    joined = np.insert(np.frombuffer(words.buffers()[2], np.uint8), np.cumsum(size), 0x20).tobytes()
    n_words = np.diff(first)
    n_shingles = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    bounds = np.concatenate(([0], np.cumsum(n_shingles)))
    ones = np.zeros((len(texts), 64), np.int32)
    for lo in range(0, int(bounds[-1]), BLOCK):
        own = np.arange(lo, min(lo + BLOCK, int(bounds[-1])))
        row = np.searchsorted(bounds, own, side="right") - 1
        heads = first[row] + own - bounds[row]
        tails = heads + np.minimum(n_words[row], shingle)
        hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in
                              zip(at[heads].tolist(), (at[tails] - 1).tolist(), strict=True)), np.uint64, len(own))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        edges = np.flatnonzero(np.diff(row, prepend=-1))
        ones[row[edges]] += np.add.reduceat(bits, edges, axis=0, dtype=np.int32)
    return np.packbits(ones * 2 > n_shingles[:, None], axis=1).view(np.uint64).ravel()


def _rotate(mark: np.ndarray, by: int) -> np.ndarray:
    return mark if not by else (mark << np.uint64(by)) | (mark >> np.uint64(64 - by))


class _Forest:
    """Union-find over the rows of one trie, hooked in whole arrays."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        r = self.root[x]
        while True:
            up = self.root[r]
            if np.array_equal(up, r):
                return r
            r = up

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.find(a), self.find(b)
            apart = a != b
            a, b = a[apart], b[apart]
            high, low = np.maximum(a, b), np.minimum(a, b)
            np.minimum.at(self.root, high, low)
            a, b = high, low


def _join(marks: np.ndarray, max_bits: int, front: int = FRONT) -> np.ndarray:
    """Roots of the linked rows of sorted distinct rotated fingerprints."""
    n = len(marks)
    forest = _Forest(n)
    lead = marks >> np.uint64(64 - QUARTER)
    lo = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])))
    hi = np.append(lo[1:], n)
    several = hi - lo > 1
    lo, hi = lo[several], hi[several]
    # each entry of the stack: nodes a and b as row ranges, differing bits, level
    stack = [(lo[i:i + front], hi[i:i + front], lo[i:i + front], hi[i:i + front],
              np.zeros(len(lo[i:i + front]), np.int8), QUARTER) for i in range(0, len(lo), front)]
    while stack:
        a_lo, a_hi, b_lo, b_hi, bits, level = stack.pop()
        single = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        if single.any():
            x, y = a_lo[single], b_lo[single]
            near = np.bitwise_count(marks[x] ^ marks[y]) <= max_bits
            forest.link(x[near], y[near])
            a_lo, a_hi, b_lo, b_hi, bits = (v[~single] for v in (a_lo, a_hi, b_lo, b_hi, bits))
        if not len(a_lo):
            continue
        a_mid, b_mid = _split(marks, a_lo, a_hi, level), _split(marks, b_lo, b_hi, level)
        same = a_lo == b_lo
        kids = [(a_lo, a_mid, b_lo, b_mid, bits), (a_mid, a_hi, b_mid, b_hi, bits),
                (a_lo, a_mid, b_mid, b_hi, bits + 1),
                (a_mid[~same], a_hi[~same], b_lo[~same], b_mid[~same], bits[~same] + 1)]
        merged = [np.concatenate(v) for v in zip(*kids, strict=True)]
        a_lo, a_hi, b_lo, b_hi, bits = merged
        own = (a_lo == b_lo) & (a_hi - a_lo == 1)
        keep = (a_hi > a_lo) & (b_hi > b_lo) & (bits <= max_bits) & ~own
        merged = [v[keep] for v in merged]
        for i in range(0, len(merged[0]), front):
            stack.append((*(v[i:i + front] for v in merged), level + 1))
    return forest.find(np.arange(n))


def _split(marks: np.ndarray, lo: np.ndarray, hi: np.ndarray, level: int) -> np.ndarray:
    """Where the child with bit one begins, for nodes as ranges of rows."""
    bit = np.uint64(1 << (63 - level))
    edge = (marks[lo] & ~np.uint64((1 << (64 - level)) - 1)) | bit
    return np.clip(np.searchsorted(marks, edge), lo, hi)


def near_edges(marks: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b) over distinct fingerprints ``mark``: a spanning forest, per trie,
    of the pairs that differ in at most ``max_bits`` (up to 3) bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("four quarters answer up to three differing bits")

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("mark").to_numpy().view(np.uint64)
            for quarter in range(4):
                turned = _rotate(own, QUARTER * quarter)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), quarter, np.int32)),
                     pa.array((turned >> np.uint64(64 - QUARTER)).astype(np.int32)),
                     pa.array(turned.view(np.int64))], ["quarter", "lead", "turned"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("quarter").to_numpy(), b.column("turned").to_numpy().view(np.uint64)) for b in batches]
        if not parts:
            return
        quarters, turned = (np.concatenate(v) for v in zip(*parts, strict=True))
        for quarter in range(4):
            own = np.sort(turned[quarters == quarter])
            root = _join(own, max_bits)
            child = np.flatnonzero(root != np.arange(len(own)))
            back = _rotate(own, (64 - QUARTER * quarter) % 64).view(np.int64)
            for i in range(0, len(child), 50_000):
                some = child[i:i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(back[some]), pa.array(back[root[some]])], ["a", "b"])

    dealt = marks.select("mark").mapInArrow(turn, "quarter int, lead int, turned long").repartition("quarter", "lead")
    return dealt.mapInArrow(walk, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of the edges (a, b) with the smallest node of
    its component, by alternating star contraction.

    Large stars tie a node's larger neighbours to its smallest one, small
    stars its smaller ones; each round is written to the shared folder.  Only
    groupings and equi-joins: a node's neighbours are never gathered.
    """
    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # rows (u, v); large: v > u go to min(neighbours of u and u)
        if large:
            both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            return (both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        tied = down.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return tied.unionByName(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()

    pairs = stage(edges.filter("a != b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        pairs = stage(star(star(pairs, True), False), "stars")
        # the edges are settled when no round changes them
        mark = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    seed: int = SEED) -> DataFrame:
    """doc_id, ``mark`` (the fingerprint as a signed long) and
    ``component_id`` (smallest doc_id reachable over links)."""
    marked = stage(fingerprints(documents, shingle, seed), "marks")
    least = stage(marked.groupBy("mark").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(near_edges(least, max_bits))
    classes = (least.join(roots, F.col("mark") == F.col("node"), "left")
               .select("mark", "least", F.coalesce("root", "mark").alias("root")))
    first = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(first, "root").select("mark", "component_id")
    return marked.join(named, "mark").select("doc_id", "mark", "component_id")
