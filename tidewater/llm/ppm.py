"""Prediction by partial matching over bytes, pretrained on the corpus.

The trie holds every context of up to ``ORDER`` bytes and the bytes (or the
end of the text) that followed it in the training documents.  A symbol seen in
the longest context takes its count's share there; else the model escapes
(method C: as many escapes as distinct symbols) to the context one byte
shorter, where the symbols of the longer one are excluded, and so on down to
a uniform choice among symbols never seen.  A text begins after ``ORDER`` zero
bytes and ends with the end symbol.

The trie is a set of tables in Spark, one per depth.  Texts are read in blocks
(slices of a task's rows); a block's distinct byte strings and words are
joined with the model, and come back to the block as its own dictionary, so
neither the model nor the vocabulary is ever held whole.  ``documents`` must
be a frame that gives the same rows in the same partitions when read again
(a table read from files); a block that finds its dictionary lacking fails.

Null or empty text is the end symbol alone.  Repeated rows count each.  With
no training documents every symbol is uniform, and every token unknown.  A very
long text is a block of its own, scored whole.  Only ``doc_id`` and ``text`` are
read, so other columns may have any name.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fold, give_back, lower_ascii, numbered_slices, stage, text_bytes, text_slices, words_of

ORDER = 4
SYMBOLS = 257
END = 256
#: Bytes of text in a block, and bytes that a numpy step looks at.
BLOCK, STEP = 16 << 20, 1 << 20
#: Measured rows of the model up to which it is broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000
GRAM, WORD = 0, 1


def _grams(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of each symbol with its context, and each row's first place."""
    n = len(ends) - 1
    size = np.diff(ends)
    first = ends[:-1] + np.arange(n) * (ORDER + 1)
    stream = np.zeros(len(data) + n * (ORDER + 1), np.int64)
    row = np.repeat(np.arange(n), size)
    stream[np.arange(len(data)) + (row + 1) * ORDER + row] = data
    stream[first + ORDER + size] = END
    code = np.zeros(len(stream) - ORDER, np.int64)
    for i in range(ORDER):
        code = (code << 8) | (stream[i:len(stream) - ORDER + i] & 255)
    code = (code << 9) | stream[ORDER:]
    keep = np.ones(len(code), bool)
    later = first[1:]
    for i in range(ORDER):
        keep[later - ORDER + i] = False
    return code[keep], np.append(ends[:-1] + np.arange(n), len(data) + n)


def _word_keys(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words, each word's place among them, and each
    row's first word."""
    from xxhash import xxh64_intdigest

    words, first, _, _ = words_of(lower_ascii(data), ends)
    coded = words.dictionary_encode()
    keys = np.array([xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64).view(np.int64)
    return keys, coded.indices.to_numpy(), first


def _end_key() -> int:
    """Key of the end token; its string holds a space, so it is no word's."""
    from xxhash import xxh64_intdigest

    return int(np.array([xxh64_intdigest(b" end")], np.uint64).view(np.int64)[0])


def _tally(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    index, distinct = pd.factorize(keys, sort=True)
    return distinct, np.bincount(index, weights=counts, minlength=len(distinct)).astype(np.int64)


def dictionary(documents: DataFrame) -> DataFrame:
    """(block, kind, key, n): each block's distinct byte strings and words
    with their counts in training documents; ``train`` marks those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = _end_key()
        for block, part in numbered_slices(batches, BLOCK):
            give_back()
            found: dict[int, list] = {GRAM: [], WORD: []}
            for step in text_slices([part], limit=STEP):
                train = step.column("train").to_numpy(zero_copy_only=False).astype(np.int64)
                data, ends = text_bytes(step.column("text"))
                code, first = _grams(data, ends)
                found[GRAM].append(_tally(code, np.repeat(train, np.diff(first))))
                keys, index, first = _word_keys(data, ends)
                counts = np.bincount(index, weights=np.repeat(train, np.diff(first)), minlength=len(keys)).astype(np.int64)
                found[WORD].append((np.append(keys, end), np.append(counts, train.sum())))
            for kind, parts in found.items():
                keys, counts = _tally(*(np.concatenate(v) for v in zip(*parts, strict=True)))
                for lo in range(0, len(keys), 200_000):
                    some = slice(lo, lo + 200_000)
                    n = len(keys[some])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, block)), pa.array(np.full(n, kind, np.int32)), pa.array(keys[some]), pa.array(counts[some])],
                        ["block", "kind", "key", "n"])

    # the columns of the scoring pass: Arrow batches, and so blocks, end by the bytes of all columns
    return documents.select("doc_id", "text", "train").mapInArrow(run, "block long, kind int, key long, n long")


def _context(gram: Column, order: int) -> Column:
    return F.shiftright(gram, 9).bitwiseAND(F.lit((1 << (8 * order)) - 1))


def _symbol(gram: Column) -> Column:
    return gram.bitwiseAND(F.lit(511).cast("long"))


def trie(grams: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """Per depth 0 .. ORDER: (symbols, contexts) of the training counts.

    symbols: (c, s, n).  contexts: (c, total, distinct, below): its counts,
    its distinct symbols, and what those count for in the context one byte
    shorter, which excludes them after an escape.
    """
    seen = grams.filter("n > 0")
    full = seen.select(_context(F.col("key"), ORDER).alias("c"), _symbol(F.col("key")).alias("s"), "n")
    depth = {ORDER: full}
    for k in range(ORDER - 1, -1, -1):
        shorter = F.col("c").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        depth[k] = stage(depth[k + 1].select(shorter.alias("c"), "s", "n").groupBy("c", "s").agg(F.sum("n").alias("n")), "trie")
    out = []
    for k in range(ORDER + 1):
        own = depth[k]
        if k:
            shorter = F.col("c").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))
            less = depth[k - 1].select(F.col("c").alias("c0"), F.col("s").alias("s0"), F.col("n").alias("n0"))
            own = own.withColumn("c1", shorter).join(less, (F.col("c1") == F.col("c0")) & (F.col("s") == F.col("s0")))
        else:
            own = own.withColumn("n0", F.lit(0).cast("long"))
        contexts = own.groupBy("c").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("distinct"), F.sum("n0").alias("below"))
        out.append((depth[k], stage(contexts, "contexts")))
    return out


def symbol_scores(grams: DataFrame) -> DataFrame:
    """(key, value): log10 probability of every symbol in its context."""
    levels = trie(grams)
    symbols, contexts = levels[ORDER]
    own = F.log10(F.col("n") / (F.col("total") + F.col("distinct")))
    known = (grams.filter("n > 0").withColumn("c", _context(F.col("key"), ORDER)).join(contexts, "c")
             .select("key", own.alias("value")))
    # unseen in the longest context: escape until a context knows the symbol
    left = grams.filter("n = 0").select("key", F.lit(0.0).alias("value"), F.lit(False).alias("done"),
                                        F.lit(0).cast("long").alias("below_"), F.lit(0).cast("long").alias("distinct_"))
    for k in range(ORDER, -1, -1):
        symbols, contexts = levels[k]
        left = left.withColumn("c", _context(F.col("key"), k)).withColumn("s", _symbol(F.col("key")))
        left = left.join(contexts, "c", "left").join(symbols, ["c", "s"], "left")
        total = F.coalesce("total", F.lit(0)) - F.col("below_")
        fresh = F.coalesce("distinct", F.lit(0)) - F.col("distinct_")
        if k == 0:  # with every symbol seen there is nothing to escape to
            fresh = F.when(F.coalesce("distinct", F.lit(0)) >= SYMBOLS, 0).otherwise(fresh)
        found = ~F.col("done") & F.col("n").isNotNull()
        add = F.when(F.col("done"), 0.0).when(F.col("n").isNotNull(), F.log10(F.col("n") / (total + fresh))).when(
            total + fresh > 0, F.log10(fresh / (total + fresh))).otherwise(0.0)
        left = left.select("key", (F.col("value") + add).alias("value"), (F.col("done") | found).alias("done"),
                           F.coalesce("below", F.lit(0)).alias("below_"), F.coalesce("distinct", F.lit(0)).alias("distinct_"))
    uniform = -F.log10(F.greatest(F.lit(SYMBOLS) - F.col("distinct_"), F.lit(1)))
    rest = left.select("key", F.when(F.col("done"), F.col("value")).otherwise(F.col("value") + uniform).alias("value"))
    return known.unionByName(rest)


def score(documents: DataFrame) -> DataFrame:
    """Every whole text's ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigram) and ``score`` (PPM), log10, with ``held_out``;
    trained on the documents that are not held out."""
    texts = documents.select("doc_id", "text", (fold("doc_id") != 1).alias("train"))
    found = stage(dictionary(texts), "dictionary")
    grams = stage(found.filter(F.col("kind") == GRAM).groupBy("key").agg(F.sum("n").alias("n")), "grams")
    values = stage(symbol_scores(grams), "symbols")
    if values.count() <= BROADCAST_ROWS:
        values = F.broadcast(values)
    gram_values = found.filter(F.col("kind") == GRAM).join(values, "key").select("block", "kind", "key", "value")
    by_key = Window.partitionBy("key")
    words = stage(found.filter(F.col("kind") == WORD).select(
        "block", "kind", "key", "n", F.sum("n").over(by_key).alias("c"), F.row_number().over(by_key.orderBy("block")).alias("place")), "words")
    row = words.agg(F.sum("n").alias("tokens"), F.count_if((F.col("place") == 1) & (F.col("c") > 0)).alias("distinct")).first()
    tokens, distinct = int(row.tokens or 0), int(row.distinct or 0)
    looked = gram_values.unionByName(words.select("block", "kind", "key", F.col("c").cast("double").alias("value")))

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, part in numbered_slices(batches, BLOCK):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, block)), part.column("doc_id"), part.column("text"),
                                              part.column("train")], ["block", "doc_id", "text", "train"])

    def sums(key: tuple, own: pa.Table, known: pa.Table) -> pa.Table:
        give_back()
        kind, keys, value = (known.column(c).to_numpy() for c in ("kind", "key", "value"))
        of = {k: pd.Series(value[kind == k], index=pd.Index(keys[kind == k])) for k in (GRAM, WORD)}
        end_count = of[WORD].get(_end_key(), 0.0)
        log_n = np.log10(tokens + 0.5 * (distinct + 1))
        out = []
        for batch in text_slices(own.to_batches(), limit=STEP):
            data, ends = text_bytes(batch.column("text"))
            code, first = _grams(data, ends)
            index, each = pd.factorize(code)
            score = np.add.reduceat(_looked(of[GRAM], each)[index], first[:-1])
            keys_, index, first = _word_keys(data, ends)
            c = _looked(of[WORD], keys_)
            base = np.log10(c + 0.5) - log_n
            per_row = lambda v, first=first: _row_sums(v, first)
            n = np.diff(first) + 1
            out.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(~batch.column("train").to_numpy(zero_copy_only=False)), pa.array(n),
                 pa.array(per_row((c > 0)[index].astype(np.int64)) + int(end_count > 0)), pa.array(np.full(len(n), tokens)),
                 pa.array(per_row(base[index]) + np.log10(end_count + 0.5) - log_n), pa.array(score)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]))
        return pa.Table.from_batches(out, _RESULT)

    tagged = texts.mapInArrow(tag, "block long, doc_id long, text string, train boolean")
    return tagged.groupBy("block").cogroup(looked.groupBy("block")).applyInArrow(
        sums, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_RESULT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                     ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])


def _looked(values: pd.Series, keys: np.ndarray) -> np.ndarray:
    at = values.index.get_indexer(keys)
    if (at < 0).any():
        raise ValueError("documents changed between two reads; read them from a table")
    return values.to_numpy()[at]


def _row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[first[1:]] - total[first[:-1]]
