"""Language identification by a linear-chain conditional random field.

The chain runs over the words of a text; the label of a word is a language.  A
word's score for a language is the sum of learned weights of its features:
byte n-grams, prefixes and suffixes (hashed), and how the word's uses are
shared among the languages by a lexicon of frequent words.  Learned
transitions tie neighbouring words together, so that a text in several
languages gets a label per word and rare or misspelt words follow their
neighbours.  Forward-backward gives every word's probabilities; a text's
language is the one with the greatest sum over its words, its score that sum's
share.

Learning.  The lexicon's counts cover all training texts.  The weights are
fitted to a bounded sample: at most ``per_language`` training texts of each
language, of each at most ``windows`` runs of ``span`` words spread evenly over
the text.  A training text's words carry its language; half of the sequences
are spliced from two runs of unlike languages, from which the transitions
learn switches.  Only text and language are used.

Prediction reads whole texts.  A chain is cut into segments whose transfer
matrices are multiplied step by step for all segments at once, so that a very
long text costs few steps; the result is that of the uncut chain.

A text that is null or has no letter is ``und`` with score 0, as is every text
if there is nothing to learn from.  Equal sums go to the first language in
alphabetic order.  The model's size grows with the number of languages, which is
taken to be some dozens.  A null doc_id counts as the empty text in the fold.  Rows of
equal doc_id are judged each by its own text.  Only ``doc_id``, ``text`` and
``lang`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import binary_array, give_back, lower_ascii, pieces, stage, text_bytes, text_slices

#: Bounds of what is fitted: training texts a language, runs a text, words a
#: run, words of the lexicon, hashed features.
PER_LANGUAGE = 250
WINDOWS = 3
SPAN = 40
LEXICON = 20_000
BUCKETS = 1 << 16

#: Longest n-gram, prefix and suffix in bytes; shares that part the lexicon's bins.
ORDER = 4
SHARES = (0.05, 0.3, 0.7, 0.95)
STEPS = 50
RATE = 0.2
RIDGE = 1e-3

#: Text of one counting step.
COUNT_BYTES = 16 << 20

#: Value of the contract for texts without a language.
NONE = "und"

_GAP = np.ones(256, bool)
_GAP[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def training(doc_id: Column | str) -> Column:
    """Whether a row may be learnt from: ``crc32(doc_id as text) mod 3`` is not 1."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 3 != 1


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of letters (all bytes from 0x80 on count as such), A-Z lowered, of
    all texts, and the index of each text's first."""
    data, ends = text_bytes(column)
    gap = _GAP[data]
    starts, stops, first = pieces(data, ends, gap)
    return binary_array(lower_ascii(data[~gap]), stops - starts), first


# --------------------------------------------------------------- features

@dataclass
class Model:
    """Languages, weights of hashed features, of lexicon bins and of
    transitions, and the lexicon with its words' bins."""

    languages: list[str]
    weights: np.ndarray
    lexicon_weights: np.ndarray
    transitions: np.ndarray
    lexicon: pa.Array
    bins: np.ndarray


def _hashed(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashed features of distinct words, some at a time: the words' numbers
    and the features' buckets."""
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0]: offsets[-1]].astype(np.uint64)
    ends = offsets - offsets[0]
    owner = np.repeat(np.arange(len(words)), np.diff(ends))
    sums = np.zeros(len(data), np.uint64)
    for n in range(1, ORDER + 1):
        last = np.arange(len(data)) + n - 1
        inside = last < ends[1:][owner]
        sums[inside] = sums[inside] * np.uint64(0x100000001B3) + data[last[inside]] + np.uint64(1)
        long = np.flatnonzero(np.diff(ends) >= n)
        for kind, who, at in ((0, owner[inside], np.flatnonzero(inside)), (1, long, ends[long]), (2, long, ends[long + 1] - n)):
            yield who, _bucket(sums[at], 3 * n + kind)


def _bucket(sums: np.ndarray, salt: int) -> np.ndarray:
    x = (sums ^ np.uint64(salt * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _norm(words: pa.Array) -> np.ndarray:
    """One over the root of the number of hashed features of each word."""
    size = np.diff(np.frombuffer(words.buffers()[1], np.int32)[words.offset: words.offset + len(words) + 1]).astype(np.int64)
    total = np.zeros(len(words), np.int64)
    for n in range(1, ORDER + 1):
        total += np.maximum(size - n + 1, 0) + 2 * (size >= n)
    return 1 / np.sqrt(np.maximum(total, 1))


def _bins(words: pa.Array, lexicon: pa.Array, bins: np.ndarray) -> np.ndarray:
    """Lexicon features of each word: one bin per language; a row of zeros
    (the bin of unknown words) if the lexicon lacks it."""
    at = pc.fill_null(pc.index_in(words, value_set=lexicon), -1).to_numpy(zero_copy_only=False)
    out = np.zeros((len(words), bins.shape[1]), np.int64)
    out[at >= 0] = bins[at[at >= 0]]
    return out


def emissions(words: pa.Array, model: Model) -> np.ndarray:
    """Scores of distinct words for each language."""
    k = len(model.languages)
    out = np.zeros((len(words), k))
    for who, bucket in _hashed(words):
        for j in range(k):
            out[:, j] += np.bincount(who, model.weights[bucket, j], len(words))
    out *= _norm(words)[:, None]
    for j, column in enumerate(_bins(words, model.lexicon, model.bins).T):
        out += model.lexicon_weights[j, column]
    return out


# ------------------------------------------------------- forward-backward

def _normed(x: np.ndarray) -> np.ndarray:
    return x / x.sum(-1, keepdims=True)


def marginals(scores: np.ndarray, first: np.ndarray, transitions: np.ndarray, segment: int = 64) -> np.ndarray:
    """Label probabilities of every word.  ``scores`` are the words' scores of
    all chains, end to end; ``first`` is the index of each chain's first word
    (n + 1 values).  Before a chain every label is equally likely."""
    k = scores.shape[1]
    if not len(scores):
        return np.zeros((0, k))
    lengths = np.diff(first)
    cuts = -(-lengths // segment)
    seg_first = np.concatenate(([0], np.cumsum(cuts)))
    n = int(seg_first[-1])
    seg_chain = np.repeat(np.arange(len(lengths)), cuts)
    nth = np.arange(n) - seg_first[seg_chain]
    begin = first[seg_chain] + nth * segment
    size = np.minimum(lengths[seg_chain] - nth * segment, segment)
    steps = int(size.max())
    own = np.arange(steps)[:, None] < size
    x = np.ones((steps, n, k))
    x[own] = np.exp(scores - scores.max(1, keepdims=True))[(begin + np.arange(steps)[:, None])[own]]
    move = np.exp(transitions - transitions.max())
    # what a segment does to the labels before it
    whole = np.broadcast_to(np.eye(k), (n, k, k)).copy()
    for t in range(steps):
        on = own[t]
        after = (whole[on] @ move) * x[t, on, None, :]
        whole[on] = after / after.sum((1, 2), keepdims=True)
    enter, leave = np.full((n, k), 1 / k), np.ones((n, k))
    order = np.argsort(-cuts, kind="stable")
    most = int(cuts.max())
    for i in range(1, most):
        at = seg_first[order[: np.searchsorted(-cuts[order], -i, side="left")]] + i
        enter[at] = _normed((enter[at - 1, None, :] @ whole[at - 1])[:, 0])
    for i in range(most - 1, 0, -1):
        at = seg_first[order[: np.searchsorted(-cuts[order], -i, side="left")]] + i
        leave[at - 1] = _normed((whole[at] @ leave[at, :, None])[:, :, 0])
    ahead = np.empty((steps, n, k))
    state = enter
    for t in range(steps):
        state = np.where(own[t][:, None], _normed((state @ move) * x[t]), state)
        ahead[t] = state
    out = np.empty((len(scores), k))
    back = leave
    for t in range(steps - 1, -1, -1):
        on = own[t]
        out[begin[on] + t] = _normed(ahead[t, on] * back[on])
        back = np.where(on[:, None], _normed((x[t] * back) @ move.T), back)
    return out


# --------------------------------------------------------------- learning

def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(lang, word, n)`` of every piece of the training texts."""
    for part in text_slices(batches, limit=COUNT_BYTES):
        words, first = words_of(part.column("text"))
        lang = part.column("lang").dictionary_encode()
        coded = words.dictionary_encode()
        owner = np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(first))
        both, n = np.unique(owner * max(len(coded.dictionary), 1) + coded.indices.to_numpy(), return_counts=True)
        which, word = both // max(len(coded.dictionary), 1), both % max(len(coded.dictionary), 1)
        yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(which)), coded.dictionary.take(pa.array(word)), pa.array(n)],
                                         ["lang", "word", "n"])
        give_back()


def _runs(batches: Iterable[pa.RecordBatch], windows: int, span: int) -> Iterator[pa.RecordBatch]:
    """Up to ``windows`` runs of ``span`` words of each text, evenly spread."""
    for part in text_slices(batches):
        words, first = words_of(part.column("text"))
        lang, runs = [], []
        for i, name in enumerate(part.column("lang").to_pylist()):
            n = int(first[i + 1] - first[i])
            for start in sorted({j * max(n - span, 0) // max(windows - 1, 1) for j in range(windows)}):
                lang.append(name)
                runs.append(words.slice(int(first[i]) + start, min(span, n - start)).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(runs, pa.list_(pa.binary()))], ["lang", "words"])


def _sampled(rows: DataFrame, counts: dict[str, int], per_language: int) -> DataFrame:
    """At most ``per_language`` texts of each language: a share by hash of
    every text first, so that no language is ranked whole."""
    share = F.create_map(*(F.lit(x) for name, n in counts.items() for x in (name, min(1.0, 4 * per_language / n))))
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    some = rows.withColumn("draw", draw).where(F.col("draw") < share[F.col("lang")] * (1 << 30))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    return some.withColumn("nth", nth).where(F.col("nth") <= per_language).select("lang", "text")


def fit(documents: DataFrame, per_language: int = PER_LANGUAGE, windows: int = WINDOWS, span: int = SPAN,
        lexicon_size: int = LEXICON) -> Model:
    """Learn from the training rows of ``documents`` (``doc_id``, ``text``,
    ``lang``)."""
    rows = documents.select("doc_id", "text", "lang").where(
        training("doc_id") & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").collect()}
    languages = list(counts)
    k = len(languages)
    if not k:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros((0, 1, 0)), np.zeros((0, 0)), pa.array([], pa.binary()), np.zeros((0, 0), np.int64))
    uses = stage(rows.select("text", "lang").mapInArrow(_counts, "lang string, word binary, n long")
                 .groupBy("word", "lang").agg(F.sum("n").alias("n")), "language-words")
    per = {r.lang: r.n for r in uses.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    # the least level of counts above which at most lexicon_size words lie
    level = F.floor(F.log("n") * 32)
    sizes = uses.groupBy("word").agg(F.sum("n").alias("n")).groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words"))
    held, least = 0, None
    for r in sizes.orderBy(F.col("level").desc()).collect():
        held += r.words
        if held > lexicon_size:
            break
        least = r.level
    words = uses.groupBy("word").agg(F.sum("n").alias("n"), F.collect_list(F.struct("lang", "n")).alias("uses"))
    frequent = [] if least is None else words.where(level >= least).orderBy(F.col("n").desc(), "word").collect()
    lexicon = pa.array([bytes(r.word) for r in frequent], pa.binary())
    share = np.zeros((len(frequent), k))
    for i, r in enumerate(frequent):
        for use in r.uses:
            share[i, languages.index(use.lang)] = use.n / per[use.lang]
    bins = 1 + np.searchsorted(SHARES, share / np.maximum(share.sum(1, keepdims=True), 1e-300), side="right")
    sample = _sampled(rows, counts, per_language).mapInArrow(
        lambda batches: _runs(batches, windows, span), "lang string, words array<binary>").collect()
    runs = sorted((r.lang, [bytes(w) for w in r.words]) for r in sample)
    return _learn(languages, runs, lexicon, bins)


def _spliced(runs: list, rng: np.random.Generator) -> list[tuple[list[bytes], list[int]]]:
    """Half of the runs as they are, half cut and joined with the rest of
    another one."""
    order, out = rng.permutation(len(runs)), []
    for i, at in enumerate(order):
        name, words = runs[at]
        if i % 2 and len(words) > 1:
            other, more = runs[order[i - 1]]
            cut = int(rng.integers(1, len(words)))
            out.append((words[:cut] + more[cut:], [name] * cut + [other] * len(more[cut:])))
        else:
            out.append((words, [name] * len(words)))
    return out


def _learn(languages: list[str], runs: list, lexicon: pa.Array, bins: np.ndarray) -> Model:
    """Adam on the ridge-penalised log-likelihood of the sample's sequences."""
    rng = np.random.default_rng(12)
    k = len(languages)
    chains = _spliced([(languages.index(name), words) for name, words in runs if words], rng)
    first = np.concatenate(([0], np.cumsum([len(w) for w, _ in chains]))).astype(np.int64)
    coded = pa.array([w for words, _ in chains for w in words], pa.binary()).dictionary_encode()
    word, label = coded.indices.to_numpy(), np.array([y for _, ys in chains for y in ys], np.int64)
    words = coded.dictionary
    who, bucket = (np.concatenate(x) for x in zip(*_hashed(words)))
    norm = _norm(words)
    lex = _bins(words, lexicon, bins)
    model = Model(languages, np.zeros((BUCKETS, k)), np.zeros((k, len(SHARES) + 2, k)), np.zeros((k, k)), lexicon, bins)
    truth = np.zeros((len(word), k))
    truth[np.arange(len(word)), label] = 1
    inner = np.ones(len(word), bool)
    inner[first[:-1]] = False
    pairs = np.zeros((k, k))
    np.add.at(pairs, (label[:-1][inner[1:]], label[1:][inner[1:]]), 1)
    heads = np.bincount(label[first[:-1]], minlength=k)
    parts = (model.weights, model.lexicon_weights, model.transitions)
    speed, size = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    for step in range(1, STEPS + 1):
        score = np.stack([np.bincount(who, model.weights[bucket, j], len(words)) for j in range(k)], 1) * norm[:, None]
        for j in range(k):
            score += model.lexicon_weights[j, lex[:, j]]
        each = score[word]
        likely = marginals(each, first, model.transitions)
        wrong = truth - likely
        by_word = np.stack([np.bincount(word, wrong[:, j], len(words)) for j in range(k)], 1)
        scaled = by_word * norm[:, None]
        grad_weights = np.stack([np.bincount(bucket, scaled[who, j], BUCKETS) for j in range(k)], 1)
        grad_lexicon = np.stack([np.stack([np.bincount(lex[:, i], by_word[:, j], len(SHARES) + 2) for j in range(k)], 1) for i in range(k)])
        # before the first word every label is equally likely
        before = np.exp(model.transitions - model.transitions.max(0))
        before /= before.sum(0)
        expected = _pair_sums(each, first, likely, inner, model.transitions)
        grad_moves = pairs - expected + before * (heads - likely[first[:-1]].sum(0))
        for p, g, v, s in zip(parts, (grad_weights, grad_lexicon, grad_moves), speed, size):
            g = g / len(word) - RIDGE / len(word) * p
            v += 0.1 * (g - v)
            s += 0.01 * (g * g - s)
            p += RATE * (v / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.99 ** step)) + 1e-8)
    return model


def _pair_sums(scores: np.ndarray, first: np.ndarray, likely: np.ndarray, inner: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Expected numbers of neighbouring label pairs.

    Given the words up to t, the label before a word depends on that word's
    label alone, by the forward probabilities; these follow from the chain
    without the words after it, one step at a time for all chains."""
    k = scores.shape[1]
    x = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max())
    lengths = np.diff(first)
    out = np.zeros((k, k))
    order = np.argsort(-lengths, kind="stable")
    state = np.full((len(lengths), k), 1 / k)
    for t in range(int(lengths.max(initial=0))):
        own = order[: np.searchsorted(-lengths[order], -t, side="left")]
        at = first[own] + t
        if t:
            joint = state[own][:, :, None] * move
            joint /= joint.sum(1, keepdims=True)
            out += (joint * likely[at][:, None, :]).sum(0)
        state[own] = _normed((state[own] @ move) * x[at])
    return out


# -------------------------------------------------------------- prediction

def _predict(batches: Iterable[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    names = pa.array([*model.languages, NONE])
    k = len(model.languages)
    rows = max(1, (1 << 21) // max(k * k, 1))
    segment = max(64, 4 * k * k)
    for part in text_slices(b.slice(i, rows) for b in batches for i in range(0, b.num_rows, rows)):
        best, score = np.full(part.num_rows, k), np.zeros(part.num_rows)
        words, first = words_of(part.column("text"))
        if k and len(words):
            coded = words.dictionary_encode()
            likely = marginals(emissions(coded.dictionary, model)[coded.indices.to_numpy()], first, model.transitions, segment)
            sums = np.concatenate((np.zeros((1, k)), np.cumsum(likely, 0)))
            total = sums[first[1:]] - sums[first[:-1]]
            known = (np.diff(first) > 0) & part.column("letters").to_numpy(zero_copy_only=False)
            best[known] = total[known].argmax(1)
            score[known] = np.clip(total[known].max(1) / np.diff(first)[known], 0, 1)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), names.take(pa.array(best)), pa.array(score)],
                                         ["doc_id", "held_out", "lang_pred", "score"])
        give_back()


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of every row of ``documents``."""
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), (~training("doc_id")).alias("held_out"),
                            F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(lambda batches: _predict(batches, model),
                           f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def word_languages(text: str, model: Model) -> list[tuple[str, str, float]]:
    """Every word of one text with its language and that one's probability."""
    words, first = words_of(pa.array([text], pa.string()))
    likely = marginals(emissions(words, model), first, model.transitions)
    return [(w.decode(errors="replace"), model.languages[p.argmax()], float(p.max())) for w, p in zip(words.to_pylist(), likely)]
