"""Ids of a public word-level BPE for whole Arrow text columns.

The vocabulary never merges across ASCII white space, so a text's ids are the
ids of its white-space separated words, joined.  Each distinct word is encoded
once per chunk and the ids are gathered; a worker remembers words of earlier
chunks (a bounded cache that only saves time).
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import binary_array, lower_ascii, ragged, text_bytes, words_of

VOCABULARY = "word_bpe_49k.json"
#: Words that a worker remembers at most before it starts anew.
CACHE_WORDS = 500_000
#: Distinct words joined into one text for the tokenizer.
JOINED = 100

# Punctuation that always forms its own run at a word's end, and
# letters whose runs are one pre-token each.
_TRAIL = ".,!#$%&*|:;?"
_PLAIN = "^[a-zÀ-ÖØ-öø-ÿ]+$"
_SPECIAL = "<\\|(startoftext|endoftext)\\|>"   # in any case: lowering must not make one

_ENCODERS: dict[str, WordEncoder] = {}


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> WordEncoder:
    """This worker's encoder for a vocabulary file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class WordEncoder:
    """Exact ids without special tokens, one distinct word at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, i in vocabulary.items():
            self.ends_word[i] = token.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.known: list[pa.Array] = []
        self.words = 0
        self.trails: dict[str, int] = {}
        self.ids: list[np.ndarray] = []
        self.first: list[np.ndarray] = []
        self.count: list[np.ndarray] = []
        self.held = 0

    def _learn(self, words: list[str], plain: bool) -> None:
        """Append the ids of new words to the table."""
        if plain:
            texts = [" ".join(words[i:i + JOINED]) for i in range(0, len(words), JOINED)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in
                                  self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            stops = np.flatnonzero(self.ends_word[ids]) + 1
            if len(stops) != len(words):
                return self._learn(words, False)
            counts = np.diff(stops, prepend=0)
        else:
            each = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
            counts = np.array([len(x) for x in each], np.int64)
            ids = np.array([i for x in each for i in x], np.uint32)
        self.known.append(pa.array(words, pa.string()))
        self.words += len(words)
        self.ids.append(ids)
        self.first.append(self.held + np.cumsum(counts) - counts)
        self.count.append(counts)
        self.held += len(ids)

    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        for parts in (self.ids, self.first, self.count):
            if len(parts) > 1:
                parts[:] = [np.concatenate(parts)]
        return self.ids[0], self.first[0], self.count[0]

    def _rows(self, words: pa.Array, plain: pa.Array) -> np.ndarray:
        """Table rows of distinct words, new ones learnt first."""
        rows = self._find(words)
        new = np.isnan(rows)
        kinds = plain.to_numpy(zero_copy_only=False)
        for kind in (True, False):
            mask = new & (kinds == kind)
            if mask.any():
                rows[mask] = self.words + np.arange(mask.sum())
                self._learn(words.filter(pa.array(mask)).to_pylist(), kind)
        return rows.astype(np.int64)

    def _trail(self, word: str) -> int:
        """Table row of a run of punctuation."""
        if word not in self.trails:
            self.trails[word] = self.words
            self._learn([word], False)
        return self.trails[word]

    def _find(self, words: pa.Array) -> np.ndarray:
        if len(self.known) > 1:
            self.known = [pa.concat_arrays(self.known)]
        if not self.known:
            return np.full(len(words), np.nan)
        return pc.index_in(words, value_set=self.known[0]).cast(pa.float64()).to_numpy(zero_copy_only=False)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end to end, and the n + 1 offsets of the rows."""
        special = pc.fill_null(pc.match_substring_regex(texts.cast(pa.large_string()), _SPECIAL, ignore_case=True), False)
        if pc.any(special).as_py():
            return self._whole(texts)
        data, ends = text_bytes(texts)
        words, first, _, _ = words_of(lower_ascii(data), ends)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if self.words > CACHE_WORDS:
            self._forget()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.string())
        core = pc.ascii_rtrim(distinct, characters=_TRAIL)
        plain = pc.match_substring_regex(core, _PLAIN)
        core = pc.if_else(plain, core, distinct)
        cores = core.dictionary_encode()
        core_rows = self._rows(cores.dictionary, pc.match_substring_regex(cores.dictionary, _PLAIN))
        core_rows = core_rows[cores.indices.to_numpy()]
        cut = pc.binary_length(core).to_numpy()
        whole = pc.binary_length(distinct).to_numpy()
        tails = np.full(len(distinct), -1, np.int64)
        tailed = np.flatnonzero(whole > cut)
        if len(tailed):
            word_data, word_ends = text_bytes(distinct)
            keep = ragged(word_ends[tailed] + cut[tailed], (whole - cut)[tailed])
            trail = binary_array(word_data[keep], (whole - cut)[tailed]).dictionary_encode()
            rows = np.array([self._trail(w) for w in trail.dictionary.cast(pa.string()).to_pylist()])
            tails[tailed] = rows[trail.indices.to_numpy()]
        ids, start, count = self._table()
        # ids of each distinct word: its core's, then its trail's
        tail_count = np.where(tails >= 0, count[tails], 0)
        both = np.stack([count[core_rows], tail_count], axis=1).ravel()
        froms = np.stack([start[core_rows], start[tails]], axis=1).ravel()
        own = ids[ragged(froms, both)]
        own_count = count[core_rows] + tail_count
        own_start = np.cumsum(own_count) - own_count
        index = coded.indices.to_numpy()
        lengths = own_count[index]
        flat = own[ragged(own_start[index], lengths)]
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        return flat, bounds[first]

    def _whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The tokenizer's own way; for chunks with special tokens' names."""
        each = [e.ids for e in self.tokenizer.encode_batch_fast(
            texts.fill_null("").to_pylist(), add_special_tokens=False)]
        bounds = np.concatenate(([0], np.cumsum([len(x) for x in each]))).astype(np.int64)
        return np.array([i for x in each for i in x], np.uint32), bounds

