"""Order of suffixes by induced sorting, with queues that spill to disk.

The order is exact up to ``depth`` symbols, which is all that a search for
repeats of that length needs.  Steps: classify suffixes as larger (L) or
smaller (S) than their successor; induce the order of the substrings between
leftmost S suffixes; name them; order the reduced string of names; induce all
suffixes from it.  Each bucket of first symbols is a queue in induction
order.  Queue entries are handled in whole arrays: an array's predecessors
are dealt to their buckets in one stable pass.

The reduced string has as many symbols as names, too many for one queue each;
it is ordered by prefix doubling, in at most log2(depth) rounds.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Queue entries held in memory; more go to a temporary file that has no name.
QUEUE_LIMIT = 4_000_000


class SpillQueues:
    """One first-in first-out queue of positions per symbol."""

    def __init__(self, symbols: int, limit: int = QUEUE_LIMIT):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.limit, self.held, self.end, self.file = limit, 0, 0, None

    def push(self, symbol: int, positions: np.ndarray) -> None:
        self.parts[symbol].append(positions)
        self.held += len(positions)
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(self.end)
        for queue in self.parts:
            for i, part in enumerate(queue):
                if isinstance(part, np.ndarray):
                    part.astype(np.int32).tofile(self.file)
                    queue[i] = (self.end, len(part))
                    self.end += 4 * len(part)
        self.held = 0

    def pop(self, symbol: int) -> np.ndarray:
        found, self.parts[symbol] = self.parts[symbol], []
        out = []
        for part in found:
            if isinstance(part, np.ndarray):
                self.held -= len(part)
                out.append(part)
            else:
                self.file.seek(part[0])
                out.append(np.fromfile(self.file, np.int32, part[1]))
        return np.concatenate(out) if out else np.zeros(0, np.int32)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _types(text: np.ndarray) -> np.ndarray:
    """True where the suffix is larger than its successor (L)."""
    change = np.flatnonzero(text[1:] != text[:-1])
    falls = text[change] > text[change + 1]
    # a run takes the type of its last symbol; the end of the text is S
    runs = np.diff(np.concatenate(([-1], change, [len(text) - 1])))
    return np.repeat(np.append(falls, False), runs)


class Inducer:
    """Inductions over one text whose last symbol, 0, occurs only there."""

    def __init__(self, text: np.ndarray, symbols: int, limit: int = QUEUE_LIMIT):
        self.text, self.symbols, self.limit = text, symbols, limit
        self.larger = _types(text)
        self.stars = np.flatnonzero(~self.larger[1:] & self.larger[:-1]).astype(np.int32) + 1

    def _step(self, batch: np.ndarray, larger: bool, symbol: int, queues: SpillQueues) -> np.ndarray:
        """Deal out the batch's predecessors of one type; those of the same
        symbol are returned, for they belong to the bucket at hand."""
        before = batch[batch > 0] - 1
        before = before[self.larger[before] == larger]
        if not len(before):
            return before
        first = self.text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
        own = before[:0]
        for part, head in zip(np.split(before, cuts), first[np.concatenate(([0], cuts))].tolist(), strict=True):
            if head == symbol:
                own = part
            else:
                queues.push(head, part)
        return own

    def induce(self, stars: np.ndarray) -> tuple[SpillQueues, SpillQueues]:
        """From ordered leftmost S suffixes: the L suffixes of each bucket in
        order, and the S suffixes of each bucket in reverse order."""
        heads = self.text[stars]
        seeds = np.searchsorted(heads, np.arange(self.symbols + 1))
        waiting, large, small = (SpillQueues(self.symbols, self.limit) for _ in range(3))
        for symbol in range(self.symbols):
            batch = waiting.pop(symbol)
            while len(batch):
                large.push(symbol, batch)
                batch = self._step(batch, True, symbol, waiting)
            self._step(stars[seeds[symbol]:seeds[symbol + 1]], True, symbol, waiting)
        kept = SpillQueues(self.symbols, self.limit)
        for symbol in range(self.symbols - 1, -1, -1):
            batch = waiting.pop(symbol)
            while len(batch):
                small.push(symbol, batch)
                batch = self._step(batch, False, symbol, waiting)
            batch = large.pop(symbol)
            kept.push(symbol, batch)
            self._step(batch[::-1], False, symbol, waiting)
        small.push(0, np.array([len(self.text) - 1], np.int32))
        waiting.close()
        large.close()
        return kept, small

    def ordered_stars(self, depth: int) -> np.ndarray:
        """Leftmost S suffixes in order of their first ``depth`` symbols."""
        stars = self.stars
        heads = np.argsort(self.text[stars], kind="stable")
        large, small = self.induce(stars[heads])
        large.close()
        is_star = np.zeros(len(self.text), bool)
        is_star[stars] = True
        by_content = np.concatenate([p[is_star[p]] for p in (small.pop(s)[::-1] for s in range(self.symbols))])
        small.close()
        place = np.zeros(len(self.text), np.int32)
        place[stars] = np.arange(len(stars))
        names = np.zeros(len(stars), np.int64)
        names[place[by_content]] = np.cumsum(np.append(False, self._differ(by_content, place)))
        ahead = 1
        while ahead < depth and len(names) and names.max() + 1 < len(names):
            key = names * (len(names) + 1)
            key[:-ahead] += names[ahead:] + 1
            order = np.argsort(key, kind="stable")
            fresh = np.append(False, key[order][1:] != key[order][:-1])
            names[order] = np.cumsum(fresh)
            ahead *= 2
        return stars[np.argsort(names, kind="stable")]

    def _differ(self, by_content: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Whether neighbours' substrings, up to the next star's first symbol,
        differ."""
        ends = np.append(self.stars[1:], len(self.text) - 1)
        length = ends[place[by_content]] - by_content + 1
        differ = length[1:] != length[:-1]
        same = np.flatnonzero(~differ)
        a, b, left = by_content[same], by_content[same + 1], length[same]
        at = 0
        while len(same):
            apart = self.text[a + at] != self.text[b + at]
            differ[same[apart]] = True
            at += 1
            going = ~apart & (left > at)
            same, a, b, left = same[going], a[going], b[going], left[going]
        return differ


def suffix_order(text: np.ndarray, symbols: int, depth: int, limit: int = QUEUE_LIMIT):
    """Yield positions, bucket by bucket, so that all suffixes come in the
    order of their first ``depth`` symbols.  ``text`` ends in its only 0."""
    inducer = Inducer(text, symbols, limit)
    large, small = inducer.induce(inducer.ordered_stars(depth))
    for symbol in range(symbols):
        yield np.concatenate([large.pop(symbol), small.pop(symbol)[::-1]])
    large.close()
    small.close()
