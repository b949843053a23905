"""Hierarchical multi-length packing of documents into training sequences.

Each document (its ids, then the end id) is cut into full windows of the
longest tier; its rest is routed to the shortest tier that holds it.  Tiers
are packed from the longest down: a rest opens a window of its tier, and the
gap takes the longest shorter rests that fit whole, then a cut from the
shortest rest left.  Every window is thus filled to its tier's length exactly.
What is left at a task's end fills windows of falling powers of two, so no
sequence is padded.

Everything happens inside the task that reads the rows: no shuffle, and a
task holds one chunk of ids.  Windows of one tier go, in turn, to step groups
of ``STEP_TOKENS`` tokens each, so that the groups of a task are balanced and
a group holds one window length (a task's last group per tier may be short).

Null or empty text is a document of the end id alone.  Repeated rows are
documents of their own.  A text of any length is cut over as many windows as it
needs.  Only ``doc_id`` and ``text`` are read, so other columns may have any
name.  An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import give_back, text_slices
from .tokens import encoder, vocabulary_path

LONGEST = 4096
SHORTEST = 256
END_ID = 2
STEP_TOKENS = 16 * LONGEST
#: Bytes of text packed at a time, and encoded at a time.
CHUNK = 6 << 20
ENCODED = 2 << 20

SCHEMA = ("doc_id long, start long, length long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long, ids binary")


class Packer:
    """Packs the chunks of one task; ``task`` numbers its sequences."""

    def __init__(self, task: int, longest: int = LONGEST, shortest: int = SHORTEST,
                 step_tokens: int = STEP_TOKENS):
        self.task, self.longest, self.shortest, self.step_tokens = task, longest, shortest, step_tokens
        self.sequences = 0
        self.windows: dict[int, int] = {}
        self.rows: list[tuple] = []
        self.pool: list[tuple] = []  # (length, key, document, start, doc_tokens, ids)
        self.keys = 0

    def tier(self, length: int) -> int:
        return max(self.shortest, 1 << (length - 1).bit_length())

    def _emit(self, window: list[tuple], tier: int) -> None:
        sequence = (self.task << 33) | self.sequences
        turn = self.windows.get(tier, 0)
        self.windows[tier] = turn + 1
        group = (self.task << 33) | (tier.bit_length() << 27) | (turn * tier // self.step_tokens)
        offset = 0
        for length, _, document, start, total, ids in window:
            self.rows.append((document, start, length, total, sequence, offset, tier, group,
                              ids[:length].astype("<u4").tobytes()))
            offset += length
        self.sequences += 1

    def _keep(self, document: int | None, start: int, total: int, ids: np.ndarray) -> None:
        self.keys += 1
        insort(self.pool, (len(ids), self.keys, document, start, total, ids), key=lambda x: x[:2])

    def _cut(self, piece: tuple, at: int) -> tuple[tuple, tuple]:
        length, key, document, start, total, ids = piece
        return ((at, key, document, start, total, ids[:at]),
                (length - at, key, document, start + at, total, ids[at:]))

    def add(self, document: int | None, ids: np.ndarray) -> None:
        total = len(ids)
        full = total - total % self.longest
        for start in range(0, full, self.longest):
            self._emit([(self.longest, 0, document, start, total, ids[start:start + self.longest])],
                       self.longest)
        if full < total:
            self._keep(document, full, total, ids[full:])

    def pack(self) -> None:
        """Fill windows from the pool; an unfilled last one goes back to it."""
        pool = self.pool
        while pool:
            window = [pool.pop()]
            tier = self.tier(window[0][0])
            gap = tier - window[0][0]
            while gap and pool:
                i = bisect_right(pool, gap, key=lambda x: x[0]) - 1
                if i >= 0:
                    window.append(pool.pop(i))
                else:
                    head, rest = self._cut(pool.pop(0), gap)
                    window.append(head)
                    insort(pool, rest, key=lambda x: x[:2])
                gap -= window[-1][0]
            if gap:
                pool.extend(sorted(window, key=lambda x: x[:2]))
                return
            self._emit(window, tier)

    def flush(self) -> None:
        """Lay the rest in windows of falling powers of two."""
        left = sum(x[0] for x in self.pool)
        while left:
            tier = 1 << (left.bit_length() - 1)
            left -= tier
            window, gap = [], tier
            while gap:
                piece = self.pool.pop()
                if piece[0] > gap:
                    piece, rest = self._cut(piece, gap)
                    self.pool.append(rest)
                window.append(piece)
                gap -= piece[0]
            self._emit(window, tier)

    def take(self) -> pa.RecordBatch:
        """The rows made so far."""
        rows, self.rows = self.rows, []
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                 pa.int64(), pa.binary()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def pack_documents(documents: DataFrame, longest: int = LONGEST, shortest: int = SHORTEST,
                   end_id: int = END_ID, step_tokens: int = STEP_TOKENS,
                   vocabulary: str | None = None) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place
    there, the window length (``tier``), the step group and the piece's ids
    (little-endian unsigned 32-bit)."""
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, codes = Packer(TaskContext.get().partitionId(), longest, shortest, step_tokens), encoder(path)
        for part in text_slices(batches, limit=CHUNK):
            for some in text_slices([part], limit=ENCODED):
                ids, bounds = codes.encode(some.column("text"))
                for i, document in enumerate(some.column("doc_id").to_pylist()):
                    own = np.empty(bounds[i + 1] - bounds[i] + 1, np.uint32)
                    own[:-1], own[-1] = ids[bounds[i]:bounds[i + 1]], end_id
                    packer.add(document, own)
                    if len(packer.rows) >= 2_000:
                        yield packer.take()
            packer.pack()
            yield packer.take()
            give_back()
        packer.flush()
        yield packer.take()

    return documents.select("doc_id", "text").mapInArrow(run, SCHEMA)
