"""Substring dedup: bytes covered by a repeat of ``LENGTH`` bytes that also
starts in a document with a smaller doc_id are removed.

Sorting every suffix of the corpus would move many times its size.  Two exact
filters come first.  Every window of LENGTH bytes has an anchor, the smallest
hash among its ``GRAM``-byte strings, so equal windows have equal anchors; a
window whose anchor occurs in one document only repeats nowhere.  And a
window's neighbours share its anchor, so they travel as one piece, and equal
pieces of a slice travel once, without their places.

Pieces are dealt to shards by anchor, the windows of a hot anchor each by its
own hash.  A shard collapses equal pieces and sorts the window suffixes of the
anchors that still have several by external induced sorting (:mod:`.induced`);
neighbours in that order with a common prefix of LENGTH bytes form a class,
and each piece's windows go back to the slices with the class's first
document; a slice removes them from its other documents.  Every step is a
grouping of compressed blobs; a shard holds a row per slice and distinct piece.

``documents`` must give the same rows in the same partitions when read again
(a table read from files).  Null text is empty; shorter texts than LENGTH
have no windows.  Rows of one doc_id never remove from each other (no id is
smaller); a null doc_id counts as larger than any.  A very long text is cut
into windows like any other.  Only ``doc_id`` and ``text`` are read, so other
columns may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_array, give_back, numbered_slices, ragged, stage, text_bytes
from .induced import suffix_order

LENGTH = 50
GRAM = 20
#: Bytes of text in a slice, and bytes of text per shard (each has about a
#: thirtieth of that in anchors, and less in pieces).
SLICE, SHARD = 3 << 20, 8 << 20
#: Bytes of pieces that are looked at together before equal ones are one.
CHUNK = 1 << 20
#: Places that are hashed and compared at a time.
BLOCK = 1 << 14
#: Places of an anchor in a slice from which they are counted, and counted
#: places in the table from which its windows are dealt one by one.
COUNTED, HOT = 4, 20_000
_BASE = 0x9E3779B97F4A7C15
_LAST = np.iinfo(np.int64).max
_CHANGED = "documents changed between two reads; read them from a table"


def _in_blocks(values: np.ndarray, width: int, kind: type, step) -> np.ndarray:
    """``step`` over every ``width`` neighbours, BLOCK results at a time: its
    passes over the values then stay in the processor's cache."""
    n = max(len(values) - width + 1, 0)
    out = np.empty(n, kind)
    for lo in range(0, n, BLOCK):
        out[lo:lo + BLOCK] = step(values[lo:lo + BLOCK + width - 1])
    return out


def _gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every ``size`` bytes, never zero."""

    def block(part: np.ndarray) -> np.ndarray:
        n, out, width, done = len(part) - size + 1, None, 1, 0
        own = part.astype(np.uint64) + np.uint64(1)  # hashes of width bytes
        while True:
            step = np.uint64(pow(_BASE, width, 1 << 64))
            if size & width:
                part = own[done:done + n]
                out = part.copy() if out is None else out * step + part
                done += width
            if 2 * width > size:
                break
            own = own[:-width] * step + own[width:]
            width *= 2
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return (out ^ (out >> np.uint64(32))) | np.uint64(1)

    return _in_blocks(data, size, np.uint64, block)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``width`` neighbours."""

    def block(part: np.ndarray) -> np.ndarray:
        n, out, have = len(part) - width + 1, part, 1
        while have * 2 <= width:
            out = pick(out[:-have], out[have:])
            have *= 2
        return pick(out[:n], out[width - have:width - have + n])

    return _in_blocks(values, width, values.dtype, block)


class Anchors:
    """The anchors of one slice: their places, hashes and rows."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, length: int, gram: int):
        self.data, self.length, self.width = data, length, length - gram + 1
        self.at = np.zeros(0, np.int64)
        self.hash, self.least, self.row = np.zeros(0, np.uint64), np.zeros(0, np.uint64), self.at
        if len(data) < length:
            return
        hashes = _gram_hashes(data, gram)
        row = np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends))
        windows = len(data) - length + 1
        inside = row[:windows] == row[length - 1:]
        self.least = np.where(inside, _slide(hashes, self.width, np.minimum), np.uint64(0))
        edge = np.zeros(self.width - 1, np.uint64)
        chosen = _slide(np.concatenate((edge, self.least, edge)), self.width, np.maximum) == hashes
        self.at = np.flatnonzero(chosen)
        self.hash, self.row = hashes[self.at], row[self.at]

    @property
    def key(self) -> np.ndarray:
        """The hashes, spread evenly: a smallest hash is a small number."""
        return self.hash * np.uint64(_BASE)

    def pieces(self, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For the anchors in ``mask``: rows, first windows, numbers of
        windows and keys.  A window belongs to the first of its anchors."""
        at, hashes, row, keys = self.at[mask], self.hash[mask], self.row[mask], self.key[mask]
        order = np.argsort(hashes, kind="stable")
        before = np.full(len(at), -1)
        same = hashes[order][1:] == hashes[order][:-1]
        before[order[1:][same]] = at[order[:-1][same]]
        first, count = np.full(len(at), -1), np.zeros(len(at), np.int64)
        for back in range(self.width):  # from the anchor down to its first window
            start = at - back
            safe = np.clip(start, 0, len(self.least) - 1)
            own = (start > before) & (start >= 0) & (start < len(self.least)) & (self.least[safe] == hashes)
            first[own] = start[own]
            count += own
        held = count > 0
        return row[held], first[held], count[held], keys[held]

    def coded(self, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, pa.Array]:
        """Each piece's place among the distinct contents, and those.  Only
        CHUNK bytes of repeated contents are held at a time."""
        size = count + self.length - 1
        part = (np.cumsum(size) - size) // CHUNK
        cuts = np.flatnonzero(part[1:] != part[:-1]) + 1
        found = pa.chunked_array([binary_array(self.data[ragged(f, n)], n).dictionary_encode()
                                  for f, n in zip(np.split(first, cuts), np.split(size, cuts), strict=True)]).unify_dictionaries()
        return np.concatenate([c.indices.to_numpy() for c in found.chunks]), found.chunk(0).dictionary


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(_LAST).to_numpy()


def _range(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _low(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits below the shard's: what tells anchors of a shard apart."""
    return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


def _dealt(values: np.ndarray, shard: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Values by shard; both come sorted by shard."""
    cuts = np.flatnonzero(shard[1:] != shard[:-1]) + 1
    heads = shard[np.concatenate(([0], cuts))] if len(shard) else []
    yield from zip(np.asarray(heads).tolist(), np.split(values, cuts), strict=bool(len(shard)))


def _announce(documents: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """(shard, slice, once, more, many): anchors of one and of several
    documents of the slice, as sorted 32-bit blobs, and (anchor, places) of
    those with COUNTED places or more."""

    counted = COUNTED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in numbered_slices(batches, SLICE):
            found = Anchors(*text_bytes(part.column("text")), length, gram)
            hashes = found.key
            order = np.lexsort((found.row, hashes))
            hashes, row = hashes[order], found.row[order]
            new = np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)]
            start = np.flatnonzero(new)
            end = np.append(start[1:], len(hashes)) - 1
            several = row[start] != row[end] if len(start) else np.zeros(0, bool)
            places = end + 1 - start
            blobs: dict[int, list] = {}
            for i, mask in enumerate((~several, several, places >= counted)):
                own = hashes[start][mask]
                values = _low(own, bits)
                if i == 2:
                    values = np.stack([values, places[mask].astype(np.uint32)], axis=1)
                for shard, values in _dealt(values, _range(own, bits)) if len(own) else ():
                    blobs.setdefault(shard, [b"", b"", b""])[i] = values.astype("<u4").tobytes()
            rows = [(s, number, *b) for s, b in blobs.items()]
            yield _batch(rows, [("shard", pa.int64()), ("slice", pa.int64()), ("once", pa.binary()), ("more", pa.binary()), ("many", pa.binary())])
            give_back()

    # the columns of the later passes: Arrow batches, and so slices, end by the bytes of all columns
    return documents.select("doc_id", "text").mapInArrow(run, "shard long, slice long, once binary, more binary, many binary")


def _batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _u4(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u4")


def _repeated(places: int):
    """Of a shard: each slice's anchors that occur in several documents, and
    those of them with that many places or more."""

    def run(table: pa.Table) -> pa.Table:
        slices = table.column("slice").to_pylist()
        once, more = ([_u4(b) for b in table.column(c).to_pylist()] for c in ("once", "more"))
        every = np.concatenate([*once, *more])
        values, counts = np.unique(every, return_counts=True)
        wanted = np.union1d(values[counts > 1], np.concatenate(more))
        many = np.concatenate([_u4(b).reshape(-1, 2) for b in table.column("many").to_pylist()])
        index, counted = pd.factorize(many[:, 0])
        hot = counted[np.bincount(index, weights=many[:, 1], minlength=len(counted)) + counts[np.searchsorted(values, counted)] >= places]
        hot = np.union1d(hot, values[counts >= places])
        shard = table.column("shard")[0].as_py()
        rows = []
        for i, number in enumerate(slices):
            own = np.concatenate([once[i], more[i]])
            place = np.minimum(np.searchsorted(wanted, own), len(wanted) - 1)
            own = np.sort(own[wanted[place] == own]) if len(wanted) else own[:0]
            if len(own):
                rows.append((number, shard, *(x.astype("<u4").tobytes() for x in (own, own[np.isin(own, hot)]))))
        return pa.Table.from_batches([_batch(rows, [("slice", pa.int64()), ("shard", pa.int64()), ("anchors", pa.binary()), ("hot", pa.binary())])])

    return run


_ASKED = "slice long, shard long, anchors binary, hot binary"


def _wanted(anchors: Anchors, shards: list[int], blobs: list[bytes], bits: int) -> np.ndarray:
    """Mask of the slice's anchors that the shards asked for; all must be there."""
    keys = [np.left_shift(np.uint64(s), np.uint64(32)) | _u4(b).astype(np.uint64) for s, b in zip(shards, blobs, strict=True)]
    if not keys:
        return np.zeros(len(anchors.at), bool)
    keys = np.sort(np.concatenate(keys))
    if not len(keys):
        return np.zeros(len(anchors.at), bool)
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    own = (_range(anchors.key, bits).astype(np.uint64) << np.uint64(32)) | _low(anchors.key, bits)
    place = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
    mask = keys[place] == own
    met = np.zeros(len(keys), bool)
    met[place[mask]] = True
    if not met.all():
        raise ValueError(_CHANGED)
    return mask


def _pack(batch: pa.RecordBatch) -> bytes:
    """A batch as one compressed blob."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


class Cut:
    """The pieces of a slice at the anchors asked for, dealt to shards.

    A piece goes to its anchor's shard.  The windows of a hot anchor, one
    that would fill its shard, are pieces each and go by their own hash: equal
    windows still meet, for they have equal anchors.  The shards see distinct
    contents only; the places stay in the slice, which finds them again."""

    def __init__(self, part: pa.RecordBatch, wanted: pa.Table, length: int, gram: int, bits: int):
        data, ends = text_bytes(part.column("text"))
        self.anchors = found = Anchors(data, ends, length, gram)
        shards, blobs, hot = (wanted.column(c).to_pylist() for c in ("shard", "anchors", "hot"))
        row, first, count, keys = found.pieces(_wanted(found, shards, blobs, bits))
        if any(hot):
            every = np.concatenate([np.left_shift(np.uint64(s), np.uint64(32)) | _u4(b).astype(np.uint64) for s, b in zip(shards, hot, strict=True)])
            split = np.isin((_range(keys, bits).astype(np.uint64) << np.uint64(32)) | _low(keys, bits), every)
            n = np.where(split, count, 1)
            row, keys, first = np.repeat(row, n), np.repeat(keys, n), ragged(first, n)
            count, split = np.repeat(np.where(split, 1, count), n), np.repeat(split, n)
            keys[split] = _gram_hashes(data, length)[first[split]] * np.uint64(_BASE)
        self.order = np.argsort(keys, kind="stable")
        self.row, self.first, self.count, self.keys = row, first, count, keys
        self.ids, self.shard = _ids(part.column("doc_id"))[row], _range(keys[self.order], bits)

    def dealt(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, pa.Array]]:
        """Per shard: its pieces, their contents' places, the contents."""
        for shard, at in _dealt(self.order, self.shard):
            yield shard, at, *self.anchors.coded(self.first[at], self.count[at])


def _cut(slices: DataFrame, asked: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    """(shard, slice, pieces): blobs of the distinct pieces at the anchors
    asked for, with the smallest and the largest doc_id that they are in."""

    def run(key: tuple, own: pa.Table, wanted: pa.Table) -> pa.Table:
        give_back()
        number, rows = key[0].as_py(), []
        if wanted.num_rows and not own.num_rows:
            raise ValueError(_CHANGED)
        if wanted.num_rows:
            cut = Cut(_unpack(own.column("texts")[0].as_py()), wanted, length, gram, bits)
            for shard, at, index, content in cut.dealt():
                least, most = np.full(len(content), _LAST), np.full(len(content), np.iinfo(np.int64).min)
                np.minimum.at(least, index, cut.ids[at])
                np.maximum.at(most, index, cut.ids[at])
                hashes = np.zeros(len(content), np.uint64)
                hashes[index] = cut.keys[at]
                rows.append((shard, number, _pack(pa.RecordBatch.from_arrays(
                    [content, pa.array(hashes.view(np.int64)), pa.array(least), pa.array(most)], ["content", "hash", "least", "most"]))))
        return pa.Table.from_batches([_batch(rows, [("shard", pa.int64()), ("slice", pa.int64()), ("pieces", pa.binary())])])

    return slices.groupBy("slice").cogroup(asked.groupBy("slice")).applyInArrow(run, "shard long, slice long, pieces binary")


def _classes(length: int):
    """Of a shard's pieces: per slice, the runs of windows to remove from
    larger doc_ids as (content, first window, last window + 1, doc_id)."""

    def run(table: pa.Table) -> pa.Table:
        give_back()
        parts = [_unpack(b.as_py()) for b in table.column("pieces")]
        coded = pa.chunked_array([p.column("content") for p in parts]).dictionary_encode()
        index, content = np.concatenate([c.indices.to_numpy() for c in coded.chunks]), coded.chunk(0).dictionary
        hashes, ids, most = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("hash", "least", "most"))
        shard, numbers, held = table.column("shard")[0].as_py(), table.column("slice").to_pylist(), [p.num_rows for p in parts]
        del parts, coded
        least = np.full(len(content), _LAST)
        np.minimum.at(least, index, ids)
        anchor = np.zeros(len(content), np.int64)
        anchor[index] = hashes
        data, ends = text_bytes(content.cast(pa.large_binary()).view(pa.large_string()))
        sizes = np.diff(ends)
        windows = sizes - length + 1
        # a piece alone with its anchor has no other windows to meet
        mates = np.flatnonzero(pd.Series(anchor).duplicated(keep=False).to_numpy())
        start = np.cumsum(windows) - windows
        best = np.repeat(least, windows)
        if len(mates):
            best[ragged(start[mates], windows[mates])] = _least_of_class(
                data[ragged(ends[mates], sizes[mates])], sizes[mates], windows[mates], least[mates], length)
        new = np.append(True, best[1:] != best[:-1])
        new[start] = True
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(best))
        bounds = np.searchsorted(head, np.append(start, len(best)))  # each content's first run
        rows, lo = [], 0
        for number, n in zip(numbers, held, strict=True):
            of = index[lo:lo + n]
            each = bounds[of + 1] - bounds[of]
            at, runs = np.repeat(np.arange(n), each), ragged(bounds[of], each)
            keep = best[head[runs]] < most[lo:lo + n][at]
            at, runs, lo = at[keep], runs[keep], lo + n
            if len(at):
                base = start[of[at]]
                rows.append((number, shard, _pack(pa.RecordBatch.from_arrays(
                    [pa.array(at.astype(np.int32)), pa.array((head[runs] - base).astype(np.int32)), pa.array((tail[runs] - base).astype(np.int32)),
                     pa.array(best[head[runs]])], ["content", "first", "stop", "least"]))))
        return pa.Table.from_batches([_batch(rows, [("slice", pa.int64()), ("shard", pa.int64()), ("runs", pa.binary())])])

    return run


def _least_of_class(data: np.ndarray, sizes: np.ndarray, count: np.ndarray, least: np.ndarray, length: int) -> np.ndarray:
    """Window by window of the given pieces: the smallest ``least`` of the
    pieces that hold the window's bytes."""
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    text = np.ones(int((sizes + 1).sum()) + 1, np.int16)  # 1 parts the pieces
    text[ragged(starts, sizes)] = data.astype(np.int16) + 2
    text[-1] = 0
    windows = ragged(starts, count)
    owner = np.full(len(text), -1, np.int32)
    owner[windows] = np.repeat(np.arange(len(sizes)), count)
    order = np.concatenate([p[owner[p] >= 0] for p in suffix_order(text, 258, length)])
    new = np.append(True, ~_common_prefix(text, order, length))
    values = least[owner[order]]
    run = np.flatnonzero(new)
    best = np.repeat(np.minimum.reduceat(values, run), np.diff(np.append(run, len(order))))
    out = np.zeros(len(text), np.int64)
    out[order] = best
    return out[windows]


def _common_prefix(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Whether neighbours in the order share ``length`` symbols."""
    same = np.arange(len(order) - 1)
    # from the far end: neighbours differ late, if they do
    for at in range(length - 1, -1, -1):
        same = same[text[order[same] + at] == text[order[same + 1] + at]]
    out = np.zeros(len(order) - 1, bool)
    out[same] = True
    return out


_RESULT = "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary"


def _places(cut: Cut, answers: dict[int, bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First windows and last windows + 1 that the shards' answers remove."""
    for shard, at, index, content in cut.dealt():
        if shard not in answers:
            continue
        runs = _unpack(answers.pop(shard))
        of, first, stop, least = (runs.column(c).to_numpy() for c in ("content", "first", "stop", "least"))
        bounds = np.searchsorted(of, np.arange(len(content) + 1))
        each = bounds[index + 1] - bounds[index]
        piece, run = np.repeat(at, each), ragged(bounds[index], each)
        gone = least[run] < cut.ids[piece]
        piece, run = piece[gone], run[gone]
        yield cut.first[piece] + first[run], cut.first[piece] + stop[run]
    if answers:
        raise ValueError(_CHANGED)


def _remove(slices: DataFrame, asked: DataFrame, answers: DataFrame, length: int, gram: int, bits: int) -> DataFrame:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(key: tuple, own: pa.Table, known: pa.Table) -> pa.Table:
        give_back()
        if not own.num_rows:
            raise ValueError(_CHANGED)
        part = _unpack(own.column("texts")[0].as_py())
        data, ends = text_bytes(part.column("text"))
        cover = np.zeros(len(data) + 1, np.int32)
        told = known.filter(known.column("runs").is_valid())
        if told.num_rows:
            cut = Cut(part, known.filter(known.column("anchors").is_valid()), length, gram, bits)
            for first, stop in _places(cut, dict(zip(told.column("shard").to_pylist(), told.column("runs").to_pylist(), strict=True))):
                np.add.at(cover, first, 1)
                np.add.at(cover, stop + length - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        edge = np.diff(np.concatenate(([0], gone.view(np.int8), [0])))
        begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a run that goes on over a row's end is a run of each
        cuts = ends[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = np.unique(cuts[gone[cuts] & gone[cuts - 1]])
        begin, stop = np.sort(np.append(begin, cuts)), np.sort(np.append(stop, cuts))
        row = np.searchsorted(ends, begin, side="right") - 1
        spans = pa.StructArray.from_arrays([pa.array((begin - ends[row]).astype(np.int32)), pa.array((stop - ends[row]).astype(np.int32))], ["start", "end"])
        bounds = pa.array(np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32))
        left = np.concatenate(([0], np.cumsum(~gone)))
        kept = binary_array(data[~gone], left[ends[1:]] - left[ends[:-1]])
        return pa.table([part.column("doc_id"), pa.array(np.diff(ends)), pa.ListArray.from_arrays(bounds, spans), kept], schema=schema)

    known = answers.unionByName(asked, allowMissingColumns=True)
    return slices.groupBy("slice").cogroup(known.groupBy("slice")).applyInArrow(run, _RESULT)


def remove_repeats(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, ``n_bytes``, the removed ``spans`` (byte offsets, maximal) and
    the ``kept`` bytes of every document."""
    texts = documents.select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(0, int(size // SHARD).bit_length())

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, part in numbered_slices(batches, SLICE):
            yield _batch([(number, _pack(part))], [("slice", pa.int64()), ("texts", pa.binary())])

    slices = texts.mapInArrow(tag, "slice long, texts binary")
    # as many tasks as shards: the work is in the sorting, not in the bytes
    announced = _announce(texts, length, gram, bits).repartition(1 << bits, "shard")
    asked = stage(announced.groupBy("shard").applyInArrow(_repeated(HOT), _ASKED), "anchors")
    cut = _cut(slices, asked, length, gram, bits).repartition(1 << bits, "shard")
    answers = cut.groupBy("shard").applyInArrow(_classes(length), "slice long, shard long, runs binary")
    return _remove(slices, asked, answers, length, gram, bits)
