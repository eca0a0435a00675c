"""Removal of repeated 50-byte strings by suffix sorting in shards.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a
document with a smaller doc_id.  Strings are judged on the input and never
cross documents.

1. Documents are dealt to buckets of about 8 MB.  Every string (window) has an
   anchor: the K-byte gram in it with the least hash, the leftmost of equals.
   Equal windows have equal anchors, so only windows whose anchor occurs in two
   documents can repeat.  The distinct anchors of a bucket, with the smallest
   and the largest doc_id that has each, are shuffled by hash; a passage in
   every document comes once from each bucket.
2. Each bucket gets back a bitmap of those of its anchors that two documents
   share.
   Runs of windows with one shared anchor are pieces of text (at most
   2 * LENGTH - K bytes); equal pieces of a bucket go on once, with their
   smallest doc_id, to the shard that their anchor belongs to.  So equal
   windows are always in one shard.
3. A shard sorts the suffixes of its pieces by induced sorting
   (``induced_sort``), whose queues carry common-prefix values, about ``BATCH``
   bytes at a time; adjacent suffixes that share LENGTH bytes are one group, and
   each window of the group learns the group's smallest doc_id.  An anchor with
   more bytes than a batch is split by anchors of ever more bytes (see
   ``_settle``).  A shard of more than ``RAM`` bytes waits on disk and is dealt
   out by anchors there; in memory are then a block, a batch, and an index of
   the blocks on disk, which still grows with the shard.
4. These go back to the document buckets, where covered bytes are removed.

All four shuffles carry compressed blocks.  The number of buckets of documents
grows with the bytes of the input; that of buckets of anchors and of shards only
up to ``MOST_KEY_BUCKETS``, so that blocks stay worth their row: beyond that, a
bucket of anchors is read as a stream and dealt out on disk by hash, ``ASKED``
anchors at a time, and shards grow.  The documents' texts are shuffled
compressed, by a hash of doc_id and text, so that many rows with one doc_id go
to many buckets.

Defined cases: null text is empty; nothing is removed from texts shorter than
LENGTH; rows with the same doc_id do not affect one another; rows without
doc_id neither lose bytes nor make others lose any.  Repeated rows give a row
each.  Extra columns are not read: the result has doc_id and ``fields``.
"""

from __future__ import annotations

import hashlib
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .blocks import Spool, buckets, key_buckets, squeeze, unsqueeze
from .common import doc_text, table
from .induced_sort import RAM, InducedSort

LENGTH = 50
K = 19
ASKED = 4_000_000  # anchors of a bucket held in memory
_RANGES = 64  # of hashes that more are dealt to
_PIECE = 1 << 20
BATCH = 1 << 20  # bytes of pieces sorted at a time
_TABLE = 1 << 16  # bytes of different windows for which no further part is made
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _factors(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.concatenate((np.ones(1, dtype=np.uint64), np.full(size, x, dtype=np.uint64)))) for x in (_ODD, _INVERSE)]
    return _powers[0], _powers[1]


def _gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """48-bit hashes of all k-byte grams."""
    n = len(x)
    up, down = _factors(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((x.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
    h = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h >> np.uint64(16)


def anchors(text: bytes, length: int = LENGTH, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """For each run of windows with one anchor: the anchor's hash and the first window; the last entry ends the runs."""
    whole = np.frombuffer(text, dtype=np.uint8)
    last = len(whole) - length + 1  # windows
    if last < 1:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    hashes, starts = [], []
    before = -1
    for s in range(0, last, _PIECE):
        n = min(_PIECE, last - s)
        h = _gram_hashes(whole[s : s + n + length - 1], k)
        at = np.arange(len(h), dtype=np.int32)
        value, span, width = h, 1, length - k + 1
        while span < width:
            step = min(span, width - span)
            keep = value[:-step] <= value[step:]
            at = np.where(keep, at[:-step], at[step:])
            value = np.where(keep, value[:-step], value[step:])
            span += step
        new = np.flatnonzero(np.concatenate(([at[0] + s != before], at[1:] != at[:-1])))
        before = int(at[-1]) + s
        hashes.append(value[new])
        starts.append(new + s)
    return np.concatenate(hashes), np.concatenate([*starts, [last]])


def _own_anchors(rows: list[tuple[int | None, bytes]], length: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct anchors of a bucket's documents, in order, with the smallest and largest doc_id of each."""
    unzip = zstandard.ZstdDecompressor().decompress
    hashes, docs = [np.zeros(0, np.uint64)], []
    for doc, packed in rows:
        got = anchors(unzip(packed), length, k)[0] if doc is not None else hashes[0][:0]
        hashes.append(got)
        docs.append(np.full(len(got), doc or 0, dtype=np.int64))
    h, d = np.concatenate(hashes), np.concatenate([*docs, np.zeros(0, np.int64)])
    order = np.argsort(h, kind="stable")
    h, d = h[order], d[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.zeros(0, np.int64)
    if not len(h):
        return h, d, d
    return h[first], np.minimum.reduceat(d, first), np.maximum.reduceat(d, first)


def _by_bucket(h: np.ndarray, n: int) -> list[np.ndarray]:
    """The places of hashes by the bucket they belong to; a bucket's stay in order."""
    of = h % np.uint64(n)
    order = np.argsort(of, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(of[order])) + 1) if len(h) else []


def _ask(n_keys: int, length: int, k: int):
    """A bucket's distinct anchors, a block for each bucket of anchors."""

    def run(key: tuple[pa.Scalar, ...], texts: pa.Table) -> pa.Table:
        h, low, high = _own_anchors(_in_order(texts), length, k)
        places, blocks = [], []
        for own in _by_bucket(h, n_keys):
            a, b = low[own].view(np.uint64), high[own].view(np.uint64)
            places.append(int(h[own[0]]) % n_keys)
            blocks.append(squeeze(np.diff(h[own], prepend=np.uint64(0)), a, b - a, level=1))
        return pa.table({"asked": pa.array(places, pa.int64()), "bucket": pa.array([key[0].as_py()] * len(places), pa.int64()), "block": pa.array(blocks, pa.binary())})

    return run


def _shared(h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which entries have a hash that two documents share."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    both = np.minimum.reduceat(low[order], first) < np.maximum.reduceat(high[order], first)
    out = np.empty(len(h), dtype=bool)
    out[order] = np.repeat(both, np.diff(np.concatenate((first, [len(h)]))))
    return out


def _answer(most: int):
    """A bucket of anchors: to each bucket of documents a bitmap of its anchors that are shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[tuple[int, int, int]] = []  # bucket of anchors, of documents, entries
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        spool = Spool(32 << 20)
        ranges: list[list[int]] = [[] for _ in range(_RANGES)]
        size = done = 0

        def deal() -> None:
            """To ranges of hashes, with the entries' numbers."""
            nonlocal size, done
            h, low, high = (np.concatenate(x) for x in zip(*held))
            at = np.arange(done, done + len(h), dtype=np.uint64)
            for own in _by_bucket(_mixed(h), _RANGES):
                part = int(_mixed(h[own[:1]])[0]) % _RANGES
                ranges[part].append(spool.add(squeeze(h[own], low[own].view(np.uint64), high[own].view(np.uint64), at[own], level=1)))
            done += len(h)
            held.clear()
            size = 0

        for b in batches:
            for asked, bucket, block in zip(b["asked"].to_pylist(), b["bucket"].to_pylist(), b["block"].to_pylist()):
                steps, low, more = unsqueeze(block)[0]
                heads.append((asked, bucket, len(steps)))
                held.append((np.cumsum(steps, dtype=np.uint64), low.view(np.int64), (low + more).view(np.int64)))
                size += len(steps)
                if size >= most:
                    deal()
        if not heads:
            return
        if not done:
            shared = _shared(*(np.concatenate(x) for x in zip(*held)))
        else:
            if held:
                deal()
            shared = np.zeros(done, dtype=bool)
            for part in ranges:
                if part:
                    h, low, high, at = (np.concatenate(x) for x in zip(*(unsqueeze(spool.get(i))[0] for i in part)))
                    shared[at.astype(np.int64)] = _shared(h, low.view(np.int64), high.view(np.int64))
        start = 0
        for asked, bucket, n in heads:
            bits = np.packbits(shared[start : start + n]).tobytes()
            start += n
            yield pa.RecordBatch.from_arrays([pa.array([asked], pa.int64()), pa.array([bucket], pa.int64()), pa.array([bits], pa.binary())], ["asked", "bucket", "block"])

    return run


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(_ODD)
    return x ^ (x >> np.uint64(32))


def _in_order(texts: pa.Table) -> list[tuple[int | None, bytes]]:
    """doc_id and compressed text of a bucket's rows, in an order that does not depend on arrival."""
    rows = zip(texts["doc_id"].to_pylist(), texts["text"].to_pylist())
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def _pieces(texts: pa.Table, notes: list[tuple[int, bytes]], bucket: int, n_keys: int, length: int, k: int) -> pa.Table:
    """The pieces of a bucket by shard, and under a negative shard where its documents have them."""
    rows = _in_order(texts)
    unzip = zstandard.ZstdDecompressor().decompress
    cuts = [anchors(unzip(packed), length, k) if doc is not None else None for doc, packed in rows]
    known = np.unique(np.concatenate([np.zeros(0, np.uint64), *(c[0] for c in cuts if c)]))
    bits = dict(notes)
    parts = [own[np.unpackbits(np.frombuffer(bits[int(known[own[0]]) % n_keys], dtype=np.uint8), count=len(own)).astype(bool)] for own in _by_bucket(known, n_keys)]
    known = known[np.sort(np.concatenate([*parts, np.zeros(0, np.int64)]))]
    number: dict[bytes, int] = {}
    low: list[int] = []
    gram_of: list[int] = []
    counts: list[int] = []
    numbers: list[int] = []
    places: list[np.ndarray] = []
    widths: list[np.ndarray] = []
    for (doc, packed), cut in zip(rows, cuts):
        if cut is None or not len(known):
            counts.append(0)
            continue
        hashes, starts = cut
        hit = np.flatnonzero(known[np.minimum(np.searchsorted(known, hashes), len(known) - 1)] == hashes)
        if not len(hit):
            counts.append(0)
            continue
        text = unzip(packed)
        at, sizes = starts[hit], starts[hit + 1] - starts[hit]
        counts.append(len(hit))
        places.append(at.astype(np.uint32))
        widths.append(sizes.astype(np.uint32))
        for s, n, gram in zip(at.tolist(), sizes.tolist(), hashes[hit].tolist()):
            piece = text[s : s + n + length - 1]
            i = number.get(piece)
            if i is None:
                i = number[piece] = len(low)
                low.append(doc)
                gram_of.append(gram)
            elif doc < low[i]:
                low[i] = doc
            numbers.append(i)
    pieces = list(number)
    del number
    grams = np.array(gram_of, dtype=np.uint64)
    shard = grams % np.uint64(n_keys)
    order = np.lexsort((grams, shard))  # the dictionary's order, which the rows' order fixes, settles ties
    place = np.empty(len(pieces), dtype=np.uint32)
    place[order] = np.arange(len(pieces), dtype=np.uint32)
    grams, shard, lows = grams[order], shard[order], np.array(low, dtype=np.int64)[order]
    blocks, shards = [], []
    first = np.flatnonzero(np.diff(shard, prepend=np.uint64(n_keys))).tolist()
    for start, stop in zip(first, [*first[1:], len(order)]):
        part = [pieces[i] for i in order[start:stop].tolist()]
        sizes = np.array([len(p) for p in part], dtype=np.uint32)
        blocks.append(squeeze(sizes, lows[start:stop].view(np.uint64), np.diff(grams[start:stop], prepend=np.uint64(0)), tail=b"".join(part)))
        shards.append(int(shard[start]))
    none = [np.zeros(0, np.uint32)]
    blocks.append(squeeze(np.array(counts, dtype=np.uint32), place[np.array(numbers, dtype=np.int64)], np.concatenate(places or none), np.concatenate(widths or none)))
    shards.append(-1 - bucket)
    return pa.table({"shard": pa.array(shards, pa.int64()), "bucket": pa.array([bucket] * len(shards), pa.int64()), "block": pa.array(blocks, pa.binary())})


def _removed(texts: pa.Table, letters: list[tuple[int, bytes]], length: int) -> Iterator[tuple[int | None, bytes, np.ndarray]]:
    """doc_id, text, and the bounds of the removed runs of each document of a bucket."""
    unzip = zstandard.ZstdDecompressor().decompress
    rows = _in_order(texts)
    none = np.zeros((0, 2), dtype=np.int64)
    own = [b for s, b in letters if s < 0]
    if not own:
        for doc, packed in rows:
            yield doc, unzip(packed), none
        return
    counts, numbers, places, widths = (x.astype(np.int64) for x in unsqueeze(own[0])[0])
    least = np.concatenate([unsqueeze(b)[0][0] for s, b in sorted(letters) if s >= 0] or [np.zeros(0, np.uint64)]).view(np.int64)
    windows = np.zeros(int(numbers.max()) + 1 if len(numbers) else 0, dtype=np.int64)
    windows[numbers] = widths
    first = np.concatenate(([0], np.cumsum(windows)))
    if first[-1] != len(least) or len(counts) != len(rows):
        raise RuntimeError("a shard's answer or a document is missing")
    ends = np.cumsum(counts)
    for (doc, packed), a, z in zip(rows, (ends - counts).tolist(), ends.tolist()):
        bounds = none
        if z > a:
            sizes = widths[a:z]
            step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            lower = least[np.repeat(first[numbers[a:z]], sizes) + step] < doc
            gone = (np.repeat(places[a:z], sizes) + step)[lower]
            if len(gone):
                new = np.flatnonzero(np.concatenate(([True], gone[1:] > gone[:-1] + length)))
                bounds = np.stack((gone[new], gone[np.concatenate((new[1:] - 1, [len(gone) - 1]))] + length), axis=1)
        yield doc, unzip(packed), bounds


def _spots(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each of the runs of the given sizes."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def shard_minima(blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]], length: int = LENGTH, ram: int = RAM, batch: int = BATCH, k: int = K) -> list[np.ndarray]:
    """For each block of (sizes, doc_ids, anchors, joined pieces): the smallest doc_id with each window, in order.

    Equal windows have one anchor.  Where all pieces of an anchor have the same
    smallest doc_id, it is that of all their windows.  The pieces of the others
    are sorted, whole anchors together, about ``batch`` bytes at a time; an
    anchor with more is split.  All blocks are in memory here.
    """
    sizes = np.concatenate([s for s, _, _, _ in blocks]).astype(np.int64)
    docs = np.concatenate([d for _, d, _, _ in blocks])
    data = b"".join(d for _, _, _, d in blocks)
    _, group = np.unique(np.concatenate([g for _, _, g, _ in blocks]), return_inverse=True)
    groups = int(group.max()) + 1
    low, high = np.full(groups, np.iinfo(np.int64).max), np.full(groups, np.iinfo(np.int64).min)
    np.minimum.at(low, group, docs)
    np.maximum.at(high, group, docs)
    windows = sizes - length + 1
    answer = np.repeat(low[group], windows)
    mixed = low < high
    weight = np.where(mixed, np.bincount(group, weights=sizes, minlength=groups), 0)
    number = (np.cumsum(weight) - weight) // batch
    todo = np.flatnonzero(mixed[group])
    part = number[group[todo]]
    order = np.argsort(part, kind="stable")
    todo, part = todo[order], part[order]
    bounds = np.flatnonzero(np.diff(part, prepend=-1.0)).tolist()
    begin, first = np.cumsum(sizes) - sizes, np.cumsum(windows) - windows

    def put(at: np.ndarray, n: np.ndarray, least: np.ndarray) -> None:
        answer[_spots(at, n)] = least

    hot = weight > batch
    for a, z in zip(bounds, [*bounds[1:], len(todo)]):
        own = todo[a:z]
        for g in np.unique(group[own][hot[group[own]]]).tolist():
            held = _Part()
            spool = Spool(ram // 8)
            mine = own[group[own] == g]
            for some in _runs(mine, sizes[mine], batch):
                held.add(spool, sizes[some], docs[some], first[some], b"".join([data[i : i + n] for i, n in zip(begin[some].tolist(), sizes[some].tolist())]))
            _settle(spool, held, length, min(k, length - 1), ram, batch, put)
        own = own[~hot[group[own]]]
        if not len(own):
            continue
        pieces = [data[i : i + n] for i, n in zip(begin[own].tolist(), sizes[own].tolist())]
        answer[_spots(first[own], windows[own])] = sorted_minima(pieces, docs[own], length, ram)
    ends = np.cumsum([int(s.sum()) - (length - 1) * len(s) for s, _, _, _ in blocks])
    return np.split(answer, ends[:-1])


class _Part:
    """Pieces of one part of a shard, as blocks of (sizes, doc_ids, places of the answers, joined pieces) in a spool."""

    def __init__(self):
        self.blocks: list[int] = []
        self.size = 0

    def add(self, spool: Spool, sizes: np.ndarray, docs: np.ndarray, places: np.ndarray, data: bytes) -> None:
        self.blocks.append(spool.add(squeeze(sizes.astype(np.uint32), docs.view(np.uint64), places.astype(np.uint64), tail=data, level=1)))
        self.size += len(data)

    def read(self, spool: Spool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bytes]]:
        for i in self.blocks:
            (sizes, docs, places), data = unsqueeze(spool.get(i))
            yield sizes.astype(np.int64), docs.view(np.int64), places.view(np.int64), data


def _runs(items: np.ndarray, sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """``items`` in order, in runs of about ``most`` bytes."""
    turn = (np.cumsum(sizes) - sizes) // most
    return np.split(items, np.flatnonzero(np.diff(turn)) + 1)


def _deal(spool: Spool, parts: list[_Part], level: int, hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray, docs: np.ndarray, places: np.ndarray, data: bytes) -> None:
    """Add pieces (bytes ``first`` to ``first + sizes`` of ``data``) to the parts that their hashes choose."""
    mixed = (hashes + np.uint64(level + 1)) * np.uint64(_ODD)  # another choice at each level
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    part = (mixed >> np.uint64(32)) % np.uint64(len(parts))
    order = np.argsort(part, kind="stable")
    for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else []:
        joined = b"".join([data[i : i + n] for i, n in zip(first[own].tolist(), sizes[own].tolist())])
        parts[int(part[own[0]])].add(spool, sizes[own], docs[own], places[own], joined)


def _settle(spool: Spool, held: _Part, length: int, k: int, ram: int, batch: int, put, level: int = 0) -> None:
    """Give ``put`` the minima of a part's windows, holding a block and a batch of them at a time.

    A part of at most ``batch`` bytes is sorted.  A larger one is cut again by
    anchors of more bytes: for each window the gram with the least hash, of a
    length half-way from ``k`` to ``length``.  Equal windows have equal anchors
    of any length, so they meet in one of the new parts.  In the end the grams
    are whole windows; a table of the different ones is then enough.
    """
    if held.size <= batch:
        got = list(held.read(spool))
        if not got:
            return
        sizes, docs, places = (np.concatenate(x) for x in list(zip(*got))[:3])
        windows = sizes - length + 1
        if docs.min() == docs.max():
            put(places, windows, np.repeat(docs, windows))
            return
        data = b"".join(x[3] for x in got)
        begin = np.cumsum(sizes) - sizes
        put(places, windows, sorted_minima([data[i : i + n] for i, n in zip(begin.tolist(), sizes.tolist())], docs, length, max(ram, 32 * held.size)))
        return
    if k >= length:  # each piece is a window
        least: dict[bytes, int] = {}
        for sizes, docs, _, data in held.read(spool):
            for i, doc in zip(range(0, len(data), length), docs.tolist()):
                w = data[i : i + length]
                if doc < least.get(w, doc + 1):
                    least[w] = doc
            if len(least) * length > max(batch, _TABLE):
                break
        else:
            for sizes, _, places, data in held.read(spool):
                put(places, np.ones(len(places), dtype=np.int64), np.array([least[data[i : i + length]] for i in range(0, len(data), length)], dtype=np.int64))
            return
        del least
    k = min(length, k + max(1, (length - k + 1) // 2))
    inner = Spool(ram // 8)
    parts = [_Part() for _ in range(int(min(128, max(32, 2 * held.size // batch))))]
    for sizes, docs, places, data in held.read(spool):
        hashes, starts = anchors(data, length, k)
        windows = sizes - length + 1
        of = np.repeat(hashes, np.diff(starts))[_spots(np.cumsum(sizes) - sizes, windows)]  # each window's anchor
        piece = np.repeat(np.arange(len(sizes)), windows)
        cut = np.concatenate(([True], (piece[1:] != piece[:-1]) | (of[1:] != of[:-1]) | (k >= length)))
        new = np.flatnonzero(cut)
        n = np.diff(np.concatenate((new, [len(of)])))
        own = piece[new]
        inside = new - (np.cumsum(windows) - windows)[own]
        _deal(inner, parts, level, of[new], (np.cumsum(sizes) - sizes)[own] + inside, n + length - 1, docs[own], places[own] + inside, data)
    for p in parts:
        _settle(inner, p, length, k, ram, batch, put, level + 1)


class _Answers:
    """Minima that come in any order, given back a block at a time; they wait in a spool, by ranges of blocks."""

    def __init__(self, windows: list[int], ram: int):
        self.room = max(1, ram // 64)
        self.windows = np.array(windows, dtype=np.int64)
        starts = np.cumsum(self.windows) - self.windows
        self.first = np.flatnonzero(np.diff(starts // self.room, prepend=-1))
        self.low = starts[self.first]
        self.ranges: list[list[int]] = [[] for _ in self.first]
        self.spool = Spool(ram // 8)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def put(self, at: np.ndarray, n: np.ndarray, least: np.ndarray) -> None:
        self.held.append((at, n, least))
        self.size += len(least)
        if self.size >= self.room:
            self._flush()

    def _flush(self) -> None:
        if not self.held:
            return
        at, n, least = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        of = np.searchsorted(self.low, at, "right") - 1
        order = np.argsort(of, kind="stable")
        first = np.cumsum(n) - n
        for own in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
            block = squeeze(at[own].astype(np.uint64), n[own].astype(np.uint64), least[_spots(first[own], n[own])].view(np.uint64), level=1)
            self.ranges[int(of[own[0]])].append(self.spool.add(block))

    def read(self) -> Iterator[np.ndarray]:
        self._flush()
        for r, (a, z) in enumerate(zip(self.first.tolist(), [*self.first[1:].tolist(), len(self.windows)])):
            ends = np.cumsum(self.windows[a:z])
            out, told = np.zeros(int(ends[-1]), dtype=np.int64), 0
            for i in self.ranges[r]:
                at, n, least = (x.view(np.int64) for x in unsqueeze(self.spool.get(i))[0])
                out[_spots(at - self.low[r], n)] = least
                told += len(least)
            if told != len(out):
                raise RuntimeError("a window has no answer")
            yield from np.split(out, ends[:-1])


def spooled_minima(spool: Spool, sizes: list[tuple[int, int]], length: int = LENGTH, ram: int = RAM, batch: int = BATCH, k: int = K) -> Iterator[np.ndarray]:
    """As ``shard_minima``, for spooled blocks with these numbers of (bytes, windows), a block at a time.

    Pieces and answers wait on disk; one block and one batch are in memory.
    """
    answers = _Answers([w for _, w in sizes], ram)
    inner = Spool(ram // 8)
    parts = [_Part() for _ in range(int(min(128, max(2, 2 * sum(n for n, _ in sizes) // batch))))]
    place = 0
    for i in range(len(spool)):
        (n, docs, grams), data = unsqueeze(spool.get(i))
        n, hashes = n.astype(np.int64), np.cumsum(grams, dtype=np.uint64)
        first, windows = np.cumsum(n) - n, n - length + 1
        places = place + np.cumsum(windows) - windows
        place += int(windows.sum())
        for some in _runs(np.arange(len(n)), n, batch):
            _deal(inner, parts, -1, hashes[some], first[some], n[some], docs.view(np.int64)[some], places[some], data)
    for p in parts:
        _settle(inner, p, length, min(k, length - 1), ram, batch, answers.put)
    return answers.read()


def sorted_minima(pieces: list[bytes], docs: np.ndarray, length: int = LENGTH, ram: int = RAM) -> np.ndarray:
    """The smallest doc_id with each window of the pieces, by sorting all their suffixes."""
    where = None
    if sum(map(len, pieces)) <= ram:  # equal pieces are sorted once where a table of them fits in memory
        unique: dict[bytes, int] = {}
        where = np.array([unique.setdefault(p, len(unique)) for p in pieces], dtype=np.int64)
        low = np.full(len(unique), np.iinfo(np.int64).max)
        np.minimum.at(low, where, docs)
        pieces, docs = list(unique), low
    sizes = np.array([len(p) for p in pieces], dtype=np.int64)
    windows = sizes - length + 1
    n = int(sizes.sum()) + len(sizes) + 1
    text, owner, valid = (_scratch(n, kind, ram) for kind in (np.uint16, np.int64, np.bool_))
    begin = np.cumsum(sizes + 1) - sizes - 1
    text[:] = 1
    text[n - 1] = 0
    text[_spots(begin, sizes)] = np.frombuffer(b"".join(pieces), dtype=np.uint8).astype(np.uint16) + 2
    spots = _spots(begin, windows)
    valid[spots] = True
    owner[spots] = np.repeat(docs, windows)
    least = owner  # overwritten in place, a group at a time, once the group has been read
    group: list[np.ndarray] = []
    smallest = None
    common = length
    for pos, lcp in InducedSort(text, length, ram).suffixes():
        ok = np.flatnonzero(valid[pos])
        if not len(ok):
            common = min(common, int(lcp.min()))
            continue
        low_since = np.minimum.reduceat(lcp[: ok[-1] + 1], np.concatenate(([0], ok[:-1] + 1)))
        low_since[0] = min(int(low_since[0]), common)
        common = int(lcp[ok[-1] + 1 :].min()) if ok[-1] + 1 < len(lcp) else length
        at = np.asarray(pos)[ok]
        own = owner[at]
        new = np.flatnonzero(low_since < length)
        head = int(new[0]) if len(new) else len(at)
        if head:
            group.append(at[:head])
            smallest = int(own[:head].min()) if smallest is None else min(smallest, int(own[:head].min()))
        if len(new):
            for g in group:
                least[g] = smallest
            last = int(new[-1])
            if last > head:
                least[at[head:last]] = np.repeat(np.minimum.reduceat(own[:last], new[:-1]), np.diff(new))
            group = [at[last:]]
            smallest = int(own[last:].min())
    for g in group:
        least[g] = smallest
    flat = np.array(least[spots])
    if where is None:
        return flat
    first = np.cumsum(windows) - windows
    return flat[_spots(first[where], windows[where])]


def _scratch(n: int, kind, ram: int) -> np.ndarray:
    """Zeros in memory, or on an unlinked scratch file of the task where they are large."""
    if n * np.dtype(kind).itemsize <= 4 * ram:
        return np.zeros(n, dtype=kind)
    return np.memmap(tempfile.TemporaryFile(), dtype=kind, shape=(n,), mode="w+")


def _sort_shard(length: int, k: int, ram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spool = Spool(ram)
        heads: list[tuple[int, int]] = []
        sizes: list[tuple[int, int]] = []
        for b in batches:
            if b.num_rows and b["shard"][0].as_py() < 0:  # a bucket's places, on their way back to it
                yield b.select(["bucket", "shard", "block"])
                continue
            for bucket, shard, block in zip(b["bucket"], b["shard"], b["block"]):
                block = block.as_py()
                n = unsqueeze(block)[0][0]
                heads.append((bucket.as_py(), shard.as_py()))
                sizes.append((int(n.sum()), int(n.sum()) - (length - 1) * len(n)))
                spool.add(block)
        if not heads:
            return
        if sum(n for n, _ in sizes) <= ram:
            blocks = [unsqueeze(spool.get(i)) for i in range(len(spool))]
            got = iter(shard_minima([(n, docs.view(np.int64), np.cumsum(grams, dtype=np.uint64), data) for (n, docs, grams), data in blocks], length, ram, k=k))
        else:
            got = spooled_minima(spool, sizes, length, ram, min(BATCH, ram), k)
        for (bucket, shard), least in zip(heads, got):
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([shard], pa.int64()), pa.array([squeeze(least.view(np.uint64))], pa.binary())], ["bucket", "shard", "block"])

    return run


def _packed(docs: DataFrame, n_buckets: int) -> DataFrame:
    """(bucket, doc_id, text): compressed texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zipper = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = [t.as_py() or b"" for t in b["text"]]
            of = np.array([zlib.crc32(t) for t in texts], dtype=np.uint64) ^ _mixed(b["doc_id"].fill_null(0).to_numpy(zero_copy_only=False).view(np.uint64))
            bucket = _mixed(of) % np.uint64(n_buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), b["doc_id"], pa.array([zipper.compress(t) for t in texts], pa.binary())], ["bucket", "doc_id", "text"])

    return doc_text(docs).mapInArrow(run, "bucket long, doc_id long, text binary")


def dedup(docs: DataFrame, length: int = LENGTH, k: int = K, finish=None, fields: str = "text binary", ram: int = RAM) -> DataFrame:
    """doc_id and ``fields`` of each row; by default its remaining bytes.

    ``finish`` maps (text, bounds of the removed runs) to the fields' values.
    """
    n = buckets(docs)
    n_keys = key_buckets(n)
    texts = _packed(docs, n)
    asked = texts.groupBy("bucket").applyInArrow(_ask(n_keys, length, k), "asked long, bucket long, block binary")
    notes = asked.groupBy("asked").applyInArrow(_answer(ASKED), "asked long, bucket long, block binary")

    def cut_pieces(key, texts: pa.Table, notes: pa.Table) -> pa.Table:
        if not texts.num_rows or not notes.num_rows:
            return pa.table({"shard": pa.array([], pa.int64()), "bucket": pa.array([], pa.int64()), "block": pa.array([], pa.binary())})
        return _pieces(texts, list(zip(notes["asked"].to_pylist(), notes["block"].to_pylist())), key[0].as_py(), n_keys, length, k)

    pieces = texts.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(cut_pieces, "shard long, bucket long, block binary")
    minima = pieces.groupBy("shard").applyInArrow(_sort_shard(length, k, ram), "bucket long, shard long, block binary")
    finish = finish or (lambda text, bounds: (kept_bytes(text, bounds),))
    names = [x.split()[0] for x in fields.split(",")]
    kinds = {"binary": pa.binary(), "bigint": pa.int64(), "long": pa.int64(), "string": pa.string()}
    kinds = [kinds[x.split()[1]] for x in fields.split(",")]

    def apply(key, texts: pa.Table, letters: pa.Table) -> pa.Table:
        rows, ids = [], []
        if texts.num_rows:
            found = list(zip(letters["shard"].to_pylist(), letters["block"].to_pylist()))
            for doc, text, bounds in _removed(texts, found, length):
                ids.append(doc)
                rows.append(finish(text, bounds))
        columns = list(zip(*rows)) or [()] * len(names)
        return pa.Table.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(columns, kinds))], names=["doc_id", *names])

    again = texts.select(F.col("bucket").alias("bucket"), "doc_id", "text")
    return again.groupBy("bucket").cogroup(minima.groupBy("bucket")).applyInArrow(apply, f"doc_id long, {fields}")


def kept_bytes(text: bytes, bounds: np.ndarray) -> bytes:
    out, at = [], 0
    for a, z in bounds.tolist():
        out.append(text[at:a])
        at = z
    return b"".join([*out, text[at:]])


def _digest(text: bytes, bounds: np.ndarray) -> tuple[int, int, int, str]:
    return len(text), int((bounds[:, 1] - bounds[:, 0]).sum()), len(bounds), hashlib.sha256(kept_bytes(text, bounds)).hexdigest()


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs, finish=_digest, fields="n_bytes long, n_removed long, n_spans long, kept_sha256 string")
