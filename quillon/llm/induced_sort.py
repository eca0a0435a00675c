"""Suffix sorting by external induced sorting with common-prefix values.

Suffixes are classed as smaller (S) or larger (L) than their right neighbour.
The leftmost S-suffixes are sorted by recursion over names of their substrings;
the recursion ends in memory once the reduced text fits ``ram``.  From them
first all L-suffixes and then all S-suffixes are induced: a scan in sorted
order inserts each scanned suffix's left neighbour into a priority queue whose
keys are (first symbol, order of insertion).  Queues and outputs spill to an
unlinked scratch file of the task when they exceed ``ram``, and are read back
in sequence.  The arrays by position (types, run ends, names) stay in memory:
a caller bounds the text's length.

Each queue entry carries the length of the prefix that it shares with the
entry before it, induced from the minimum over the scan between their right
neighbours.  Values are exact below ``cap`` and at least ``cap`` above it, and
suffixes that share ``cap`` symbols may come in any order.
"""

from __future__ import annotations

import tempfile
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np

RAM = 64 << 20
_BLOCK = 1 << 16
_FAR = np.int32(1 << 20)


class Queues:
    """A first-in-first-out queue of (position, common prefix) blocks for each symbol."""

    def __init__(self, ram: int):
        self.ram, self.held = ram, 0
        self.blocks: dict[int, list] = defaultdict(list)
        self.loose: list[tuple[int, int]] = []  # where blocks in memory are
        self.file = None
        self.end = 0

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.loose.append((symbol, len(self.blocks[symbol])))
        self.blocks[symbol].append((pos, lcp))
        self.held += 12 * len(pos)
        if self.held > self.ram:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        for symbol, i in self.loose:
            blocks = self.blocks.get(symbol)
            if blocks and i < len(blocks) and len(blocks[i]) == 2:
                pos, lcp = blocks[i]
                self.file.seek(self.end)
                self.file.write(pos.astype(np.int64).tobytes() + lcp.astype(np.int32).tobytes())
                blocks[i] = (self.end, len(pos), None)
                self.end += 12 * len(pos)
        self.loose.clear()
        self.held = 0

    def _load(self, b: tuple) -> tuple[np.ndarray, np.ndarray]:
        if len(b) == 2:
            return b
        at, n, _ = b
        self.file.seek(at)
        data = self.file.read(12 * n)
        return np.frombuffer(data, dtype=np.int64, count=n), np.frombuffer(data, dtype=np.int32, offset=8 * n)

    def drain(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbol's entries, those that come in meanwhile included."""
        done = 0
        while done < len(self.blocks.get(symbol, ())):
            # Small blocks are joined: one scan step for all that is there.
            blocks = self.blocks[symbol]
            stop, size = done, 0
            while stop < len(blocks) and (stop == done or size < _BLOCK):
                size += len(blocks[stop][0]) if len(blocks[stop]) == 2 else blocks[stop][1]
                stop += 1
            got = [self._load(b) for b in blocks[done:stop]]
            self.held -= sum(12 * len(b[0]) for b in blocks[done:stop] if len(b) == 2)
            for i in range(done, stop):
                blocks[i] = (0, 0, None)
            done = stop
            pos, lcp = (np.concatenate(x) for x in zip(*got)) if len(got) > 1 else got[0]
            for i in range(0, len(pos), _BLOCK):
                yield pos[i : i + _BLOCK], lcp[i : i + _BLOCK]
        self.blocks.pop(symbol, None)

    def backwards(self, symbol: int, keep: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The symbol's blocks, last first, each in its own order."""
        for b in reversed(self.blocks.get(symbol, [])):
            yield self._load(b)
        if not keep:
            self.blocks.pop(symbol, None)

    def forwards(self, symbol: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for b in self.blocks.get(symbol, []):
            yield self._load(b)


class _Minima:
    """Minimum of the scanned common prefixes since the last insertion of each symbol."""

    def __init__(self):
        self.last: dict[int, tuple[int, int]] = {}  # symbol: block number, minimum after the insertion in it
        self.at: list[int] = []
        self.low: list[int] = []

    def add(self, block: int, low: int) -> None:
        while self.low and self.low[-1] >= low:
            self.low.pop()
            self.at.pop()
        self.low.append(low)
        self.at.append(block)

    def since(self, symbol: int) -> int | None:
        got = self.last.get(symbol)
        if got is None:
            return None
        i = bisect_left(self.at, got[0] + 1)
        return min(got[1], self.low[i]) if i < len(self.low) else got[1]


_LOGS = np.concatenate(([0], np.floor(np.log2(np.arange(1, _BLOCK + 1))).astype(np.int64)))


def _range_min(lcp: np.ndarray):
    levels = [lcp]
    while 2 << (len(levels) - 1) <= len(lcp):
        a, half = levels[-1], 1 << (len(levels) - 1)
        levels.append(np.minimum(a[:-half], a[half:]))
    logs = _LOGS
    flat = np.concatenate(levels)
    starts = np.concatenate(([0], np.cumsum([len(x) for x in levels])))[:-1]

    def query(a: np.ndarray, b: np.ndarray) -> np.ndarray:  # both ends included
        k = logs[b - a + 1]
        return np.minimum(flat[starts[k] + a], flat[starts[k] + b - (1 << k) + 1])

    return query


class InducedSort:
    """Suffixes of ``text``: unsigned symbols, the last one 0 and the only 0."""

    def __init__(self, text: np.ndarray, cap: int, ram: int = RAM):
        self.text, self.cap, self.ram = text, cap, ram
        change = np.flatnonzero(text[1:] != text[:-1])
        ends = np.concatenate((change, [len(text) - 1]))
        up = np.concatenate((text[change] < text[change + 1], [True]))
        sizes = np.diff(np.concatenate(([-1], ends)))
        self.small = np.repeat(up, sizes)
        self.kind = np.int32 if len(text) < 1 << 31 else np.int64
        self.run_end = np.repeat(ends.astype(self.kind), sizes)
        self.lms = np.flatnonzero(self.small[1:] & ~self.small[:-1]) + 1
        self.symbols = np.unique(text).tolist()

    def _run(self, pos: int) -> int:
        return int(self.run_end[pos]) - pos + 1

    def _scan(self, pos, lcp, symbol, ties, small, block, minima, out) -> None:
        """Insert the left neighbours of one scanned block into ``out``."""
        before = np.maximum(pos - 1, 0)
        sym = self.text[before]
        fit = (sym <= symbol if ties else sym < symbol) if small else (sym >= symbol if ties else sym > symbol)
        sel = np.flatnonzero(fit & (pos > 0))
        if len(sel):
            order = np.argsort(sym[sel], kind="stable")
            at = sel[order]
            s = sym[at].astype(np.int64)
            new = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
            stop = np.concatenate((new[1:], [len(at)]))
            if minima is None:
                common = np.zeros(len(at), dtype=np.int32)
            else:
                query = _range_min(lcp)
                start = np.concatenate(([0], at[:-1] + 1))
                start[new] = 0
                common = np.minimum(query(start, at), self.cap) + 1
                heads = common[new].tolist()
                tails = at[stop - 1] + 1
                after = np.full(len(tails), _FAR)
                rest = tails < len(lcp)
                after[rest] = query(tails[rest], np.full(int(rest.sum()), len(lcp) - 1))
                for i, (c, low) in enumerate(zip(s[new].tolist(), after.tolist())):
                    since = minima.since(c)
                    heads[i] = 0 if since is None else min(heads[i], since + 1)
                    minima.last[c] = block, low
                common[new] = heads
                common = common.astype(np.int32)
            for a, b, c in zip(new.tolist(), stop.tolist(), s[new].tolist()):
                out.push(c, before[at[a:b]], common[a:b])
        if minima is not None:
            minima.add(block, int(lcp.min()))

    def _induce(self, seeds: Queues, lcps: bool) -> tuple[Queues, Queues]:
        """All L- and all S-suffixes by first symbol; L ascending, S descending."""
        large, queue = Queues(self.ram), Queues(self.ram)
        minima = _Minima() if lcps else None
        block = 0
        for c in self.symbols:
            last = None
            for pos, lcp in queue.drain(c):
                block += 1
                large.push(c, pos, lcp)
                self._scan(pos, lcp, c, True, False, block, minima, queue)
                last = int(pos[-1])
            first = True
            for pos, lcp in seeds.forwards(c):
                block += 1
                if first and lcps:
                    lcp = lcp.copy()
                    lcp[0] = 0 if last is None else min(self._run(last), self._run(int(pos[0])))
                first = False
                self._scan(pos, lcp, c, False, False, block, minima, queue)
        small, queue = Queues(self.ram), Queues(self.ram)
        minima = _Minima() if lcps else None
        block = 0
        for c in reversed(self.symbols):
            last = None
            if c == 0:
                small.push(0, np.array([len(self.text) - 1]), np.zeros(1, dtype=np.int32))
            for pos, lcp in queue.drain(c):
                block += 1
                small.push(c, pos, lcp)
                self._scan(pos, lcp, c, True, True, block, minima, queue)
                last = int(pos[-1])
            pending = None
            for pos, lcp in large.backwards(c, keep=True):
                block += 1
                if pending is None:
                    pending = 0 if last is None else min(self._run(last), self._run(int(pos[-1])))
                down = np.concatenate(([pending], lcp[:0:-1])).astype(np.int32)
                pending = int(lcp[0])
                self._scan(pos[::-1], down, c, False, True, block, minima, queue)
        return large, small

    def _seeds(self, order: np.ndarray, lcps: np.ndarray | None) -> Queues:
        seeds = Queues(self.ram)
        symbol = self.text[order]
        place = np.argsort(symbol, kind="stable")
        s = symbol[place]
        new = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
        for a, b in zip(new.tolist(), [*new[1:].tolist(), len(s)]):
            for i in range(a, b, _BLOCK):
                p = place[i : min(b, i + _BLOCK)]
                seeds.push(int(s[a]), order[p], np.zeros(len(p), dtype=np.int32) if lcps is None else lcps[p])
        return seeds

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefixes of the suffixes at a and b, up to ``cap``."""
        out = np.zeros(len(a), dtype=np.int32)
        live = np.arange(len(a))
        end = len(self.text) - 1
        for k in range(self.cap):
            same = self.text[np.minimum(a[live] + k, end)] == self.text[np.minimum(b[live] + k, end)]
            live = live[same]
            if not len(live):
                break
            out[live] += 1
        return out

    def _sorted_lms(self) -> np.ndarray:
        """The leftmost S-suffixes in order (those with ``cap`` common symbols in any)."""
        lms = self.lms
        if len(lms) < 2:
            return lms
        large, small = self._induce(self._seeds(lms, None), lcps=False)
        is_lms = np.zeros(len(self.text), dtype=bool)
        is_lms[lms] = True
        parts = []
        for c in self.symbols:
            for pos, _ in small.backwards(c):
                pos = pos[::-1]
                parts.append(pos[is_lms[pos]])
        order = np.concatenate(parts)
        size = np.zeros(len(self.text), dtype=self.kind)
        size[lms] = np.diff(np.concatenate((lms, [len(self.text) - 1]))) + 1
        a, b = order[:-1], order[1:]
        live = np.flatnonzero(size[a] == size[b])
        differ = np.ones(len(a), dtype=bool)
        differ[live] = False
        k = 0
        while len(live):
            live = live[k < size[a[live]]]
            same = self.text[a[live] + k] == self.text[b[live] + k]
            differ[live[~same]] = True
            live = live[same]
            k += 1
        del size, large, small
        names = np.concatenate(([0], np.cumsum(differ)))
        if names[-1] == len(order) - 1:
            return order
        number = np.zeros(len(self.text), dtype=self.kind)
        number[order] = names
        reduced = number[lms]
        if 24 * len(reduced) <= self.ram:
            # Each name stands for two symbols or more.
            return lms[_in_memory(reduced, self.cap // 2 + 1)]
        del number, names
        inner = InducedSort(reduced.astype(np.uint32), self.cap // 2 + 1, self.ram)
        return lms[np.concatenate([pos for pos, _ in inner.suffixes()])]

    def suffixes(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of (positions, common prefix with the suffix before), in order."""
        order = self._sorted_lms()
        if not len(order):  # only the final symbol has no larger neighbour on its left
            order = np.array([len(self.text) - 1])
        lcps = np.concatenate(([0], self._common(order[:-1], order[1:]))).astype(np.int32)
        large, small = self._induce(self._seeds(order, lcps), lcps=True)
        for c in self.symbols:
            last = None
            for pos, lcp in large.forwards(c):
                yield pos, lcp
                last = int(pos[-1])
            before = None
            for pos, lcp in small.backwards(c):
                pos, lcp = pos[::-1], lcp[::-1]
                if before is None:
                    before = 0 if last is None else min(self._run(last), self._run(int(pos[0])))
                yield pos, np.concatenate(([before], lcp[:-1]))
                before = int(lcp[-1])


def _in_memory(names: np.ndarray, cap: int) -> np.ndarray:
    """Order of the suffixes of a small integer text by doubling, to ``cap`` symbols."""
    rank = names.astype(np.int64)
    n, step = len(rank), 1
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - step] = rank[step:] + 1
        key = rank * (n + 2) + ahead
        order = np.argsort(key)  # equal keys get one rank, so their order is free
        sorted_ = key[order]
        fresh = np.concatenate(([0], np.cumsum(sorted_[1:] != sorted_[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = fresh
        step *= 2
        if fresh[-1] == n - 1 or step >= cap or step >= n:
            return order
