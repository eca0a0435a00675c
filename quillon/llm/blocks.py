"""Compact blocks of numbers and byte strings for packed shuffles."""

from __future__ import annotations

import tempfile

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes of text for each bucket of documents in a packed shuffle.
BUCKET_BYTES = 8 << 20
#: Buckets that a chunk's keys (words, anchors) are dealt to, at most.  More
#: would leave only a few keys in each block; a bucket is read as a stream, so
#: its size is not bounded by memory.
MOST_KEY_BUCKETS = 4096


def text_bytes(docs: DataFrame) -> int:
    return int(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)


def buckets(docs: DataFrame, size: int = BUCKET_BYTES, most: int | None = None) -> int:
    """Buckets of about ``size`` bytes of ``docs.text``, no fewer than the session's shuffle partitions, no more than ``most``."""
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // size))
    return min(n, most) if most else n


def key_buckets(n: int) -> int:
    return min(n, MOST_KEY_BUCKETS)


def _planes(a: np.ndarray) -> bytes:
    """The bytes of unsigned numbers by significance, so that equal high bytes compress."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()


def _from_planes(data: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, dtype=np.uint8).reshape(size, n).T.copy().view(kind).reshape(n)


def squeeze(*arrays: np.ndarray, tail: bytes = b"", level: int = 3) -> bytes:
    """One compressed block of unsigned arrays (uint32 or uint64) and a byte string."""
    head = np.array([len(arrays), *(x for a in arrays for x in (a.itemsize, len(a)))], dtype=np.uint64)
    return zstandard.ZstdCompressor(level=level).compress(b"".join((head.tobytes(), *(_planes(a) for a in arrays), tail)))


def unsqueeze(block: bytes) -> tuple[list[np.ndarray], bytes]:
    data = zstandard.ZstdDecompressor().decompress(block)
    n = int(np.frombuffer(data, dtype=np.uint64, count=1)[0])
    head = np.frombuffer(data, dtype=np.uint64, count=2 * n, offset=8).tolist()
    at, out = 8 + 16 * n, []
    for size, count in zip(head[::2], head[1::2]):
        out.append(_from_planes(data[at : at + size * count], f"<u{size}", count))
        at += size * count
    return out, data[at:]


def squeeze_strings(items: list[bytes]) -> bytes:
    return squeeze(np.array([len(x) for x in items], dtype=np.uint32), tail=b"".join(items))


def unsqueeze_strings(block: bytes) -> list[bytes]:
    (sizes,), data = unsqueeze(block)
    ends = np.cumsum(sizes, dtype=np.int64).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


class Spool:
    """Byte strings by number: in memory up to ``room`` bytes, later ones in an unlinked scratch file of the task."""

    def __init__(self, room: int):
        self.room, self.end = room, 0
        self.items: list[bytes | tuple[int, int]] = []
        self.file = None

    def __len__(self) -> int:
        return len(self.items)

    def add(self, data: bytes) -> int:
        if len(data) <= self.room:
            self.room -= len(data)
            self.items.append(data)
        else:
            if self.file is None:
                self.file = tempfile.TemporaryFile()
            self.file.seek(self.end)
            self.file.write(data)
            self.items.append((self.end, len(data)))
            self.end += len(data)
        return len(self.items) - 1

    def get(self, i: int) -> bytes:
        item = self.items[i]
        if isinstance(item, bytes):
            return item
        self.file.seek(item[0])
        return self.file.read(item[1])
