"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

``encode`` works in four steps.

1. Where documents are read, each chunk of texts (``CHUNK_BYTES``) is cut into
   pre-tokens.  A text becomes its sequence of word numbers (the positions),
   and the chunk's words are listed once each, in hash buckets.
2. The buckets of all chunks are shuffled by bucket, so that all occurrences of
   a word meet, and each distinct word is encoded once.  A frequent word comes
   once from each chunk, not once for each occurrence.  A bucket is read as a
   stream of blocks; a word is encoded again only if ``KNOWN`` others came since.
3. The ids go back to the chunks they were asked by.
4. Each chunk's texts are reassembled from its word numbers and its words' ids.
   A chunk has a bounded size, so this is a bounded group.

Word lists and ids travel as compressed blocks.  Step 1 is staged in buckets of
chunks, so that both the words and the numbers come from one committed attempt,
and the numbers wait for their ids where they are.  Decoding
looks every id up in the token-byte table, which has the fixed size of the
vocabulary.

Buckets of chunks follow the bytes of the input up to ``MOST_BUCKETS`` (a
bucketed table has a limit), buckets of words up to ``MOST_KEY_BUCKETS``.  Beyond
these they hold more chunks and more blocks each, which are read in sequence;
what a task holds in memory is a chunk, a block, and the words it knows.

Defined cases: null text counts as empty and gives no ids; a text longer than a
chunk is a chunk of its own; repeated rows, repeated or null doc_ids give a row
each; columns of any name ride along, and a new column whose name is taken gets
a leading underscore.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import buckets, key_buckets, squeeze, squeeze_strings, unsqueeze, unsqueeze_strings
from .common import fresh, staged_by, table

CHUNK_BYTES = 24 << 20  # of characters, of one chunk of texts
MOST_BUCKETS = 32_768  # of chunks
KNOWN = 500_000  # words of a bucket remembered in each of two turns

BLOCK_WORDS = 1 << 19  # word numbers in one compressed block
WORDS, ORDER, NUMBERS, TEXTS = range(4)  # kinds of staged rows


def default_vocabulary() -> tuple[str, str]:
    """Path and pre-token pattern of the installed vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always merge the adjacent pair of least rank, leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > 64:
        return _encode_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get, none = ranks.get, 1 << 60
    pair = [get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
    while pair:
        low = min(pair)
        if low == none:
            break
        i = pair.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pair[i]
        if i < len(pair):
            pair[i] = get(parts[i] + parts[i + 1], none)
        if i:
            pair[i - 1] = get(parts[i - 1] + parts[i], none)
    return [ranks[p] for p in parts]


def _encode_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same by a heap over a linked list, for words of any length."""
    n = len(word)
    end, nxt, prev, alive = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = nxt[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        end[i], alive[j], nxt[i] = stop, False, nxt[j]
        if nxt[j] < n:
            prev[nxt[j]] = i
            if (r := ranks.get(word[i : end[nxt[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[nxt[i]]))
        if prev[i] >= 0 and (r := ranks.get(word[prev[i] : stop])) is not None:
            heapq.heappush(heap, (r, prev[i], stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = nxt[i]
    return out


def _cutter(pattern: str, at: int, names: list[str], n_buckets: int):
    """Texts to chunks: word lists by bucket, the order of word numbers, and the texts' numbers."""
    columns = ["chunk", "kind", "nr", "block", *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number: dict[str, int] = {}
        texts: list[np.ndarray] = []
        rest: list[list[pa.Array]] = []
        kinds: list[pa.DataType] = []
        size = 0

        def rows(n: int, **given) -> pa.RecordBatch:
            types = {"block": pa.binary(), **dict(zip(names, kinds))}
            return pa.RecordBatch.from_arrays([given[c] if c in given else pa.nulls(n, types[c]) for c in columns], columns)

        def flush() -> Iterator[pa.RecordBatch]:
            chunk = uuid.uuid4().hex
            words = [w.encode() for w in number]
            where = np.array([zlib.crc32(w) % n_buckets for w in words], dtype=np.int64)
            order = sorted(range(len(words)), key=lambda i: (where[i], words[i]))
            # Frequent words get small numbers; "back" finds a number's word in bucket order.
            counts = np.bincount(np.concatenate(texts), minlength=len(words)) if words else np.zeros(0, np.int64)
            by_count = np.argsort(-counts, kind="stable")
            rank = np.empty(len(words), dtype=np.uint32)
            rank[by_count] = np.arange(len(words), dtype=np.uint32)
            place = np.empty(len(words), dtype=np.uint32)
            place[order] = np.arange(len(words), dtype=np.uint32)
            back = place[by_count]
            own = lambda kind, n: {"chunk": pa.array([chunk] * n), "kind": pa.array([kind] * n, pa.int32())}
            yield rows(1, **own(ORDER, 1), nr=pa.array([0], pa.int32()), block=pa.array([squeeze(back)], pa.binary()))
            ends = np.flatnonzero(np.diff(where[order], append=-1)) + 1
            lists = [(int(where[order[a]]), squeeze_strings([words[i] for i in order[a:b]])) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())] if words else []
            for i in range(0, len(lists), 2000):
                part = lists[i : i + 2000]
                yield rows(len(part), **own(WORDS, len(part)), nr=pa.array([b for b, _ in part], pa.int32()), block=pa.array([x for _, x in part], pa.binary()))
            start = 0
            while start < len(texts):
                stop, n = start, 0
                while stop < len(texts) and (stop == start or n < BLOCK_WORDS):
                    n += len(texts[stop])
                    stop += 1
                block = squeeze(np.array([len(t) for t in texts[start:stop]], dtype=np.uint32), rank[np.concatenate(texts[start:stop])])
                yield rows(1, **own(NUMBERS, 1), nr=pa.array([start], pa.int32()), block=pa.array([block], pa.binary()))
                start = stop
            done = 0
            for cols in rest:
                n = len(cols[0]) if cols else len(texts)
                yield rows(n, **own(TEXTS, n), nr=pa.array(range(done, done + n), pa.int32()), **dict(zip(names, cols)))
                done += n
            number.clear()
            texts.clear()
            rest.clear()

        for b in batches:
            kinds = [b.schema.field(i).type for i in range(b.num_columns) if i != at]
            values = b.column(at).to_pylist()
            others = [c for i, c in enumerate(b.columns) if i != at]
            start = 0
            for i, text in enumerate(values):
                words = find(text or "")
                texts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.uint32, count=len(words)))
                size += len(text or "") + 64
                if size >= CHUNK_BYTES:
                    rest.append([c.slice(start, i + 1 - start) for c in others])
                    start, size = i + 1, 0
                    yield from flush()
            if start < len(values):
                rest.append([c.slice(start) for c in others])
        if texts:
            yield from flush()

    return run


def _encode_bucket(path: str):
    """All chunks' lists of one bucket of words: each distinct word is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _ranks(path)
        known: dict[bytes, list[int]] = {}
        older: dict[bytes, list[int]] = {}
        for asked in batches:
            answers = []
            for block in asked["block"].to_pylist():
                ids: list[int] = []
                sizes = []
                for w in unsqueeze_strings(block):
                    got = known.get(w)
                    if got is None:
                        got = older.get(w)
                        if len(known) >= KNOWN:
                            known, older = {}, known
                        known[w] = got = encode_word(w, ranks) if got is None else got
                    sizes.append(len(got))
                    ids += got
                answers.append(squeeze(np.array(sizes, dtype=np.uint32), np.array(ids, dtype=np.uint32)))
            yield pa.RecordBatch.from_arrays([asked["chunk"], asked["bucket"], pa.array(answers, pa.binary())], ["chunk", "bucket", "block"])

    return run


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, finish=None, fields: str = "ids binary") -> DataFrame:
    """The columns of ``docs`` without text, and ``fields`` of each text.

    By default that is ``ids``: little-endian unsigned 32-bit ids; names that
    ``docs`` has already get a leading underscore.  ``finish``
    may map a text's id array and the token-byte table to other values.
    """
    if path is None or pattern is None:
        path, pattern = default_vocabulary()
    at = docs.columns.index("text")
    rest = [f"c{i}" for i, c in enumerate(docs.columns) if i != at]
    kinds = [f for i, f in enumerate(docs.schema.fields) if i != at]
    kept = T.StructType([T.StructField(n, f.dataType) for n, f in zip(rest, kinds)])
    cut_schema = T.StructType([*T.StructType.fromDDL("chunk string, kind int, nr int, block binary").fields, *kept])
    source = docs.select(*[F.col(f"`{c}`").alias("text" if i == at else f"c{i}") for i, c in enumerate(docs.columns)])
    n = buckets(docs, most=MOST_BUCKETS)
    parts = staged_by(source.mapInArrow(_cutter(pattern, at, rest, key_buckets(n)), cut_schema), "bpe", "chunk", n)

    asked = parts.filter(F.col("kind") == WORDS).select("chunk", F.col("nr").alias("bucket"), "block")
    answers = asked.select(F.col("chunk").alias("chunk"), "bucket", "block").groupBy("bucket").applyInArrow(_encode_bucket(path), "chunk string, bucket int, block binary")
    texts = parts.filter(F.col("kind") != WORDS)
    finish = finish or (lambda ids, table: (ids.tobytes(),))
    added = T.StructType.fromDDL(fields)

    def put_together(key, texts: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = _tokens(path)
        parts = sorted(zip(texts["kind"].to_pylist(), texts["nr"].to_pylist(), texts["block"].to_pylist()), key=lambda x: x[:2])
        (back,), _ = unsqueeze(next(b for k, _, b in parts if k == ORDER))
        numbers = [unsqueeze(b)[0] for k, _, b in parts if k == NUMBERS]
        texts = texts.filter(pc.equal(texts["kind"], TEXTS)).sort_by("nr")
        got = [unsqueeze(x)[0] for x in answers.sort_by("bucket")["block"].to_pylist()]
        sizes = np.concatenate([s for s, _ in got] or [np.zeros(0, np.uint32)]).astype(np.int64)
        coded = np.concatenate([i for _, i in got] or [np.zeros(0, np.uint32)])
        first = np.concatenate(([0], np.cumsum(sizes)))[:-1][back]
        sizes = sizes[back]
        rows = []
        for nr in (x for lengths, flat in numbers for x in np.split(flat, np.cumsum(lengths, dtype=np.int64)[:-1])):
            n = sizes[nr]
            start = np.repeat(first[nr] - np.concatenate(([0], np.cumsum(n)[:-1])), n) if len(nr) else np.zeros(0, np.int64)
            rows.append(finish(coded[start + np.arange(len(start))], tokens))
        columns = list(zip(*rows)) or [()] * len(added)
        return pa.Table.from_arrays([*(texts[n] for n in rest), *(pa.array(c, type=_arrow(f)) for c, f in zip(columns, added))], names=[*rest, *added.names])

    out = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(put_together, T.StructType([*kept, *added]))
    names = dict(zip(rest, (f.name for f in kinds)))
    taken = [f.name for f in kinds]
    return out.select(*[F.col(n).alias(names[n]) for n in rest], *[F.col(n).alias(fresh(n, taken)) for n in added.names])


def _arrow(field: T.StructField) -> pa.DataType:
    return {"binary": pa.binary(), "string": pa.string(), "bigint": pa.int64(), "array<int>": pa.list_(pa.int32())}[field.dataType.simpleString()]


@lru_cache(maxsize=2)
def _ranks(path: str) -> dict[bytes, int]:
    return load_ranks(path)


_TOKENS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _tokens(path: str) -> tuple[np.ndarray, np.ndarray]:
    """The token-byte table: all tokens' bytes in id order, and each id's first byte."""
    if path not in _TOKENS:
        by_id = {i: t for t, i in load_ranks(path).items()}
        tokens = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
        _TOKENS[path] = np.frombuffer(b"".join(tokens), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
    return _TOKENS[path]


def decode_ids(ids: np.ndarray, tokens: tuple[np.ndarray, np.ndarray]) -> bytes:
    flat, first = tokens
    ids = ids.astype(np.int64)
    n = first[ids + 1] - first[ids]
    if not len(ids):
        return b""
    start = np.repeat(first[ids] - np.concatenate(([0], np.cumsum(n)[:-1])), n)
    return flat[start + np.arange(len(start))].tobytes()


def decode(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` with its column ``ids`` (as ``encode`` makes it) replaced by ``text``; null stays null."""
    path = path or default_vocabulary()[0]
    others = [c for c in coded.columns if c != "ids"]
    name = fresh("text", others)
    schema = T.StructType([coded.schema[c] for c in others] + [T.StructField(name, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(path)
        for b in batches:
            texts = [None if x is None else decode_ids(np.frombuffer(x, dtype="<u4"), tokens).decode("utf-8", "replace") for x in b["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b[c] for c in others), pa.array(texts, pa.string())], [*others, name])

    return coded.select(*others, "ids").mapInArrow(run, schema)


def round_trip(ids: np.ndarray, tokens: tuple[np.ndarray, np.ndarray]) -> tuple[int, str, str]:
    return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(decode_ids(ids, tokens)).hexdigest()


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, finish=round_trip, fields="n_tokens bigint, ids_sha256 string, decoded_sha256 string")
