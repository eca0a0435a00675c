"""Benchmark decontamination by a broadcast hash set of word windows.

The windows of all benchmark items (10 consecutive normalised words; an item
with fewer words is one window) form a set.  Its measured size decides how
many blocks it is split into: each block is at most ``block_bytes``, so what
is broadcast has a fixed bound however large the benchmark is.  With more than
one block the documents are written once with row numbers, and each block gives
only the rows that it hits.  Documents are scanned where they are read, without
a shuffle: rolling hashes over word
numbers propose hits, and each is verified on the words themselves.

Defined cases: null or word-free text has no words and no hits; items whose id
or text is null, or which have no word, are ignored; repeated rows and
repeated doc_ids give a row each; extra columns are kept by ``decontaminate``.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, staged, table

WINDOW = 10
BLOCK_BYTES = 16 << 20

#: Bytes that belong to words: digits, letters, all of non-ASCII; A-Z become a-z.
_WORDS = bytes((b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32) for b in range(256))
_MULT = np.uint64(0x9E3779B97F4A7C15)


def words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


def windows(bench: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, gram, n): each distinct window of each item."""

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, grams, sizes = [], [], []
            for item, text in zip(b["item_id"].to_pylist(), b["text"].to_pylist()):
                w = words(text)
                n = min(width, len(w))
                found = {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if n else ()
                ids += [item] * len(found)
                grams += found
                sizes += [n] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(grams, pa.binary()), pa.array(sizes, pa.int32())], ["item_id", "gram", "n"])

    rows = bench.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text"))
    return rows.filter("item_id is not null and text is not null").mapInArrow(cut_items, "item_id string, gram binary, n int").distinct()


class _Matcher:
    """Windows of one block, with rolling hashes over numbered words."""

    def __init__(self, grams: dict[bytes, list[str]]):
        self.grams = grams
        self.vocab: dict[bytes, int] = {}
        by_size: dict[int, list[list[int]]] = {}
        for g in grams:
            w = g.split(b" ")
            by_size.setdefault(len(w), []).append([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w])
        self.tables = []
        for n, rows in sorted(by_size.items()):
            ids = np.array(rows, dtype=np.uint64)
            h = self._hash([ids[:, j] for j in range(n)])
            seen = np.zeros(1 << 16, dtype=bool)
            seen[(h >> np.uint64(48)).astype(np.int64)] = True
            self.tables.append((n, seen, np.unique(h)))

    @staticmethod
    def _hash(columns: list[np.ndarray]) -> np.ndarray:
        h = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            h = (h ^ c) * _MULT
            h ^= h >> np.uint64(29)
        return h

    def find(self, w: list[bytes]) -> list[tuple[int, int, bytes]]:
        """(start, size, gram) of each window that occurs in ``w``."""
        get = self.vocab.get
        ids = np.fromiter([get(x, 0) for x in w], dtype=np.uint64, count=len(w))
        known = ids != 0
        if not known.any():
            return []
        gaps = np.concatenate(([0], np.cumsum(~known)))
        out = []
        for n, seen, hashes in self.tables:
            if len(w) < n:
                continue
            start = np.flatnonzero(gaps[n:] == gaps[:-n])
            if not len(start):
                continue
            h = self._hash([ids[start + j] for j in range(n)])
            near = seen[(h >> np.uint64(48)).astype(np.int64)]
            start, h = start[near], h[near]
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in start[hashes[at] == h].tolist():
                gram = b" ".join(w[i : i + n])
                if gram in self.grams:
                    out.append((i, n, gram))
        return out

    def spans(self, w: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """The word ranges that are hit in ``w``, and the items that hit them."""
        found = self.find(w)
        return [(i, i + n) for i, n, _ in found], {x for _, _, g in found for x in self.grams[g]}


def _merge(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


_WORD_RUN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def remove_spans(text: bytes, spans: list[list[int]]) -> bytes:
    """``text`` without the bytes from each span's first word to its last."""
    places = [m.span() for m in _WORD_RUN.finditer(text)]
    kept, at = [], 0
    for a, b in spans:
        kept.append(text[at : places[a][0]])
        at = places[b - 1][1]
    return b"".join([*kept, text[at:]])


def scan(docs: DataFrame, bench: DataFrame, width: int = WINDOW, block_bytes: int = BLOCK_BYTES, clean: bool = False) -> DataFrame:
    """``docs`` with n_words, hit_spans (JSON word ranges), hit_items and clean_text.

    ``clean_text`` is the text without its hit spans where ``clean`` is set,
    otherwise null.  Names that ``docs`` has already get a leading underscore.
    """
    grams = staged(windows(bench, width), "grams")
    size = grams.agg(F.sum(F.octet_length("gram") + F.octet_length("item_id") + 120)).first()[0] or 0
    blocks = max(1, -(-int(size) // block_bytes))

    def block(k: int) -> Broadcast:
        part = grams if blocks == 1 else grams.filter(F.pmod(F.xxhash64("gram"), F.lit(blocks)) == k)
        held: dict[bytes, list[str]] = {}
        for item, gram in ((r[0], bytes(r[1])) for r in part.select("item_id", "gram").toLocalIterator()):
            held.setdefault(gram, []).append(item)
        return docs.sparkSession.sparkContext.broadcast(held)

    names = [fresh(x, docs.columns) for x in ("n_words", "hit_spans", "hit_items", "clean_text")]
    added = T.StructType.fromDDL("a long, b string, c array<string>, d string").fields
    schema = T.StructType([*docs.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, added))])
    at, n = docs.columns.index("text"), len(docs.columns)

    def finished(b: pa.RecordBatch, hits) -> pa.RecordBatch:
        """The rows of a batch with what ``hits(number, words)`` tells: spans and items."""
        rows = []
        for i, text in enumerate(b.column(at).cast(pa.large_binary()).to_pylist()):
            w = words(text)
            spans, items = hits(i, w)
            merged = _merge(spans)
            cleaned = (remove_spans(text, merged) if merged else text).decode("utf-8", "replace") if clean and text is not None else None
            rows.append((len(w), json.dumps(merged), sorted(items), cleaned))
        cols = list(zip(*rows)) or [()] * 4
        kinds = (pa.int64(), pa.string(), pa.list_(pa.string()), pa.string())
        return pa.RecordBatch.from_arrays([*b.columns[:n], *(pa.array(c, t) for c, t in zip(cols, kinds))], names=schema.names)

    if blocks == 1:
        cast = block(0)
        discard(grams)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _Matcher(cast.value)
            for b in batches:
                yield finished(b, lambda i, w: matcher.spans(w))

        return docs.mapInArrow(run, schema)

    # Documents are written once, with a number for each row; a block gives the numbers of rows that it hits.
    row = fresh("row", docs.columns)
    kept = staged(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    parts = [staged(_hits(kept.select(F.col(row).alias("row"), "text"), block(k)), "hits") for k in range(blocks)]
    discard(grams)
    listed = reduce(DataFrame.unionByName, parts).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    spans, items = (fresh(x, [*docs.columns, row]) for x in ("spans", "items"))
    listed = listed.select(F.col("row").alias(row), F.col("spans").alias(spans), F.col("items").alias(items))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            told, named = b.column(n).to_pylist(), b.column(n + 1).to_pylist()
            yield finished(b, lambda i, w: ([(x["a"], x["b"]) for x in told[i] or ()], set(named[i] or ())))

    return kept.join(listed, row, "left").select(*docs.columns, spans, items).mapInArrow(join, schema)


def _hits(docs: DataFrame, cast: Broadcast) -> DataFrame:
    """(row, spans, items) of the rows that a block of windows hits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _Matcher(cast.value)
        for b in batches:
            rows = []
            for i, text in zip(b["row"].to_pylist(), b["text"].cast(pa.large_binary()).to_pylist()):
                spans, items = matcher.spans(words(text))
                if spans:
                    rows.append((i, [{"a": x, "b": y} for x, y in _merge(spans)], sorted(items)))
            cols = list(zip(*rows)) or [()] * 3
            kinds = (pa.int64(), pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())])), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["row", "spans", "items"])

    return docs.mapInArrow(run, "row long, spans array<struct<a:int,b:int>>, items array<string>")


def decontaminate(docs: DataFrame, bench: DataFrame, remove: str = "documents", width: int = WINDOW) -> DataFrame:
    """The rows and columns of ``docs`` after removal.

    ``remove='documents'`` drops each document with a hit; ``'spans'`` keeps
    all documents and cuts the hit words out of their texts.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    seen = scan(docs, bench, width, clean=remove == "spans")
    spans, cleaned = seen.columns[-3], seen.columns[-1]
    if remove == "documents":
        return seen.filter(F.col(spans) == "[]").select(*docs.columns)
    return seen.select(*[F.col(cleaned).alias("text") if c == "text" else F.col(c) for c in docs.columns])


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = scan(docs, table(spark, sf_dir, "benchmark"))
    lengths = F.from_json("hit_spans", "array<array<int>>")
    n_hit = F.aggregate(lengths, F.lit(0).cast("long"), lambda a, x: a + (x[1] - x[0]).cast("long"))
    return seen.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("hit_spans") != "[]").alias("contaminated"),
    )


OP1_SQL = r"""
with items as (
  select cast(item_id as varchar) as item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null and text is not null),
grams as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as gram
  from items, unnest(range(1, len(w) - least(10, len(w)) + 2)) as t(i) where len(w) > 0),
docs as (
  select row_number() over () as r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
sizes as (select distinct n from grams),
spots as (
  select r, i, s.n, array_to_string(w[i:i + s.n - 1], ' ') as gram
  from docs, sizes s, unnest(range(1, cast(len(w) - s.n + 2 as bigint))) as t(i)),
hits as (select r, i, p.n, item_id from spots p join grams g on g.gram = p.gram and g.n = p.n),
hit_words as (select r, count(distinct p) as n_hit from hits, unnest(range(i, cast(i + n as bigint))) as t(p) group by r),
hit_items as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id, ',' order by item_id) as ids from hits group by r)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from docs d left join hit_words using (r) left join hit_items using (r)
"""

