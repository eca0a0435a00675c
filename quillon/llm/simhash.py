"""SimHash near-duplicates by a binary-trie self-join.

Each document gets a 64-bit fingerprint.  Copies collapse first: only distinct
fingerprints, each with the smallest doc_id that has it, are joined.  Two
fingerprints within ``BUDGET`` = 2 bits differ in at most 2 of 4 blocks of 16
bits, so they agree on one of the 6 pairs of blocks.  For each pair the bits
are permuted to put these 32 bits on top; rows with equal top bits share the
upper part of a trie, and form a bucket that one task can traverse: node pairs
are expanded level by level together, differing bits accumulate, and a pair is
pruned when it exceeds the budget.  Links leave a task as a star per group of
linked fingerprints, never as all pairs.

A bucket of more than ``BUCKET`` fingerprints (a very dense group of near
copies) is not handed to one task.  Its trie is joined with itself ``STEP``
levels at a time as tables: nodes with their counts, and node pairs with their
differing bits, which go down to the pairs of their children and drop out beyond
the budget.  A node pair that holds at most ``BUCKET`` fingerprints is a cell
that one task traverses to the end; so no task's share grows with the data, and
no link is lost.

Defined cases: null, empty or word-free text has fingerprint zero, linked like
any other.  Repeated rows and repeated doc_ids give a row each.  Rows without
doc_id take the component of a row with the same fingerprint that has one,
else null, and never carry a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, doc_text, fresh, table
from .components import components

BUDGET = 2
BUCKET = 1024
STEP = 4  # levels of the trie between two tables of node pairs
SHINGLE = 3
_LOWER = bytes((b + 32 if 65 <= b <= 90 else b) for b in range(256))
_BLOCKS = [(i, j) for i in range(4) for j in range(i + 1, 4)]


def fingerprint(text: bytes | None, size: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of word shingles, repeats included."""
    w = text.translate(_LOWER).split() if text else []
    if not w:
        return 0
    if len(w) <= size:
        return xxhash.xxh64_intdigest(b" ".join(w), 42)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    n = len(w) - size + 1
    h = np.fromiter((digest(join(x), 42) for x in zip(*(w[i:] for i in range(size)))), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        part = h[i : i + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp): fp is the fingerprint as a signed 64-bit integer, row_key the text's hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, size) for t in b["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["row_key"], pa.array(fp.view(np.int64))], ["doc_id", "row_key", "fp"])

    return doc_text(docs).withColumn("row_key", F.xxhash64("text")).mapInArrow(run, "doc_id long, row_key long, fp long")


def _permuted(fp: np.ndarray, pair: int) -> np.ndarray:
    """Unsigned fingerprints with the pair's two blocks of 16 bits on top."""
    order = [*_BLOCKS[pair], *(i for i in range(4) if i not in _BLOCKS[pair])]
    out = np.zeros_like(fp)
    for place, block in enumerate(order):
        out |= ((fp >> np.uint64(16 * block)) & np.uint64(0xFFFF)) << np.uint64(48 - 16 * place)
    return out


def trie_links(keys: np.ndarray, starts: np.ndarray, depth: int = 32, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sorted distinct ``keys`` within ``budget`` bits, inside each bucket.

    ``starts`` has the bounds of buckets of keys with equal bits above
    ``depth``.  A trie node is a range of the sorted keys; node pairs go down
    together and drop out when their differing bits exceed the budget.
    """
    lo, hi = starts[:-1], starts[1:]
    return _descend(keys, lo, hi, lo, hi, np.zeros(len(lo), dtype=np.int64), depth, budget)


def _descend(keys: np.ndarray, a0: np.ndarray, a1: np.ndarray, b0: np.ndarray, b1: np.ndarray, bits: np.ndarray, depth: int, budget: int = BUDGET) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``budget`` bits under node pairs (ranges of ``keys``) that differ in ``bits`` bits above ``depth``."""
    left, right = [], []

    def leaves() -> None:
        nonlocal a0, a1, b0, b1, bits
        gone = (a0 == b0) & (a1 - a0 < 2)
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1) & ~gone
        if leaf.any():
            x, y = a0[leaf], b0[leaf]
            near = np.bitwise_count(keys[x] ^ keys[y]) <= budget
            left.append(x[near])
            right.append(y[near])
        if leaf.any() or gone.any():
            a0, a1, b0, b1, bits = (z[~leaf & ~gone] for z in (a0, a1, b0, b1, bits))

    leaves()
    for level in range(depth - 1, -1, -1):
        if not len(a0):
            break
        ones = np.concatenate(([0], np.cumsum((keys >> np.uint64(level)) & np.uint64(1), dtype=np.int64)))
        am, bm = a1 - (ones[a1] - ones[a0]), b1 - (ones[b1] - ones[b0])
        same = a0 == b0
        parts = [(a0, am, b0, bm, bits, None), (am, a1, bm, b1, bits, None), (a0, am, bm, b1, bits + 1, None), (am, a1, b0, bm, bits + 1, ~same)]
        nxt = []
        for p0, p1, q0, q1, d, only in parts:
            keep = (p1 > p0) & (q1 > q0) & (d <= budget) & ~((p0 == q0) & (p1 - p0 < 2))
            if only is not None:
                keep &= only
            nxt.append([x[keep] for x in (p0, p1, q0, q1, d)])
        a0, a1, b0, b1, bits = (np.concatenate(x) for x in zip(*nxt))
        leaves()
    if not left:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(left), np.concatenate(right)


def _stars(n: int, x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> tuple[list[int], list[int]]:
    """(member, smallest member) of each linked group, from index pairs."""
    root = np.arange(n)
    while True:  # each pass hangs larger roots below smaller ones, then flattens
        rx, ry = root[x], root[y]
        open_ = rx != ry
        if not open_.any():
            break
        np.minimum.at(root, np.maximum(rx, ry)[open_], np.minimum(rx, ry)[open_])
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, ids)
    moved = np.flatnonzero(ids != least[root])
    return ids[moved].tolist(), least[root[moved]].tolist()


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links of whole buckets, from rows sorted by pair of blocks and permuted key."""
    held: list[np.ndarray] = []

    def link(pair: np.ndarray, top: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        keys = np.zeros(len(fp), dtype=np.uint64)
        for p in np.unique(pair):
            at = pair == p
            keys[at] = _permuted(fp[at].view(np.uint64), int(p))
        order = np.lexsort((keys, pair))
        keys, rep, pair = keys[order], rep[order], pair[order]
        head = keys >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], (head[1:] != head[:-1]) | (pair[1:] != pair[:-1]))))
        x, y = trie_links(keys, np.concatenate((first, [len(keys)])))
        u, v = _stars(len(keys), x, y, rep)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for b in batches:
        if not b.num_rows:
            continue
        rows = [b[c].to_numpy(zero_copy_only=False) for c in ("pair", "top", "fp", "rep")]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        last = int(np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))[-1]) + 1 if (rows[0] != rows[0][-1]).any() or (rows[1] != rows[1][-1]).any() else 0
        held = [x[last:] for x in rows]
        if last:
            yield link(*(x[:last] for x in rows))
    if held and len(held[0]):
        yield link(*held)


_CELL = ["pair", "top", "level", "a", "b"]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Star links of whole cells, from rows sorted by cell, side and free bits."""
    held: list[np.ndarray] = []

    def link(cell: list[np.ndarray], bits: np.ndarray, side: np.ndarray, free: np.ndarray, rep: np.ndarray) -> pa.RecordBatch:
        keys = free.view(np.uint64)
        new = np.flatnonzero(np.concatenate(([True], np.any([x[1:] != x[:-1] for x in cell], axis=0))))
        end = np.concatenate((new[1:], [len(keys)]))
        whole = cell[3][new] == cell[4][new]
        middle = np.where(whole, new, new + np.add.reduceat(side == 0, new))
        stop = np.where(whole, end, middle)
        x, y = [], []
        for level in np.unique(cell[2]).tolist():  # bits above have been compared
            own = cell[2][new] == level
            got = _descend(keys, new[own], stop[own], middle[own], end[own], bits[new[own]].astype(np.int64), 32 - STEP * level)
            x.append(got[0])
            y.append(got[1])
        u, v = _stars(len(keys), np.concatenate(x), np.concatenate(y), rep)
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def parts(rows: list[np.ndarray]) -> tuple:
        return rows[:5], *rows[5:]

    for b in batches:
        if not b.num_rows:
            continue
        rows = [b[c].to_numpy(zero_copy_only=False) for c in (*_CELL, "bits", "side", "free", "rep")]
        if held:
            rows = [np.concatenate(x) for x in zip(held, rows)]
        other = np.flatnonzero(np.any([x != x[-1] for x in rows[:5]], axis=0))
        last = int(other[-1]) + 1 if len(other) else 0
        held = [x[last:] for x in rows]
        if last:
            yield link(*parts([x[:last] for x in rows]))
    if held and len(held[0]):
        yield link(*parts(held))


def _dense_cells(rows: DataFrame, hot: DataFrame, bucket: int) -> DataFrame:
    """The rows (pair, top, free, rep) of hot buckets under each cell of their tries' self-join."""
    masks = [m for m in range(1 << STEP) if m.bit_count() <= BUDGET]
    key = ["pair", "top"]
    open_ = hot.select(*key, F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("bits"))
    out = None
    for level in range(1, 32 // STEP + 1):
        node = F.shiftrightunsigned("free", 32 - STEP * level)
        nodes = cut(rows.groupBy(*key, node.alias("node")).agg(F.count("*").alias("n")))
        of_a = nodes.select(*key, F.shiftrightunsigned("node", STEP).alias("a"), F.col("node").alias("child"), F.col("n").alias("n_a"))
        moves = F.array(*[F.struct(F.lit(m).cast("long").alias("flip"), F.lit(m.bit_count()).alias("more")) for m in masks])
        pairs = open_.join(of_a, [*key, "a"]).select(*key, F.col("a").alias("above"), "b", "bits", "child", "n_a", F.explode(moves).alias("m")).filter(F.col("bits") + F.col("m.more") <= BUDGET)
        below = F.shiftleft("b", STEP) + F.col("child").bitwiseAND(F.lit((1 << STEP) - 1).cast("long")).bitwiseXOR(F.col("m.flip"))
        pairs = pairs.select(*key, "above", F.col("b").alias("beside"), F.col("child").alias("a"), below.alias("b"), (F.col("bits") + F.col("m.more")).alias("bits"), "n_a")
        pairs = pairs.filter("above <> beside or a <= b")
        pairs = pairs.join(nodes.select(*key, F.col("node").alias("b"), F.col("n").alias("n_b")), [*key, "b"])
        pairs = cut(pairs.withColumn("n", F.when(F.col("a") == F.col("b"), F.col("n_a")).otherwise(F.col("n_a") + F.col("n_b"))).filter("n > 1").select(*key, "a", "b", "bits", "n"))
        last = level == 32 // STEP
        closed = pairs if last else pairs.filter(F.col("n") <= bucket)
        sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side")))).otherwise(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("side")), F.struct(F.col("b").alias("node"), F.lit(1).alias("side"))))
        closed = closed.select(*key, F.lit(level).alias("level"), "a", "b", "bits", F.explode(sides).alias("s")).select(*key, "level", "a", "b", "bits", "s.node", "s.side")
        cells = rows.withColumn("node", node).join(closed, [*key, "node"]).select(*_CELL, "bits", "side", "free", "rep")
        out = cells if out is None else out.unionByName(cells)
        if last:
            break
        open_ = pairs.filter(F.col("n") > bucket).select(*key, "a", "b", "bits")
        if open_.isEmpty():
            break
    return out


def links(reps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links that connect representatives ``reps(fp, rep)`` within the budget."""
    block = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long"))
    joined = lambda i, j: F.shiftleft(block(i), 16) + block(j)
    tops = F.array(*[F.struct(F.lit(p).alias("pair"), joined(*x).alias("top"), joined(*(b for b in range(4) if b not in x)).alias("free")) for p, x in enumerate(_BLOCKS)])
    rows = reps.filter("rep is not null").select("fp", "rep", F.explode(tops).alias("t")).select("t.pair", "t.top", "t.free", "fp", "rep")
    hot = cut(rows.groupBy("pair", "top").count().filter(F.col("count") > bucket).select("pair", "top"))
    calm = rows.join(hot, ["pair", "top"], "left_anti").select("pair", "top", "fp", "rep")
    n = int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = calm.repartition(n, "pair", "top").sortWithinPartitions("pair", "top").mapInArrow(_walk, "u long, v long")
    if hot.isEmpty():
        return found
    dense = cut(rows.join(hot, ["pair", "top"], "left_semi").select("pair", "top", "free", "rep"))
    cells = _dense_cells(dense, hot, bucket)
    return found.unionByName(cells.repartition(n, *_CELL).sortWithinPartitions(*_CELL, "side", "free").mapInArrow(_cells, "u long, v long"))


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(doc_id, row_key, fp, component_id) for each row of ``docs``."""
    fps = cut(fingerprints(docs))
    reps = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    named = components(links(reps, bucket)).select(F.col("node").alias("rep"), "component")
    of = reps.join(named, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component_id"))
    return fps.join(of, "fp").select("doc_id", "row_key", "fp", "component_id")


def keep_one(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row of ``docs`` for each component, with the same columns.

    It is the row whose doc_id names the component; of several rows with that
    doc_id, those with other texts are judged by their own fingerprints, and one
    of the rest stays.  A row without doc_id stays only where no row with one
    shares its fingerprint, and of such rows with one fingerprint one stays.
    """
    key, fp, taken = (fresh(x, docs.columns) for x in ("row_key", "fp", "first_id"))
    found = near_duplicates(docs.select("doc_id", "text"), bucket)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias(taken), F.col("row_key").alias(key)).distinct()
    kept = docs.join(first, (F.col("doc_id").cast("long") == F.col(taken)) & (F.xxhash64("text") == F.col(key)), "left_semi")
    kept = kept.dropDuplicates(["doc_id"]).select(*docs.columns)
    lone = found.filter("doc_id is null and component_id is null").select(F.col("row_key").alias(key), F.col("fp").alias(fp)).distinct()
    nameless = docs.filter("doc_id is null").join(lone, F.xxhash64("text") == F.col(key)).dropDuplicates([fp]).select(*docs.columns)
    return kept.unionByName(nameless)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
