"""Greedy centroid clustering of sequences by identity.

Sequences are taken by falling count, then by sequence.  Each joins the first
centroid (the most abundant) within the identity, or becomes a centroid.
Identity is 1 - levenshtein / the longer length.

Scale: candidate pairs come from an equi-join on segment keys.  With at most d
edits, at least 1 + ``SPARE`` of d + 1 + ``SPARE`` segments of the shorter
sequence occur unchanged within d positions in the other, so each sequence may
leave out its ``SPARE`` most frequent segments: a start that all sequences share
does not pair them all.  The greedy choice is then settled in rounds over the
verified pairs: a sequence is decided once all earlier neighbours are, so the
result is that of the sequential pass without ever gathering a component in one
task; pairs of decided sequences leave the table of the next round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import checkpointed

#: Frequent segments that a sequence may leave out of its search.
SPARE = 2


def neighbours(items: DataFrame, seq: str, identity: float) -> DataFrame:
    """(a, b): pairs of distinct sequences with at least ``identity``."""
    s, n = F.col("s"), F.length("s")
    edits = lambda x: F.floor((1 - identity) * x + 1e-9).cast("int")
    items = items.select(F.col(seq).alias("s")).distinct().filter(n > 0)
    # The segments are those of the shorter sequence (of length n) for the edits that the longer one (m) allows.
    place = lambda i, k: F.floor(i * F.col("n") / k).cast("int")
    most = F.floor(n / identity + 1e-9).cast("int")
    short = items.select("s", n.alias("n"), F.explode(F.sequence(n, most)).alias("m")).withColumn("d", edits(F.col("m")))
    k = F.col("d") + 1 + SPARE
    short = short.select("s", "n", "m", "d", F.explode(F.sequence(F.lit(0), k - 1)).alias("i"))
    keys = short.withColumns({"at": place(F.col("i"), k), "w": place(F.col("i") + 1, k) - place(F.col("i"), k)})
    keys = keys.select("s", "n", "m", "d", "i", "w", F.substring(s, F.col("at") + 1, F.col("w")).alias("gram"))
    # The d + 1 rarest segments of a sequence are enough.  Empty ones (of very short sequences) are the most frequent.
    key = ["m", "n", "i", "w", "gram"]
    rare = Window.partitionBy("s", "m").orderBy(F.when(F.col("w") == 0, F.lit(2**62)).otherwise(F.col("f")), "i")
    counts = keys.groupBy(*key).agg(F.count("*").alias("f"))
    # Exploded tables are larger than Spark's estimate of them: no broadcast.
    keys = keys.join(counts.hint("merge"), key).withColumn("nth", F.row_number().over(rare)).filter(F.col("nth") <= F.col("d") + 1).select("s", *key)
    # The longer sequence offers the grams of that length within its edits of that place, for each shorter length.
    lens = F.sequence(F.ceil(n * identity - 1e-9).cast("int"), n)
    long = items.select("s", n.alias("m"), edits(n).alias("d"), F.explode(lens).alias("n")).filter("n > 0")
    long = long.select("s", "m", "n", "d", F.explode(F.sequence(F.lit(0), F.col("d") + SPARE)).alias("i"))
    long = long.withColumns({"at": place(F.col("i"), k), "w": place(F.col("i") + 1, k) - place(F.col("i"), k)})
    first = F.greatest(F.col("at") - F.col("d"), F.lit(0))
    spots = F.sequence(first, F.greatest(F.least(F.col("at") + F.col("d"), F.col("m") - F.col("w")), first))
    grams = F.array_distinct(F.transform(spots, lambda p: F.substring(s, p + 1, F.col("w"))))
    long = long.select("s", "m", "n", "i", "w", F.explode(grams).alias("gram"))
    found = keys.alias("p").join(long.hint("merge").alias("q"), key).filter("p.s <> q.s")
    pairs = found.select(F.least("p.s", "q.s").alias("a"), F.greatest("p.s", "q.s").alias("b")).distinct()
    longer = F.greatest(F.length("a"), F.length("b"))
    return pairs.filter(F.levenshtein("a", "b") <= F.floor((1 - identity) * longer + 1e-9))


def greedy_clusters(items: DataFrame, seq: str, count: str, identity: float, most_rounds: int = 1000) -> DataFrame:
    """(seq, count, centroid, is_seed) of the greedy pass."""
    if not 0 < identity <= 1:
        raise ValueError("identity is above 0 and at most 1")
    nodes = checkpointed(items.groupBy(F.col(seq).alias("s")).agg(F.sum(count).alias("n")).filter("s is not null"))
    pairs = neighbours(nodes, "s", identity)
    a, b = nodes.select(F.col("s").alias("a"), F.col("n").alias("na")), nodes.select(F.col("s").alias("b"), F.col("n").alias("nb"))
    both = pairs.join(a, "a").join(b, "b")
    first = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # s may join the earlier sequence e, which is a centroid or not, or (null) not decided.
    earlier = F.when(first, F.struct(F.col("b").alias("s"), F.col("a").alias("e"), F.col("na").alias("ne")))
    later = F.struct(F.col("a").alias("s"), F.col("b").alias("e"), F.col("nb").alias("ne"))
    edges = checkpointed(both.select(earlier.otherwise(later).alias("x")).select("x.*", F.lit(None).cast("boolean").alias("is_seed")))
    ready = checkpointed(nodes.join(edges, "s", "left_anti").select("s", F.col("s").alias("c")))
    done = [ready]
    for _ in range(most_rounds):
        decided = ready.select(F.col("s").alias("e"), (F.col("s") == F.col("c")).alias("now"))
        left = edges.join(ready, "s", "left_anti").join(decided, "e", "left")
        edges = checkpointed(left.select("s", "e", "ne", F.coalesce("is_seed", "now").alias("is_seed")))
        # The earliest neighbour that is a centroid wins, once every neighbour before it is decided.
        order = F.struct((-F.col("ne")).alias("ne"), "e")
        best = edges.groupBy("s").agg(F.min(F.when(F.col("is_seed"), order)).alias("seed"), F.min(F.when(F.col("is_seed").isNull(), order)).alias("wait"))
        ready = checkpointed(best.filter("wait is null or seed < wait").select("s", F.coalesce("seed.e", "s").alias("c")))
        if ready.isEmpty():
            break
        done.append(ready)
    else:
        raise RuntimeError("clustering did not settle")
    decided = reduce(DataFrame.unionByName, done)
    return nodes.join(decided, "s").select(F.col("s").alias(seq), F.col("n").alias(count), F.col("c").alias("centroid"), (F.col("c") == F.col("s")).alias("is_seed"))


def clonotypes(df: DataFrame, cdr3: str, reads: str, identity: float, at_least: int = 1) -> DataFrame:
    """``df`` with the clonotype (centroid) of its CDR3; CDR3s with too few reads have none."""
    counts = df.groupBy(cdr3).agg(F.sum(reads).alias("_reads")).filter(F.col("_reads") >= at_least)
    found = greedy_clusters(counts, cdr3, "_reads", identity).select(cdr3, F.col("centroid").alias("clonotype"))
    return df.join(found, cdr3, "left")


def read_uc(lines: DataFrame) -> DataFrame:
    """Members of clusters from the seed (S) and hit (H) lines of a tab-separated cluster table.

    A label begins with its count; where the ninth column's has none, the tenth's is used.
    """
    p = F.split("value", "\t")
    at = lambda i: F.get(p, F.lit(i))
    number = lambda i: F.substring_index(at(i), ":", 1).try_cast("long")
    rows = lines.select(at(0).alias("kind"), at(1).alias("cluster"), at(8).alias("label"), F.coalesce(number(8), number(9)).alias("count")).filter(F.col("kind").isin("S", "H"))
    return rows.select("cluster", "label", (F.col("kind") == "S").alias("is_seed"), "count")
