"""Descriptive statistics: pivots, diversity, count thresholds, rank-abundance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .checkpoints import checkpointed

#: Count thresholds of the cumulative distribution.
THRESHOLDS = (1, 2, 8, 16, 50, 100, 500, 1000)


def count_table(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], total: str = "TOTAL") -> DataFrame:
    """Counts per key as one column for each of ``values``, and their total over all values."""
    cells = [F.count_if(F.col(column) == v).alias(str(v)) for v in values]
    return df.groupBy(*keys).agg(*cells, F.count("*").alias(total))


def frequencies(table: DataFrame, columns: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """Each of ``columns`` as its share of the column's sum within ``within``."""
    if within:
        sums = table.groupBy(*within).agg(*[F.sum(c).alias(f"_{c}") for c in columns])
        out = table.join(sums, list(within))
    else:
        out = table.withColumns({f"_{c}": table.agg(F.sum(c)).scalar() for c in columns})
    return out.withColumns({c: F.col(c) / F.nullif(F.col(f"_{c}"), F.lit(0)) for c in columns}).drop(*[f"_{c}" for c in columns])


def matrix(df: DataFrame, row: str, column: str, values: Sequence[str], value: str | None = None) -> DataFrame:
    """Counts, or sums of ``value``, with a column for each of ``values``; missing cells are 0."""
    n = F.col(value) if value else F.lit(1)
    return df.groupBy(row).agg(*[F.coalesce(F.sum(F.when(F.col(column) == v, n)), F.lit(0)).alias(str(v)) for v in values])


def diversity(df: DataFrame, item: str, by: Sequence[str] = (), count: str | None = None) -> DataFrame:
    """Richness, Shannon, Gini-Simpson and their effective numbers, over item counts per ``by``."""
    n = F.sum(count) if count else F.count("*")
    counts = df.groupBy(*by, item).agg(n.alias("_n"))
    sums = counts.groupBy(*by) if by else counts
    moments = sums.agg(
        F.count("*").alias("richness"),
        F.sum("_n").alias("_all"),
        F.sum(F.col("_n") * F.ln("_n")).alias("_nlogn"),
        F.sum(F.col("_n").cast("double") * F.col("_n")).alias("_sq"),
        F.count_if(F.col("_n") >= 2).alias("seen_twice"),
    )
    # With counts n of N: H = ln N - sum(n ln n) / N, and sum p^2 = sum n^2 / N^2, so one pass of mergeable sums is enough.
    total = F.col("_all").cast("double")
    shannon = F.ln(total) - F.col("_nlogn") / total
    simpson = F.col("_sq") / (total * total)
    return moments.select(*by, "richness", "seen_twice", shannon.alias("shannon"), F.exp(shannon).alias("shannon_effective"), (1 - simpson).alias("gini_simpson"), (1 / simpson).alias("simpson_effective"))


def count_cdf(counts: DataFrame, count: str, by: Sequence[str] = (), thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Share of rows whose count is at least each threshold, a row for each threshold."""
    shares = F.array(*[F.struct(F.lit(t).alias("threshold"), F.avg((F.col(count) >= t).cast("double")).alias("share")) for t in thresholds])
    grouped = counts.groupBy(*by) if by else counts
    return grouped.agg(shares.alias("_s")).select(*by, F.explode("_s").alias("_s")).select(*by, "_s.threshold", "_s.share")


def rank_abundance(counts: DataFrame, item: str, count: str, by: Sequence[str] = ()) -> DataFrame:
    """Items by falling count with rank, share and cumulative share.

    Without ``by`` there is one order over all items, which no single task may
    hold: the items are range-partitioned, ranked and summed in each partition,
    and moved on by the totals of the partitions before, of which there are as
    many as partitions.
    """
    if not by:
        return _global_rank_abundance(counts, item, count)
    part = Window.partitionBy(*by)
    order = part.orderBy(F.desc(count), item)
    run = order.rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(count).over(part)
    return counts.select(*by, item, count, F.row_number().over(order).cast("long").alias("rank"), (F.col(count) / total).alias("share"), (F.sum(count).over(run) / total).alias("cumulative"))


def _global_rank_abundance(counts: DataFrame, item: str, count: str) -> DataFrame:
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = checkpointed(counts.select(item, count).repartitionByRange(n, F.desc(count), item).withColumn("_p", F.spark_partition_id()))
    own = Window.partitionBy("_p").orderBy(F.desc(count), item)
    local = placed.withColumns({"_rank": F.row_number().over(own), "_sum": F.sum(count).over(own.rowsBetween(Window.unboundedPreceding, 0))})
    totals = placed.groupBy("_p").agg(F.count("*").alias("_n"), F.sum(count).alias("_t"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"), F.coalesce(F.sum("_t").over(before), F.lit(0)).alias("_t0"))
    all_ = totals.agg(F.sum("_t")).scalar()
    # As many rows as partitions.
    out = local.join(F.broadcast(offsets), "_p")
    return out.select(item, count, (F.col("_n0") + F.col("_rank")).cast("long").alias("rank"), (F.col(count) / all_).alias("share"), ((F.col("_t0") + F.col("_sum")) / all_).alias("cumulative"))


def length_stats(df: DataFrame, text: str, by: Sequence[str] = (), more_than: int = 2) -> DataFrame:
    """Mean and sample deviation of the lengths of distinct values longer than ``more_than``."""
    unique = df.select(*by, text).filter(F.length(text) > more_than).distinct()
    n = F.length(text)
    return unique.groupBy(*by).agg(F.count("*").alias("n_unique"), F.avg(n).alias("mean_length"), F.stddev_samp(n).alias("sd_length"))


def share_histogram(df: DataFrame, item: str) -> DataFrame:
    """Counts with their percentage of all rows, to one decimal."""
    counts = df.groupBy(item).agg(F.count("*").alias("counts"))
    return counts.withColumn("percent", F.round(100 * F.col("counts") / counts.agg(F.sum("counts")).scalar(), 1))


def unique_sequences(df: DataFrame, seq: str, experiment: str, values: Sequence, order: Sequence[str], attributes: Sequence[str] = ()) -> DataFrame:
    """Per sequence: the attributes of its first row, the total, and a count for each experiment."""
    first = F.struct(*order)
    return df.groupBy(seq).agg(*[F.min_by(a, first).alias(a) for a in attributes], F.count("*").alias("TOTAL"), *[F.count_if(F.col(experiment) == v).alias(str(v)) for v in values])


def file_funnel(df: DataFrame, by: str, **tests) -> DataFrame:
    """Rows per ``by`` and how many pass each named test."""
    return df.groupBy(by).agg(F.count("*").alias("sequences"), *[F.count_if(t).alias(n) for n, t in tests.items()])
