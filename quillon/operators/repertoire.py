"""Gene usage, distinct values, unique counts and length distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import as_column


def usage(df: DataFrame, genes: Column | str, by: Sequence[str] = (), first_only: bool = True, name: str = "gene", limit: int = 0, where: Column | None = None) -> DataFrame:
    """Documents per gene of an array column, and per ``by``.

    ``first_only`` counts the first gene of a document, otherwise each gene.
    Null or empty arrays drop out.  ``limit`` bounds the documents read, after
    ``where``.
    """
    df = df if where is None else df.filter(where)
    df = df.limit(limit) if limit else df
    g = as_column(genes)
    rows = df.select(*by, F.get(g, F.lit(0)).alias(name)).filter(F.size(g) > 0) if first_only else df.select(*by, F.explode(g).alias(name))
    return rows.groupBy(name, *by).agg(F.count("*").alias("counts"))


def pair_usage(df: DataFrame, left: Column | str, right: Column | str, by: Sequence[str] = (), first_only: bool = True, names: tuple[str, str] = ("vgene", "jgene")) -> DataFrame:
    """Documents per pair of genes: the first of each list, or all combinations in a document."""
    v, j = as_column(left), as_column(right)
    if first_only:
        rows = df.filter((F.size(v) > 0) & (F.size(j) > 0)).select(*by, F.get(v, F.lit(0)).alias(names[0]), F.get(j, F.lit(0)).alias(names[1]))
    else:
        rows = df.select(*by, F.explode(v).alias(names[0]), j.alias("_j")).select(*by, names[0], F.explode("_j").alias(names[1]))
    return rows.groupBy(*names, *by).agg(F.count("*").alias("counts"))


def distinct_with_sets(df: DataFrame, field: str, of: str, skip: int = 0, limit: int = 0) -> DataFrame:
    """Each non-null value of ``field`` with the sorted set of ``of`` it occurs with."""
    df = df.offset(skip) if skip else df
    df = df.limit(limit) if limit else df
    return df.filter(F.col(field).isNotNull()).groupBy(field).agg(F.array_sort(F.collect_set(of)).alias(f"{of}_set"))


def count_unique(df: DataFrame, group_by: Sequence[str], include: Sequence[str] = (), order: Sequence[str] = (), more_than: int = 0, sort: bool = False, limit: int = 0) -> DataFrame:
    """COUNTS per group, with the first value (by ``order``) of the ``include`` fields.

    Groups of ``more_than`` rows or fewer are dropped; ``limit`` bounds the input.
    """
    df = df.limit(limit) if limit else df
    key = F.struct(*order) if order else None
    firsts = [(F.min_by(c, key) if key is not None else F.first(c)).alias(c) for c in include]
    out = df.groupBy(*group_by).agg(F.count("*").alias("COUNTS"), *firsts)
    out = out.filter(F.col("COUNTS") > more_than) if more_than else out
    return out.orderBy(F.desc("COUNTS"), *group_by) if sort else out


def length_distribution(df: DataFrame, length: Column | str, by: Sequence[str] = (), multiple_of_three: bool = False, at_least: int = 1) -> DataFrame:
    """Documents per length; lengths below ``at_least`` and nulls drop out."""
    rows = df.select(*by, as_column(length).alias("length")).filter(F.col("length") >= at_least)
    rows = rows.filter("length % 3 = 0") if multiple_of_three else rows
    return rows.groupBy("length", *by).agg(F.count("*").alias("counts"))


def schema_profile(df: DataFrame, analysis: str, fields: Sequence[str]) -> DataFrame:
    """For each field with a value: the analyses that have it, and its type."""
    kinds = dict(df.dtypes)
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(kinds[f]).alias("datatype"), F.col(f).isNotNull().alias("there")) for f in fields]))
    rows = df.select(F.col(analysis).alias("analysis"), each.alias("x")).filter("x.there").select("analysis", "x.field", "x.datatype")
    return rows.groupBy("field", "datatype").agg(F.array_sort(F.collect_set("analysis")).alias("analyses"))


def analysis_counters(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("counts"))


def sum_by_value(df: DataFrame, value: str, count: str | None = None) -> DataFrame:
    """Each value with the sum of its counts; a missing count is 1."""
    n = F.coalesce(F.col(count), F.lit(1)) if count else F.lit(1)
    return df.groupBy(value).agg(F.sum(n.cast("long")).alias("counts"))
