"""Aggregation pipelines folded over a DataFrame.

Stages: ``$match``, ``$project``, ``$addFields``, ``$group``, ``$unwind``,
``$sort``, ``$skip``, ``$limit``, ``$count``.  Null group keys are kept,
``$unwind`` drops null and empty arrays, and ``$first``/``$last`` follow the
``$sort`` before the group where there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .filters import FieldRules, FilterError, compile_filter, resolve


def expression(x: Any, df: DataFrame) -> Column:
    """A pipeline expression: '$path', a literal, or an operator document."""
    if isinstance(x, str) and x.startswith("$"):
        return resolve(df.schema, x[1:])[0]
    if not isinstance(x, Mapping):
        return F.lit(x)
    if not x or not all(k.startswith("$") for k in x):
        return F.struct(*[expression(v, df).alias(k) for k, v in x.items()])
    (op, arg), *more = x.items()
    if more:
        raise FilterError("an expression has one operator")
    if op == "$literal":
        return F.lit(arg)
    args = [expression(a, df) for a in (arg if isinstance(arg, (list, tuple)) else [arg])]
    simple = {
        "$add": lambda a: reduce(lambda p, q: p + q, a),
        "$subtract": lambda a: a[0] - a[1],
        "$multiply": lambda a: reduce(lambda p, q: p * q, a),
        "$divide": lambda a: a[0] / a[1],
        "$mod": lambda a: a[0] % a[1],
        "$concat": lambda a: F.concat(*a),
        "$toUpper": lambda a: F.upper(a[0]),
        "$toLower": lambda a: F.lower(a[0]),
        "$size": lambda a: F.size(a[0]),
        "$arrayElemAt": lambda a: F.get(a[0], a[1]),
        "$ifNull": lambda a: F.coalesce(*a),
        "$cond": lambda a: F.when(a[0], a[1]).otherwise(a[2]),
        "$eq": lambda a: a[0].eqNullSafe(a[1]),
        "$ne": lambda a: ~a[0].eqNullSafe(a[1]),
        "$gt": lambda a: a[0] > a[1],
        "$gte": lambda a: a[0] >= a[1],
        "$lt": lambda a: a[0] < a[1],
        "$lte": lambda a: a[0] <= a[1],
        "$and": lambda a: reduce(lambda p, q: p & q, a),
        "$or": lambda a: reduce(lambda p, q: p | q, a),
        "$not": lambda a: ~a[0],
        "$strLenCP": lambda a: F.length(a[0]),
        "$substr": lambda a: F.substring(a[0], a[1] + 1, a[2]),
    }
    if op not in simple:
        raise FilterError(f"expression {op} is not supported")
    return simple[op](args)


_REGISTERED: dict[str, Callable[[Column], Column]] = {}


def register_accumulator(name: str, aggregate: Callable[[Column], Column]) -> None:
    """Let ``$group`` use ``aggregate``, a function of a Column to an aggregate Column, as ``name``."""
    if not name.startswith("$"):
        raise FilterError("an accumulator's name begins with $")
    _REGISTERED[name] = aggregate


def inverted(c: Column, kind: T.DataType) -> Column:
    """A value whose ascending order is the descending order of ``c``, nulls last."""
    if isinstance(kind, T.StringType):
        # Hex digits turned round; the end of a text comes after any further digit.
        value = F.concat(F.translate(F.hex(F.encode(c, "utf-8")), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~"))
    elif isinstance(kind, T.BooleanType):
        value = ~c
    elif isinstance(kind, T.DateType):
        value = -F.unix_date(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = -F.unix_micros(c.cast("timestamp"))
    elif isinstance(kind, T.NumericType):
        value = -c.cast("decimal(20,0)") if isinstance(kind, T.IntegralType) else -c
    else:
        raise FilterError(f"a sort by {kind.simpleString()} has one direction")
    return F.struct(c.isNull().alias("none"), value.alias("value"))


def _accumulate(doc: Mapping, df: DataFrame, order: Sequence[tuple[str, int]]) -> Column:
    (op, arg), = doc.items()
    c = expression(arg, df)
    if op in ("$first", "$last"):
        ways = {w for _, w in order}
        if not order:
            return F.first(c) if op == "$first" else F.last(c)
        if len(ways) == 1:
            keys = F.struct(*[resolve(df.schema, k)[0] for k, _ in order])
            return (F.min_by if (op == "$first") == (ways == {1}) else F.max_by)(c, keys)
        keys = F.struct(*[k if w == 1 else inverted(k, kind) for k, kind, w in ((*resolve(df.schema, k), w) for k, w in order)])
        return (F.min_by if op == "$first" else F.max_by)(c, keys)
    if op in _REGISTERED:
        return _REGISTERED[op](c)
    simple = {"$sum": F.sum, "$avg": F.avg, "$min": F.min, "$max": F.max, "$push": F.collect_list, "$addToSet": lambda x: F.array_sort(F.collect_set(x))}
    if op not in simple:
        raise FilterError(f"accumulator {op} is not supported")
    return simple[op](c)


def _project(df: DataFrame, doc: Mapping) -> DataFrame:
    shown = {k: v for k, v in doc.items() if not (isinstance(v, (int, bool)) and not v)}
    if not shown:
        return df.drop(*[k for k in doc if "." not in k])
    columns = []
    if "_id" in df.columns and doc.get("_id", 1) and "_id" not in shown:
        columns.append(F.col("_id"))
    for k, v in shown.items():
        c = resolve(df.schema, k)[0] if isinstance(v, (int, bool)) else expression(v, df)
        columns.append(c.alias(k))
    return df.select(*columns)


def run_pipeline(df: DataFrame, stages: Sequence[Mapping], rules: FieldRules | None = None) -> DataFrame:
    """The DataFrame after all stages; a document group key becomes the struct ``_id``."""
    order: list[tuple[str, int]] = []
    for stage in stages:
        (op, arg), *more = stage.items()
        if more:
            raise FilterError("a stage has one operator")
        if op == "$match":
            df = df.filter(compile_filter(arg, df.schema, rules))
        elif op == "$project":
            df = _project(df, arg)
        elif op == "$addFields":
            df = df.withColumns({k: expression(v, df) for k, v in arg.items()})
        elif op == "$unwind":
            path = (arg if isinstance(arg, str) else arg["path"]).removeprefix("$")
            top, *rest = path.split(".")
            each = F.explode(resolve(df.schema, path)[0])
            if rest:
                df = df.withColumn("_unwound", each).withColumn(top, F.col(top).withField(".".join(rest), F.col("_unwound"))).drop("_unwound")
            else:
                df = df.select(*[each.alias(c) if c == top else F.col(f"`{c}`") for c in df.columns])
        elif op == "$group":
            key = arg["_id"]
            aggs = [_accumulate(v, df, order).alias(k) for k, v in arg.items() if k != "_id"]
            by = expression(key, df) if key is not None else F.lit(None).cast("string")
            df = df.groupBy(by.alias("_id")).agg(*aggs) if aggs else df.select(by.alias("_id")).distinct()
            order = []
        elif op == "$sort":
            order = list(arg.items())
            df = df.orderBy(*[(lambda c: c.asc() if w == 1 else c.desc())(resolve(df.schema, k)[0]) for k, w in order])
        elif op == "$skip":
            df = df.offset(arg)
        elif op == "$limit":
            df = df.limit(arg)
        elif op == "$count":
            df = df.agg(F.count("*").alias(arg))
        else:
            raise FilterError(f"stage {op} is not supported")
    return df
