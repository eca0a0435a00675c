"""Filter documents compiled to Columns.

A filter document maps dotted field paths to values or operator documents, with
``$and``, ``$or``, ``$nor`` around them.  Equality on an array means that any
element is equal; ``$ne``, ``$nin`` and ``$not`` are true where the field is
null.  A missing field and a null one are the same.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class FilterError(ValueError):
    """A filter document that cannot be compiled."""


@dataclass(frozen=True)
class FieldRules:
    """Redirections of paths, and conversions of literals, by path without positions."""

    redirect: Mapping[str, str] = field(default_factory=dict)
    convert: Mapping[str, Callable[[Any], Any]] = field(default_factory=dict)

    def path(self, path: str) -> str:
        plain = without_positions(path)
        return self.redirect.get(plain, path)

    def literal(self, path: str, value: Any) -> Any:
        f = self.convert.get(without_positions(path))
        return value if f is None or value is None else f(value)


def without_positions(path: str) -> str:
    return ".".join(p for p in path.split(".") if not p.isdigit())


def resolve(schema: T.StructType, path: str) -> tuple[Column, T.DataType]:
    """The column at a dotted path and its type; arrays on the way are flattened, digits index."""
    column, kind = None, schema
    for part in path.split("."):
        if isinstance(kind, T.ArrayType) and part.isdigit():
            column, kind = F.get(column, F.lit(int(part))), kind.elementType
            continue
        if isinstance(kind, T.MapType):
            column, kind = F.try_element_at(column, F.lit(part)), kind.valueType
            continue
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
        if not isinstance(inner, T.StructType) or part not in inner.names:
            raise FilterError(f"no field {part!r} in path {path!r}")
        column = F.col(f"`{part}`") if column is None else column.getField(part)
        of = inner[part].dataType
        if isinstance(kind, T.ArrayType):
            if isinstance(of, T.ArrayType):
                column, kind = F.flatten(column), of
            else:
                kind = T.ArrayType(of)
        else:
            kind = of
    return column, kind


def compile_filter(doc: Mapping[str, Any], schema: T.StructType, rules: FieldRules | None = None) -> Column:
    """A boolean Column for a filter document; like false where it is null.

    Comparisons stay bare, so that they reach the scan.
    """
    rules = rules or FieldRules()
    terms = []
    for key, value in doc.items():
        if key in ("$and", "$or", "$nor"):
            if not isinstance(value, (list, tuple)) or not value:
                raise FilterError(f"{key} takes a list")
            parts = [compile_filter(d, schema, rules) for d in value]
            joined = reduce(lambda a, b: a & b if key == "$and" else a | b, parts)
            terms.append(_no(joined) if key == "$nor" else joined)
        elif key == "$comment":
            continue
        elif key.startswith("$"):
            raise FilterError(f"operator {key} is not supported")
        else:
            terms.append(_field(rules.path(key), key, value, schema, rules))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _field(path: str, given: str, value: Any, schema: T.StructType, rules: FieldRules) -> Column:
    try:
        column, kind = resolve(schema, path)
    except FilterError:
        if isinstance(value, Mapping) and list(value) == ["$exists"]:
            return F.lit(not value["$exists"])
        raise
    lit = lambda v: rules.literal(given, v)
    if not isinstance(value, Mapping):
        return _equals(column, kind, lit(value))
    if value and not all(k.startswith("$") for k in value):
        return column == F.struct(*[F.lit(v).alias(k) for k, v in value.items()])
    terms = []
    for op, x in value.items():
        terms.append(_operator(op, x, value, column, kind, lit, path, given, schema, rules))
    return reduce(lambda a, b: a & b, terms, F.lit(True))


def _any(column: Column, kind: T.DataType, test: Callable[[Column], Column]) -> Column:
    return F.exists(column, test) if isinstance(kind, T.ArrayType) else test(column)


def _no(test: Column) -> Column:
    return ~F.coalesce(test, F.lit(False))


def _equals(column: Column, kind: T.DataType, value: Any) -> Column:
    if value is None:
        return column.isNull()
    if isinstance(value, (list, tuple)):
        return column == F.array(*map(F.lit, value))
    return _any(column, kind, lambda c: c == F.lit(value))


_COMPARE = {"$gt": "__gt__", "$gte": "__ge__", "$lt": "__lt__", "$lte": "__le__"}
_TYPES = {"string": T.StringType, "int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "bool": T.BooleanType, "array": T.ArrayType, "object": T.StructType, "date": (T.DateType, T.TimestampType, T.TimestampNTZType), 1: T.DoubleType, 2: T.StringType, 3: T.StructType, 4: T.ArrayType, 8: T.BooleanType, 16: T.IntegerType, 18: T.LongType}


def _operator(op, x, whole, column, kind, lit, path, given, schema, rules) -> Column:
    if op == "$eq":
        return _equals(column, kind, lit(x))
    if op == "$ne":
        return _no(_equals(column, kind, lit(x)))
    if op in ("$in", "$nin"):
        values = [lit(v) for v in x]
        plain = [v for v in values if v is not None]
        found = _any(column, kind, lambda c: c.isin(plain)) if plain else F.lit(False)
        if len(plain) < len(values):
            found = column.isNull() | found
        return found if op == "$in" else _no(found)
    if op in _COMPARE:
        return _any(column, kind, lambda c: getattr(c, _COMPARE[op])(F.lit(lit(x))))
    if op == "$not":
        return _no(_field(path, given, x, schema, rules))
    if op == "$exists":
        return column.isNotNull() if x else column.isNull()
    if op == "$type":
        if x not in _TYPES:
            raise FilterError(f"unknown type {x!r}")
        return F.lit(isinstance(kind, _TYPES[x])) & column.isNotNull()
    if op == "$size":
        return F.size(column) == x if isinstance(kind, T.ArrayType) else F.lit(False)
    if op == "$mod":
        return _any(column, kind, lambda c: c.cast("long") % x[0] == x[1])
    if op == "$regex":
        flags = "".join(f for f in whole.get("$options", "") if f in "imsx")
        pattern = lit(x)
        return _any(column, kind, lambda c: c.rlike(f"(?{flags}){pattern}" if flags else pattern))
    if op == "$options":
        return F.lit(True)
    if op == "$all":
        return reduce(lambda a, b: a & b, [_equals(column, kind, lit(v)) for v in x], F.lit(True))
    if op == "$elemMatch":
        if not isinstance(kind, T.ArrayType) or any(not k.startswith("$") for k in x):
            raise FilterError("$elemMatch takes operators on an array of values")
        test = lambda c: reduce(lambda a, b: a & b, [_operator(o, v, x, c, kind.elementType, lit, path, given, schema, rules) for o, v in x.items()])
        return F.exists(column, test)
    raise FilterError(f"operator {op} is not supported")


def intersect_ids(lists: list[list], query: Any) -> list:
    """Ids in all lists, narrowed by ``$in``/``$eq`` or a value, or widened away by ``$nin``/``$ne``."""
    held = list(dict.fromkeys(lists[0])) if lists else []
    for other in lists[1:]:
        keep = set(other)
        held = [x for x in held if x in keep]
    if query is None:
        return held
    for op, x in (query if isinstance(query, Mapping) else {"$eq": query}).items():
        if op not in ("$in", "$eq", "$nin", "$ne"):
            raise FilterError(f"ids cannot be narrowed by {op}")
        named = set(x if op in ("$in", "$nin") else [x])
        held = [i for i in held if (i in named) == (op in ("$in", "$eq"))]
    return held
