"""Field conversions: numbers, lists, flags, texts, headers, nested documents."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequences import as_column


def cluster_code(header: Column | str) -> Column:
    """Fields 4 to 7 of a ':'-split read header as a pairing code; '' without a trailing comment."""
    code = F.array_join(F.slice(F.split(as_column(header), ":"), 4, 4), ":")
    parts = F.split(F.regexp_replace(code, "[^0-9:]", "_"), "_")
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0))), "_")


def cluster_code_single(header: Column | str) -> Column:
    return F.substring_index(as_column(header), "_", 1)


def parse_shm(value: Column | str) -> Column:
    """``12.3456`` or ``7 (9)`` as a number rounded to 3; anything else is null."""
    return F.round(F.trim(F.substring_index(as_column(value), "(", 1)).try_cast("double"), 3)


def in_parentheses(value: Column | str) -> Column:
    """``12 (13)`` gives 13; a plain number stays."""
    c = as_column(value)
    got = F.regexp_extract(c, r"\(([^)]*)\)", 1)
    return F.when(got != "", got).otherwise(c)


def cdr_length(nt: Column | str) -> Column:
    return F.floor(F.length(as_column(nt)) / 3).cast("int")


def length_or_null(text: Column | str) -> Column:
    return F.nullif(F.length(as_column(text)), F.lit(0))


def shm_from_identity(identity: Column | str) -> Column:
    return 100 - as_column(identity).try_cast("double")


def shm_from_matches(text: Column | str) -> Column:
    """``a/b nt`` gives b - a."""
    p = F.split(F.substring_index(as_column(text), " ", 1), "/")
    return F.get(p, F.lit(1)).try_cast("int") - F.get(p, F.lit(0)).try_cast("int")


def percent_identity(matches: Column | str, length: Column | str) -> Column:
    return as_column(matches) / F.nullif(as_column(length), F.lit(0))


def percent_shm(mutations: Column | str, length: Column | str) -> Column:
    return F.round(100 * as_column(mutations) / F.nullif(as_column(length), F.lit(0)), 2)


def productivity(stop: Column, has_cdr3: Column, in_frame: Column, starts_at_fr1: Column) -> Column:
    """NO for a stop codon or a CDR3 out of frame, YES for a whole one from FR1 on, else MAYBE."""
    return F.when(stop, "NO").when(~has_cdr3, "MAYBE").when(in_frame & starts_at_fr1, "YES").when(in_frame, "MAYBE").otherwise("NO")


def cdr3_productive(nt: Column | str, aa: Column | str) -> Column:
    n = F.length(as_column(nt))
    return F.coalesce((n % 3 == 0) & (n >= 9) & ~as_column(aa).contains("*"), F.lit(False))


def to_percent(value: Column | str) -> Column:
    return F.round(as_column(value).try_cast("double"), 4)


def to_int(value: Column | str) -> Column:
    return as_column(value).try_cast("double").try_cast("int")


def to_list(value: Column | str, kind: str = "string") -> Column:
    """Split at commas, or at bars where there is no comma; elements that do not convert are null."""
    c = as_column(value)
    parts = F.when(c.contains(","), F.split(c, ",")).otherwise(F.split(c, r"\|"))
    return F.transform(parts, lambda x: F.trim(x).try_cast(kind))


def from_list(value: Column | str, sep: str = ",") -> Column:
    return F.array_join(F.transform(as_column(value), lambda x: x.cast("string")), sep)


def to_bool(value: Column | str) -> Column:
    c = F.lower(F.trim(as_column(value).cast("string")))
    return F.when(c.isin("yes", "true"), True).when(c.isin("no", "false"), False).otherwise(c.try_cast("int").cast("boolean"))


def index_text(value: Column | str) -> Column:
    """Lower case without white space and ``_ , ; - / :``."""
    return F.lower(F.regexp_replace(as_column(value), r"[\s_,;\-/:]", ""))


def word_list(value: Column | str, case: str | None = None, drop: tuple[str, ...] = ()) -> Column:
    """Comma list with trimmed elements; ``case`` is lower, upper or title; ``drop`` are words to remove."""
    f = {"lower": F.lower, "upper": F.upper, "title": F.initcap, None: lambda x: x}[case]

    def one(x: Column) -> Column:
        for w in drop:
            x = F.regexp_replace(x, rf"(?i)\b{w}\b", "")
        return f(F.trim(x))

    return F.filter(F.transform(F.split(as_column(value), ","), one), lambda x: x != "")


def null_if_empty(value: Column | str) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def default_quality(sequence: Column | str, quality: int = 30) -> Column:
    """The quality's character for each base."""
    s = as_column(sequence)
    return F.when(s.isNotNull(), F.rpad(F.lit(""), F.length(s), F.lit(chr(quality + 33))))


def short_date(value: Column | str) -> Column:
    return F.date_format(as_column(value), "MM/dd/yy")


def seq_exp_id(seq: Column | str, exp: Column | str) -> Column:
    return F.concat_ws("::", as_column(seq), as_column(exp))


def frame_range(low: float, high: float, step: float) -> Iterator[float]:
    """Cut-offs from ``low`` by ``step``, with ``high`` always last."""
    if step <= 0:
        raise ValueError("step must be positive")
    for i in range(max(0, math.ceil((high - low) / step - 1e-9))):
        yield round(low + i * step, 10)
    yield high


def leaf_paths(schema: T.StructType, prefix: str = "") -> list[str]:
    """Dotted paths of all fields that are no struct."""
    out = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        out += leaf_paths(f.dataType, f"{path}.") if isinstance(f.dataType, T.StructType) else [path]
    return out


def flatten(df: DataFrame, lift: str | None = None, lists: str | None = None) -> DataFrame:
    """One column for each leaf, named by its dotted path.

    ``lift`` drops that leading struct's name from paths; ``lists`` joins arrays
    of atoms by it.
    """
    columns = []
    for path in leaf_paths(df.schema):
        c = F.col(".".join(f"`{p}`" for p in path.split(".")))
        kind = df.select(c).schema[0].dataType
        if lists is not None and isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
            c = from_list(c, lists)
        name = path.removeprefix(f"{lift}.") if lift else path
        columns.append(c.alias(name))
    return df.select(*columns)


def nest(df: DataFrame) -> DataFrame:
    """The inverse of ``flatten``: dotted columns become structs."""

    def build(tree: dict) -> list[Column]:
        return [(F.struct(*build(v)) if isinstance(v, dict) else v).alias(k) for k, v in tree.items()]

    tree: dict = {}
    for name in df.columns:
        at = tree
        *parents, leaf = name.split(".")
        for p in parents:
            at = at.setdefault(p, {})
        at[leaf] = F.col(f"`{name}`")
    return df.select(*build(tree))
