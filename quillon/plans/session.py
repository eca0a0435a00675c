"""Sessions: tables, a user, and queries that see only what the user may read."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.convert import flatten, index_text
from .filters import FieldRules, FilterError, compile_filter, resolve
from .pipeline import run_pipeline

RAW = "@SEQ"
IDS = ("_id", "SEQ_ID", "EXP_ID", "ANALYSIS_NAME", "RECOMBINATION_TYPE")
_upper = lambda v: v.upper() if isinstance(v, str) else v
_number = lambda v: float(v) if isinstance(v, str) else v
_whole = lambda v: int(float(v)) if isinstance(v, str) else v

#: Queries on the gene lists go to their parsed alleles; literals get the fields' types.
SEQS_RULES = FieldRules(
    redirect={f"DATA.{r}REGION.{r}GENES": f"QUERY_DATA.{r}REGION.{r}GENES.PARSED_ALLELES" for r in "VDJ"},
    convert={
        **{f"DATA.{r}REGION.{r}GENES": _upper for r in "VDJ"},
        **{f: _upper for f in ("DATA.CDR3.NT", "DATA.CDR3.AA", "DATA.SEQUENCE", "DATA.PRODUCTIVE", "DATA.LOCUS", "RECOMBINATION_TYPE", "ANALYSIS_NAME")},
        **{f"DATA.VREGION.SHM.{k}": _number for k in ("NT", "AA", "NT_PER", "AA_PER")},
        **{f"DATA.CDR3.{k}_LENGTH": _whole for k in ("NT", "AA")},
    },
)
_plain = lambda v: "".join(c for c in v.lower() if not c.isspace() and c not in "_,;-/:") if isinstance(v, str) else v
_duplicated = ("PROJECT_NAME", "EXPERIMENT_NAME", "SPECIES")
EXPS_RULES = FieldRules(
    redirect={f: f"DUPLICATED_FIELDS.{f}" for f in _duplicated},
    convert={**{f: _plain for f in _duplicated}, "SEQ_COUNT": lambda v: int(str(v).replace(",", "")), "CURATED": lambda v: v if isinstance(v, bool) else str(v).lower() in ("yes", "true", "1")},
)


@dataclass(frozen=True)
class Query:
    """An immutable, lazy query: each step returns a new one."""

    df: DataFrame
    base: DataFrame | None = None  # before limit and skip, for count
    rules: FieldRules | None = None

    def _next(self, df: DataFrame) -> Query:
        return replace(self, df=df, base=None)

    def where(self, doc: Mapping[str, Any]) -> Query:
        return self._next(self.df.filter(compile_filter(doc, self.df.schema, self.rules)))

    def project(self, fields: Mapping[str, int] | Sequence[str]) -> Query:
        return self._next(project(self.df, fields))

    def sort(self, keys: Sequence[tuple[str, int]]) -> Query:
        """Ascending (1) puts nulls first, descending (-1) last."""
        return self._next(self.df.orderBy(*[(lambda c: c.asc_nulls_first() if w == 1 else c.desc_nulls_last())(resolve(self.df.schema, k)[0]) for k, w in keys]))

    def limit(self, n: int) -> Query:
        return replace(self, df=self.df.limit(n), base=self.base or self.df) if n else self

    def skip(self, n: int) -> Query:
        return replace(self, df=self.df.offset(n), base=self.base or self.df) if n else self

    def count(self, with_limit_and_skip: bool = False) -> int:
        return (self.df if with_limit_and_skip or self.base is None else self.base).count()

    def distinct(self, path: str) -> DataFrame:
        """Distinct values of a field, array elements each on their own."""
        column, kind = resolve(self.df.schema, path)
        each = F.explode_outer(column) if kind.typeName() == "array" else column
        return self.df.select(each.alias("value")).filter("value is not null").distinct()

    def explain(self) -> str:
        return self.df._sc._jvm.PythonSQLUtils.explainString(self.df._jdf.queryExecution(), "formatted")

    def rows(self, chunk: int = 0, flat: bool = False, progress: Callable[[int], None] | None = None, every: int = 10) -> Iterator:
        """Rows one by one without collecting them, or lists of ``chunk`` rows.

        ``progress`` is told each further ``every`` percent of the rows; that needs a count first.
        """
        df = flatten(self.df) if flat else self.df
        total = df.count() if progress else 0
        told = 0
        held: list[Row] = []
        for i, row in enumerate(df.toLocalIterator(), 1):
            if progress and 100 * i // total // every > told:
                told = 100 * i // total // every
                progress(told * every)
            if not chunk:
                yield row
                continue
            held.append(row)
            if len(held) == chunk:
                yield held
                held = []
        if held:
            yield held

    def facets(self, fields: Sequence[str]) -> DataFrame:
        """(field, value, counts): how many rows have each value of the fields; elements of arrays each on their own."""
        entries = []
        for f in fields:
            column, kind = resolve(self.df.schema, f)
            values = F.array_distinct(column) if kind.typeName() == "array" else F.array(column)
            entries.append(F.transform(values, lambda v: F.struct(F.lit(f).alias("field"), v.cast("string").alias("value"))))
        each = self.df.select(F.explode(F.concat(*[F.coalesce(e, F.array()) for e in entries])).alias("x")).select("x.*")
        return each.filter("value is not null").groupBy("field", "value").agg(F.count("*").alias("counts"))

    def search(self, text: str, fields: Sequence[str]) -> Query:
        """Rows of which a field contains all words of ``text``, whatever their case."""
        words = text.lower().split()
        hit = F.lit(False)
        for f in fields:
            column = F.lower(resolve(self.df.schema, f)[0].cast("string"))
            found = F.lit(True)
            for w in words:
                found = found & column.contains(w)
            hit = hit | F.coalesce(found, F.lit(False))
        return self._next(self.df.filter(hit))


def project(df: DataFrame, fields: Mapping[str, int] | Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Inclusion (a path selects its sub-tree), or exclusion where all flags are 0; ``keep`` columns stay."""
    flags = fields if isinstance(fields, Mapping) else dict.fromkeys(fields, 1)
    if not flags:
        return df
    shown = [k for k, v in flags.items() if v]
    if shown:
        paths = [*(k for k in keep if k in df.columns and k not in shown), *shown]
        return df.select(*[resolve(df.schema, p)[0].alias(p) for p in paths])
    for path in flags:
        top, *rest = path.split(".")
        df = df.withColumn(top, F.col(top).dropFields(".".join(rest))) if rest else df.drop(path)
    return df


class Session:
    """Tables ``seqs`` and ``exps`` and the row of the user who asks."""

    def __init__(self, seqs: DataFrame, exps: DataFrame, user: Mapping[str, Any], raw: DataFrame | None = None):
        self.seqs, self.exps, self.user = seqs, exps, dict(user)
        self.raw = raw

    def readers(self) -> list[str]:
        return ["all", self.user["user"], *[f"lab_{x}" for x in self.user.get("lab") or ()]]

    def _may(self, column: str, names: Sequence[str]) -> Column:
        if self.user.get("administrator"):
            return F.lit(True)
        return F.coalesce(F.arrays_overlap(F.col(column), F.array(*map(F.lit, names))), F.lit(False))

    def readable(self) -> DataFrame:
        return self.exps.filter(self._may("READ_ACCESS", self.readers()))

    def owned(self) -> DataFrame:
        return self.exps.filter(F.array_contains("OWNERS_OF_EXPERIMENT", self.user["user"]))

    def writable(self) -> DataFrame:
        if not (self.user.get("write_access") or self.user.get("administrator")):
            return self.exps.limit(0)
        return self.exps.filter(self._may("OWNERS_OF_EXPERIMENT", [self.user["user"]]))

    def with_ownership(self) -> DataFrame:
        return self.readable().withColumn("OWNED", F.array_contains("OWNERS_OF_EXPERIMENT", self.user["user"]))

    def with_sequences(self) -> DataFrame:
        return self.readable().filter(F.col("SEQ_COUNT") > 0)

    def experiments(self, query: Mapping | None = None, exp_id: Any = None, fields: Mapping | Sequence = (), duplicated: bool = False) -> Query:
        df = self.readable()
        doc = dict(query or {})
        if exp_id is not None:
            doc["_id"] = exp_id if isinstance(exp_id, Mapping) else {"$in": [exp_id] if isinstance(exp_id, str) else list(exp_id)}
        df = df.filter(compile_filter(doc, df.schema, EXPS_RULES))
        df = project(df, fields, keep=("_id",)) if fields else df
        return Query(df if duplicated else df.drop("DUPLICATED_FIELDS"), rules=EXPS_RULES)

    def _visible(self, exps_query: Mapping | None, exp_id: Any) -> DataFrame:
        """Sequences of the experiments that the metadata query and the user's rights leave: a semi-join."""
        ids = self.experiments(exps_query, exp_id).df.select(F.col("_id").alias("EXP_ID"))
        return self.seqs.join(ids, "EXP_ID", "left_semi")

    def sequences(self, query: Mapping | None = None, exps_query: Mapping | None = None, exp_id: Any = None, analysis: str | Sequence[str] | None = None, recombination: str | Sequence[str] | None = None, fields: Mapping | Sequence = (), with_raw: bool = False, limit: int = 0) -> Query:
        """Annotated documents; raw reads only where they are asked for by name."""
        df = self._visible(exps_query, exp_id)
        doc = dict(query or {})
        for key, x in (("ANALYSIS_NAME", analysis), ("RECOMBINATION_TYPE", recombination)):
            if x is not None:
                doc[key] = {"$in": [x] if isinstance(x, str) else list(x)}
        if "ANALYSIS_NAME" not in doc:
            doc["ANALYSIS_NAME"] = {"$ne": RAW}
        df = df.filter(compile_filter(doc, df.schema, SEQS_RULES))
        if with_raw:
            raw = self.raw if self.raw is not None else self.seqs.filter(F.col("ANALYSIS_NAME") == RAW)
            df = df.join(raw.select("SEQ_ID", F.col("DATA").alias("RAW_DATA")), "SEQ_ID", "left")
        df = project(df, fields, keep=IDS) if fields else df
        return Query(df, rules=SEQS_RULES).limit(limit)

    def reads(self, analyses: Sequence[str] = (), exp_id: Any = None, same_document: bool = False, limit: int = 0) -> DataFrame:
        """Raw reads with their analyses: a row for each analysis, or one with a map by (analysis, recombination).

        ``limit`` counts reads.
        """
        seen = self._visible(None, exp_id)
        raw = seen.filter(F.col("ANALYSIS_NAME") == RAW).select("SEQ_ID", "EXP_ID", F.col("DATA").alias("RAW_DATA"))
        if limit:
            raw = raw.orderBy("SEQ_ID").limit(limit)
        rows = seen.filter(F.col("ANALYSIS_NAME").isin(*analyses) if analyses else F.col("ANALYSIS_NAME") != RAW)
        if not same_document:
            return raw.join(rows.drop("EXP_ID"), "SEQ_ID", "left")
        entry = F.struct(F.concat_ws(".", "ANALYSIS_NAME", "RECOMBINATION_TYPE").alias("key"), F.col("DATA").alias("value"))
        grouped = rows.groupBy("SEQ_ID").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("ANALYSES"))
        return raw.join(grouped, "SEQ_ID", "left")

    def aggregate(self, stages: Sequence[Mapping], exps_query: Mapping | None = None, exp_id: Any = None, initial_limit: int = 0) -> DataFrame:
        """A pipeline over what the user may read; ``initial_limit`` applies to its input after a first match."""
        df, stages = self._visible(exps_query, exp_id), list(stages)
        if stages and "$match" in stages[0]:
            df = run_pipeline(df, stages[:1], SEQS_RULES)
            stages = stages[1:]
        if initial_limit:
            df = df.limit(initial_limit)
        return run_pipeline(df, stages, SEQS_RULES)

    def distinct_metadata(self, fields: Sequence[str], open_fields: Sequence[str] = ()) -> DataFrame:
        """One row: the sorted distinct values of each field over curated experiments.

        ``open_fields`` are read from all curated experiments, whoever may read them.
        """
        curated = self.exps.filter(F.col("CURATED")).withColumn("_may", self._may("READ_ACCESS", self.readers()))
        out = []
        for f in fields:
            column, kind = resolve(curated.schema, f)
            shown = column if f in open_fields else F.when(F.col("_may"), column)
            values = F.array_distinct(F.flatten(F.collect_list(shown))) if kind.typeName() == "array" else F.collect_set(shown)
            out.append(F.array_sort(values).alias(f))
        return curated.agg(*out)


class Dispatcher:
    """Runs chains of named steps ``{command, args, kwargs}`` from an allow-list; no code is evaluated."""

    STEPS = ("where", "project", "sort", "limit", "skip", "count", "distinct")

    def __init__(self, session: Session):
        self.sources: dict[str, Callable] = {"sequences": session.sequences, "experiments": session.experiments}

    def run(self, steps: Sequence[Mapping]) -> Any:
        at: Any = None
        for i, step in enumerate(steps):
            name, args, kwargs = step["command"], step.get("args", ()), step.get("kwargs", {})
            if i == 0:
                if name not in self.sources:
                    raise FilterError(f"a chain starts with one of {sorted(self.sources)}")
                at = self.sources[name](*args, **kwargs)
            elif name in self.STEPS and isinstance(at, Query):
                at = getattr(at, name)(*args, **kwargs)
            else:
                raise FilterError(f"step {name!r} is not allowed here")
        return at


def with_duplicated_fields(exps: DataFrame) -> DataFrame:
    """Normalised copies of the searched metadata fields."""
    return exps.withColumn("DUPLICATED_FIELDS", F.struct(*[index_text(f).alias(f) for f in _duplicated]))
