"""Inserts, upserts and deletes of documents as DataFrame rewrites."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.convert import index_text
from ..functions.sequences import reverse_complement


class InvalidInsert(ValueError):
    """Rows or metadata that may not be written."""


def validate_experiment(exp: Mapping, required: Sequence[str], known_users: Sequence[str], existing: DataFrame) -> None:
    """Required fields, known owners, and a project/name that none of the owners has yet."""
    missing = [f for f in required if exp.get(f) in (None, "", [])]
    if missing:
        raise InvalidInsert(f"missing fields: {', '.join(missing)}")
    owners = list(exp["OWNERS_OF_EXPERIMENT"])
    if unknown := sorted(set(owners) - set(known_users)):
        raise InvalidInsert(f"unknown owners: {', '.join(unknown)}")
    same = existing.filter((F.col("PROJECT_NAME") == exp["PROJECT_NAME"]) & (F.col("EXPERIMENT_NAME") == exp["EXPERIMENT_NAME"]))
    if not same.filter(F.arrays_overlap("OWNERS_OF_EXPERIMENT", F.array(*map(F.lit, owners)))).isEmpty():
        raise InvalidInsert("an owner has an experiment of this project and name")


def experiment_document(exp: Mapping, user: Mapping, required: Sequence[str], known_users: Sequence[str], existing: DataFrame, created: str) -> dict:
    """A validated experiment with the fields that the store manages.

    Empty fields go; names lose ``, ; / \\``; searched texts get normalised
    copies, by which another experiment of an owner may not be equal; owners may
    read; the rest is who made it when, whether a curator did, and no sequences.
    """
    doc = {k: v for k, v in exp.items() if v not in (None, "", [])}
    for k in ("PROJECT_NAME", "EXPERIMENT_NAME"):
        if k in doc:
            doc[k] = re.sub(r"[,;/\\]", "", doc[k])
    plain = lambda v: re.sub(r"[\s_,;\-/:]", "", v).lower()
    names = ("PROJECT_NAME", "EXPERIMENT_NAME")
    alike = existing.withColumns({k: F.when(index_text(k) == plain(doc[k]), F.lit(doc[k])).otherwise(F.col(k)) for k in names if k in doc})
    validate_experiment(doc, required, known_users, alike)
    owners = list(doc["OWNERS_OF_EXPERIMENT"])
    doc["READ_ACCESS"] = sorted({*doc.get("READ_ACCESS", ()), *owners})
    doc["DUPLICATED_FIELDS"] = {k: plain(doc[k]) for k in (*names, "SPECIES") if isinstance(doc.get(k), str)}
    return doc | {"UPLOADED_BY": user["user"], "EXPERIMENT_CREATION_DATE": created, "CURATED": bool(user.get("curator")), "SEQ_COUNT": 0}


def read_key(header: Column, sequence: Column) -> Column:
    """The same for a read and its reverse complement."""
    s = F.upper(sequence)
    return F.concat_ws(".", header, F.least(s, reverse_complement(s)))


def group_reads(rows: DataFrame, header: str, sequence: str, analysis: str, keep: Sequence[str]) -> DataFrame:
    """One row for each read, with its analyses as a sorted array; a reverse-complemented copy is the same read."""
    entry = F.struct(F.col(analysis).alias("analysis"), *keep)
    return rows.groupBy(read_key(F.col(header), F.col(sequence)).alias("read_key")).agg(F.min_by(header, sequence).alias(header), F.min(sequence).alias(sequence), F.array_sort(F.collect_list(entry)).alias("analyses"))


def insert(target: DataFrame, new: DataFrame, experiment: str, append: bool = False) -> DataFrame:
    """``target`` with ``new``; unless ``append``, the experiments of ``new`` lose what they had."""
    if not append:
        target = target.join(new.select(experiment).distinct(), experiment, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def upsert(target: DataFrame, changes: DataFrame, keys: Sequence[str], replace: bool = False, unset: Sequence[str] = (), add_to_set: Sequence[str] = ()) -> DataFrame:
    """Rows of both by key.  A change replaces the row, or fills its non-null fields in.

    ``unset`` fields become null where a change has them empty; array fields in
    ``add_to_set`` are united.
    """
    renamed = changes.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in changes.columns if c not in keys], F.lit(True).alias("_changed"))
    joined = target.withColumn("_there", F.lit(True)).join(renamed, list(keys), "full_outer")
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
            continue
        new = F.col(f"_new_{c}") if c in changes.columns else F.lit(None)
        if c in add_to_set and c in changes.columns:
            none = F.array().cast(target.schema[c].dataType)
            merged = F.array_union(F.coalesce(F.col(c), none), F.coalesce(new, none))
        elif replace:
            merged = F.when(F.col("_changed"), new).otherwise(F.col(c))
        elif c in unset:
            merged = F.when(F.col("_changed") & new.isNull(), F.lit(None)).otherwise(F.coalesce(new, F.col(c)))
        else:
            merged = F.coalesce(new, F.col(c))
        out.append(merged.alias(c))
    return joined.select(*out)


def delete(target: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``target`` without the rows whose key is in ``ids``."""
    return target.join(ids.select(*keys).distinct(), list(keys), "left_anti")


def delete_owned(target: DataFrame, ids: DataFrame, experiment: str, exps: DataFrame, user: str) -> DataFrame:
    """As ``delete`` by experiment, only where the user owns the experiment."""
    owned = exps.filter(F.array_contains("OWNERS_OF_EXPERIMENT", user)).select(F.col("_id").alias(experiment))
    return delete(target, ids.join(owned, experiment, "left_semi"), [experiment])


def encode_strings(rows: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with small numbers for repeated strings, and the dictionary (key, number, value)."""
    words = rows.select(key, column).filter(F.col(column).isNotNull()).distinct()
    words = words.withColumn("number", F.row_number().over(Window.partitionBy(key).orderBy(column)) - 1)
    coded = rows.join(words, [key, column], "left").drop(column).withColumnRenamed("number", column)
    return coded, words.select(key, "number", F.col(column).alias("value"))


def load(target: DataFrame, rows: DataFrame, experiment: str, analysis: str, append: bool = False) -> tuple[DataFrame, DataFrame]:
    """``target`` with the rows of a file, and the documents of each experiment and analysis in the result.

    The counters are those that the experiments' metadata get.
    """
    if missing := {experiment, analysis} - set(rows.columns):
        raise InvalidInsert(f"the file has no column {', '.join(sorted(missing))}")
    out = insert(target, rows, experiment, append)
    loaded = out.join(rows.select(experiment).distinct(), experiment, "left_semi")
    return out, loaded.groupBy(experiment, analysis).agg(F.count("*").alias("counts"))
