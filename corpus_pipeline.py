"""A corpus pipeline of five training-data operators, run stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet in the shared checkpoint folder and reads it again for
the next stage.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import bpe, decontaminate, language_id, line_dedup, simhash
from quillon.llm.common import discard, kept, table, temporary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in a language that was learned from the labelled ones among them."""
    return language_id.keep_identified(docs, language_id.train(docs.select("doc_id", "text", "lang")))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut long lines that three or more documents share out of all but one."""
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a passage of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and n_chars with the count, the ids and the digest of the decoded bytes."""

    def finish(ids, tokens):
        n, _, decoded = bpe.round_trip(ids, tokens)
        return n, ids.tobytes(), decoded

    return bpe.encode(docs, finish=finish, fields="n_tokens bigint, ids binary, decoded_sha256 string")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("bpe", encode),
]

#: Language identification and SimHash are not expressible in SQL; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before = docs
        with temporary():  # what a stage stages for itself goes when its result is written
            out = stage(spark, docs, sf_dir)
            docs = kept(out, name)
        discard(before)
    return docs
