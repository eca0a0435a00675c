"""Whole analyses of sequencing reads, composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .operators.alignments import parse_alignments
from .operators.annotate import merge_pairs, parse_clone_table, quality_filter, run_external, trim_reads
from .operators.cluster import greedy_clusters
from .operators.pairing import back_to_reads, dominance, run_pairing

def prepare_single(reads: DataFrame, least_quality: int = 20, percent: float = 50, min_length: int = 100) -> DataFrame:
    """Trimmed and filtered reads (header, sequence, quality)."""
    return quality_filter(trim_reads(reads, "sequence", "quality", min_length=min_length), "quality", least_quality, percent)


def prepare_paired(first: DataFrame, second: DataFrame, least_quality: int = 20, percent: float = 50, overlap: int = 10) -> DataFrame:
    """Stitched reads (header, sequence) of two files about the same fragments, matched by the header's first word."""
    key = F.substring_index("header", " ", 1)
    a, b = (quality_filter(x, "quality", least_quality, percent).withColumn("key", key) for x in (first, second))
    both = a.select("key", "header", F.col("sequence").alias("first")).join(b.select("key", F.col("sequence").alias("second")), "key")
    return merge_pairs(both, "first", "second", overlap).filter("merged is not null").select("header", F.col("merged").alias("sequence"))


def prepared(first: DataFrame, second: DataFrame | None = None, **settings) -> DataFrame:
    """(header, sequence) of single reads, or of pairs stitched together."""
    if second is None:
        return prepare_single(first, **settings).select("header", "sequence")
    return prepare_paired(first, second, **settings)


def aligner_pipeline(first: DataFrame, command: Sequence[str], fields: Sequence[str], second: DataFrame | None = None, parse: dict | None = None, **settings) -> DataFrame:
    """Reads through the main aligner to annotated rows.

    ``command`` is the aligner's on every worker, ``fields`` are the columns that
    it prints; ``parse`` holds settings of ``parse_alignments``, ``settings`` those
    of the preparation.
    """
    return parse_alignments(run_external(prepared(first, second, **settings), command, "header", "sequence", fields), **(parse or {}))


def clone_pipeline(first: DataFrame, command: Sequence[str], fields: Sequence[str], second: DataFrame | None = None, **settings) -> DataFrame:
    """Reads through a clone aligner, whose rows name reads by their headers, to the common layout; unaligned reads are kept."""
    reads = prepared(first, second, **settings)
    rows = run_external(reads, command, "header", "sequence", fields)
    return parse_clone_table(rows, reads.select(F.col("header").alias("read_id"), "header", "sequence"))


def pairing_rows(annotated: DataFrame) -> DataFrame:
    """The pairing analysis' input of rows of the annotation layout; rows with errors are left out."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    names = {"header": "Header", "cdr3_nt": "CDR3_Sequence.NT", "cdr3_aa": "CDR3_Sequence.AA", "vgene": "Top_V-Gene_Hits", "jgene": "Top_J-Gene_Hits", "shm": "VRegion.SHM.Per_nt"}
    return annotated.filter(text("Errors") == "").select(*[text(v).alias(k) for k, v in names.items()])


def aligned_pairing_pipeline(first: DataFrame, command: Sequence[str], fields: Sequence[str], second: DataFrame | None = None, parse: dict | None = None, identity: float = 0.96, at_least: int = 2, **settings) -> dict[str, DataFrame]:
    """Reads to annotated rows, to pairs, to clusters, and back to reads."""
    return pairing_pipeline(pairing_rows(aligner_pipeline(first, command, fields, second, parse, **settings)), identity, at_least)


def pairing_pipeline(rows: DataFrame, identity: float = 0.96, at_least: int = 2) -> dict[str, DataFrame]:
    """Pairing, clustering of heavy CDR3s of collapsed pairs seen ``at_least`` times, and the way back to reads."""
    out = run_pairing(rows)
    seen = out["collapsed"].filter(F.col("counts") >= at_least)
    members = greedy_clusters(seen, "heavy_cdr3_nt", "counts", identity)
    summary = dominance(members, "centroid", "heavy_cdr3_nt", "counts")
    clusters = members.join(summary.select("centroid", "dominance", "confidence"), "centroid").select("heavy_cdr3_nt", F.col("centroid").alias("cluster"), "dominance", "confidence")
    return out | {"members": members, "clusters": summary, "reads": back_to_reads(out["pairs"], out["collapsed"], clusters)}
