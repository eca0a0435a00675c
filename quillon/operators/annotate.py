"""Annotated rows: quality filters, regions, and tables of external aligners parsed to one layout."""

from __future__ import annotations

import subprocess
import tempfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.convert import shm_from_matches
from ..functions.genes import alignment_stats, hit_list, recombination_type
from ..functions.sequences import as_column, reverse_complement, strand, valid_nucleotides
from .pairing import reject_reason

REGIONS = ("FR1", "CDR1", "FR2", "CDR2", "FR3", "CDR3", "FR4")


def alignment_error(identity: Column | str, length: Column | str, sequence: Column | str, least_identity: float = 0.2, least_length: int = 50) -> Column:
    """Why an alignment is no result, or null."""
    return F.when(~valid_nucleotides(sequence), "illegal characters").when(F.coalesce(as_column(identity) < least_identity, F.lit(True)), "low identity").when(F.coalesce(as_column(length) < least_length, F.lit(True)), "short alignment")


def join_regions(regions: Sequence[str] = REGIONS, suffix: str = "") -> dict[str, Column]:
    """Joined sequence, first and last region present, whether an inner one is missing, whether it is full length."""
    have = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("name"), F.coalesce(F.col(f"`{r}{suffix}`"), F.lit("")).alias("s")) for i, r in enumerate(regions)])
    there = F.filter(have, lambda x: x["s"] != "")
    first, last = F.get(there, F.lit(0)), F.get(there, F.size(there) - 1)
    return {
        "sequence": F.array_join(F.transform(there, lambda x: x["s"]), ""),
        "five_prime": first["name"],
        "three_prime": last["name"],
        "gap": F.coalesce(F.size(there) < last["i"] - first["i"] + 1, F.lit(False)),
        "full_length": F.coalesce((first["i"] == 0) & (last["i"] == len(regions) - 1) & (F.size(there) == len(regions)), F.lit(False)),
    }


def parse_clone_table(rows: DataFrame, reads: DataFrame | None = None) -> DataFrame:
    """A clone aligner's table (All V/D/J hits, alignments, region sequences) in the common layout.

    ``reads(read_id, header, sequence)`` are kept even where the aligner has no row for them.
    """
    out = rows
    for g in "VDJ":
        hits = hit_list(f"All {g} hits")
        out = out.withColumns({f"{g}_genes": F.transform(hits, lambda h: h["gene"]), f"{g}_scores": F.transform(hits, lambda h: h["score"])})
        if f"All {g} alignments" in rows.columns:
            out = out.withColumn(f"{g}_alignment", alignment_stats(f"All {g} alignments"))
    top = lambda g: F.get(F.col(f"{g}_genes"), F.lit(0))
    out = out.withColumns({"locus": F.substring(top("V"), 1, 3), "recombination": recombination_type(top("V"), top("J"), "UNK")})
    if reads is None:
        return out
    joined = reads.join(out, reads["read_id"] == out["Read id"], "left").drop("Read id")
    note = F.when(F.col("V_genes").isNull() & F.col("J_genes").isNull(), "no alignment")
    joined = joined.withColumn("note", note)
    if "Read sequence" in rows.columns:
        joined = joined.withColumn("strand", strand("Read sequence", "sequence"))
    return joined


def parse_igblast_block(lines: Column) -> dict[str, Column]:
    """Fields of one report block: query, rearrangement, junction, regions, and the hit table's rows by gene.

    The junction is (v_end, v_d, d, d_j, j_start) of a VDJ rearrangement, (v_end,
    v_j, j_start) of a VJ one; N/A is null.  Regions are those of the alignment
    summary, the total included.
    """
    row = lambda i: F.split(F.get(lines, i), "\t")
    at = F.array_position(F.transform(lines, lambda x: x.startswith("# V-(D)-J rearrangement summary")), True)
    summary = F.when(at > 0, row(at.cast("int")))
    n = F.size(summary)
    hits = F.filter(lines, lambda x: x.rlike(r"^[VDJ]\t"))
    by = lambda g: F.transform(F.filter(hits, lambda x: x.startswith(g)), lambda x: F.struct(F.get(F.split(x, "\t"), F.lit(2)).alias("gene"), F.get(F.split(x, "\t"), F.lit(3)).try_cast("double").alias("identity"), F.get(F.split(x, "\t"), F.lit(4)).try_cast("int").alias("length"), F.get(F.split(x, "\t"), F.lit(5)).try_cast("int").alias("mismatches"), F.get(F.split(x, "\t"), F.lit(7)).try_cast("int").alias("gaps")))
    query = F.get(F.filter(lines, lambda x: x.startswith("# Query:")), F.lit(0))
    section = lambda title: F.array_position(F.transform(lines, lambda x: x.startswith(title)), True)
    value = lambda c: F.nullif(F.trim(c), F.lit("N/A"))
    j_at, r_at = section("# V-(D)-J junction details"), section("# Alignment summary between query and top germline")
    junction = F.when(j_at > 0, row(j_at.cast("int")))
    j = lambda i: value(F.get(junction, F.lit(i)))
    long = F.size(F.filter(junction, lambda x: x != "")) == 5
    rest = F.when(r_at > 0, F.slice(lines, (r_at + 1).cast("int"), F.size(lines)))
    stop = F.array_position(F.transform(rest, lambda x: x.startswith("#") | (F.trim(x) == "")), True)
    rows = F.when(stop > 0, F.slice(rest, F.lit(1), F.greatest(stop - 1, F.lit(0)).cast("int"))).otherwise(rest)
    names = ("start", "stop", "length", "matches", "mismatches", "gaps")
    cell = lambda x, i: value(F.get(F.split(x, "\t"), F.lit(i)))
    regions = F.transform(rows, lambda x: F.struct(cell(x, 0).alias("region"), *[cell(x, i + 1).try_cast("int").alias(n) for i, n in enumerate(names)], cell(x, 7).try_cast("double").alias("identity")))
    # Seven fields are a VJ rearrangement, eight a VDJ one.
    return {
        "junction": F.struct(
            j(0).alias("v_end"),
            F.when(long, j(1)).alias("v_d"),
            F.when(long, j(2)).alias("d"),
            F.when(long, j(3)).alias("d_j"),
            F.when(~long, j(1)).alias("v_j"),
            F.when(long, j(4)).otherwise(j(2)).alias("j_start"),
        ),
        "regions": F.filter(regions, lambda r: r["region"] != "Total"),
        "total": F.get(F.filter(regions, lambda r: r["region"] == "Total"), F.lit(0)),
        "header": F.trim(F.replace(query, F.lit("# Query:"), F.lit(""))),
        "recombination": F.when(n == 7, "VJ").when(n == 8, "VDJ"),
        "productive": F.upper(F.get(summary, n - 2)),
        "strand": F.get(summary, n - 1),
        "v_hits": by("V"),
        "d_hits": by("D"),
        "j_hits": by("J"),
    }


def join_reports(reads: DataFrame, report: DataFrame) -> DataFrame:
    """Reads with their report by header without spaces; reads without one get a note."""
    key = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    out = reads.withColumn("_k", key(F.col("header"))).join(report.withColumn("_k", key(F.col("header"))).drop("header").withColumn("_there", F.lit(True)), "_k", "left")
    return out.withColumn("note", F.when(F.col("_there").isNull(), "no report")).drop("_k", "_there")


def quality_filter(reads: DataFrame, quality: str, least: int, percent: float, offset: int = 33) -> DataFrame:
    """Reads with at least ``percent`` of their bases at quality ``least`` or better."""
    good = F.length(F.regexp_replace(F.col(quality), f"[^\\x{{{least + offset:x}}}-\\x{{7e}}]", ""))
    return reads.filter(100 * good >= percent * F.length(quality))


def trim_reads(reads: DataFrame, sequence: str, quality: str, window: int = 4, least: float = 15, min_length: int = 36, offset: int = 33) -> DataFrame:
    """Cut each read where the mean quality of a sliding window drops below ``least``; short reads go."""
    q = F.transform(F.split(F.col(quality), ""), lambda c: F.ascii(c) - offset)
    n = F.length(quality)
    starts = F.sequence(F.lit(0), F.greatest(n - window, F.lit(0)))
    low = F.filter(starts, lambda i: F.aggregate(F.slice(F.col("_q"), i + 1, F.lit(window)), F.lit(0), lambda a, x: a + x) < F.lit(least * window))
    cut = F.coalesce(F.get(low, F.lit(0)), n)
    out = reads.withColumn("_q", q).withColumn("_cut", cut)
    out = out.withColumns({sequence: F.substring(sequence, F.lit(1), F.col("_cut")), quality: F.substring(quality, F.lit(1), F.col("_cut"))})
    return out.filter(F.length(sequence) >= min_length).drop("_q", "_cut")


def merge_pairs(pairs: DataFrame, first: str, second: str, least: int = 10, most_mismatch: float = 0.1) -> DataFrame:
    """Stitch each pair at its longest overlap of at least ``least`` bases within the mismatch rate; null where none fits."""
    n = F.least(F.length(first), F.length(second))
    out = pairs.withColumn("_b", reverse_complement(second))
    out = out.withColumns({"_x": F.split(F.col(first), ""), "_y": F.split("_b", "")})
    unlike = lambda k: F.zip_with(F.slice("_x", F.size("_x") - k + 1, k), F.slice("_y", F.lit(1), k), lambda x, y: (x != y).cast("int"))
    misses = lambda k: F.aggregate(unlike(k), F.lit(0), lambda s, x: s + x)
    # From the longest overlap down; none is compared once one fits.
    longest = F.aggregate(F.sequence(n, F.lit(least), F.lit(-1)), F.lit(None).cast("int"), lambda found, k: F.when(found.isNotNull(), found).when(misses(k) <= F.floor(k * most_mismatch), k))
    out = out.withColumn("overlap", F.when(n >= least, longest))
    return out.withColumn("merged", F.concat(F.col(first), F.substring("_b", F.col("overlap") + 1, F.length("_b")))).drop("_b", "_x", "_y")


def imgt_mutations(rows: DataFrame) -> DataFrame:
    """``rows`` of joined tables with mutation counts and percentages of the V and the J region."""
    number = lambda c: F.trim(F.substring_index(F.when(F.trim(c) == "-", "0").otherwise(c), "(", 1)).try_cast("double")
    have = set(rows.columns)

    def of(name: str) -> Column:
        return F.col(f"`{name}`") if name in have else F.lit(None).cast("string")

    aa, changes = (number(of(f"V-REGION Nb of AA{x}_9")) - number(of(f"CDR3-IMGT Nb of AA{x}_9")) for x in ("", " changes"))
    return rows.withColumns(
        {
            **{f"{r}_shm_percent": 100 - of(f"{r}-REGION identity %_1").try_cast("double") for r in "VJ"},
            **{f"{r}_shm": shm_from_matches(of(f"{r}-REGION identity nt_1")) for r in "VJ"},
            "V_shm_aa": changes,
            "V_shm_aa_percent": F.round(100 * changes / F.nullif(aa, F.lit(0.0)), 4),
        }
    )


def filter_reference_rows(df: DataFrame, cdrs: Sequence[str], alphabet: str = "ACDEFGHIKLMNPQRSTVWY") -> tuple[DataFrame, DataFrame]:
    """Rows fit for a protein reference (ABSEQ, CDRs, VGENES, JGENES), and the count of each reason against the others."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    missing, shifted = F.lit(False), F.lit(False)
    for c in cdrs:
        missing = missing | (text(c) == "")
        shifted = shifted | ~text("ABSEQ").contains(text(c))
    rules = [
        ("missing_seq", text("ABSEQ") == ""),
        ("has_stop_codons", text("ABSEQ").contains("*")),
        ("unk_chars", text("ABSEQ").rlike(f"[^{alphabet}]")),
        ("missing_cdr", missing),
        ("cdr_not_in_frame", shifted),
        ("unk_recomb", recombination_type("VGENES", "JGENES", "UNK") == "UNK"),
    ]
    marked = df.withColumn("reject", reject_reason(rules)).withColumn("RECOMBINATIONTYPE", recombination_type("VGENES", "JGENES", "UNK"))
    counts = marked.groupBy(F.coalesce("reject", F.lit("passed")).alias("reason")).agg(F.count("*").alias("counts"))
    return marked.filter("reject is null").drop("reject"), counts


def run_external(reads: DataFrame, command: Sequence[str], header: str, sequence: str, columns: Sequence[str], timeout: int = 3600) -> DataFrame:
    """Rows that an aligner on every worker makes of the reads: ``columns`` of its tab-separated output.

    ``command`` gets the place of a FASTA file with a batch of reads as its last
    argument and prints the table.  The file is the task's own and goes with it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            with tempfile.NamedTemporaryFile("w", suffix=".fasta") as f:
                f.writelines(f">{h}\n{s}\n" for h, s in zip(b[header], b[sequence]) if s)
                f.flush()
                out = subprocess.run([*command, f.name], capture_output=True, text=True, timeout=timeout, check=True).stdout
            rows = [(line.split("\t") + [""] * len(columns))[: len(columns)] for line in out.splitlines() if line.strip() and line[0] != "#"]
            yield pd.DataFrame(rows, columns=list(columns))

    return reads.select(header, sequence).mapInPandas(run, ", ".join(f"`{c}` string" for c in columns))
