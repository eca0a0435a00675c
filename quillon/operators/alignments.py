"""Rows of the main aligner's table parsed to the annotation layout.

An input row has the aligner's fields (positions from 0, regions as
``start::end``).  A row whose sequence, strand, alignment or chain is no result
keeps what identifies it and says why in Notes and Errors; the others get
regions, gaps, mutations, frames and productivity.  All of it is expressions,
except the search for FR4 (``functions.alignment``), which is done in batches
where a pattern is given.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.alignment import with_fr4
from ..functions.sequences import translate, valid_alphabet
from . import barcode

V_REGIONS = ("FR1", "CDR1", "FR2", "CDR2", "FR3")
REGIONS = (*V_REGIONS, "CDR3", "FR4")
# Chain and type of rearrangement by locus.
CHAINS = {
    "IGH": ("heavy", "VDJ"),
    "IGK": ("light", "VJ"),
    "IGL": ("light", "VJ"),
    "TRA": ("alpha", "VJ"),
    "TRB": ("beta", "VDJ"),
}
NUCLEOTIDES = "ACTGUKMRYSWBVHDXN"


def columns() -> list[str]:
    """The annotation layout's columns, in order."""
    spans = [f"{r}_Start::End" for r in V_REGIONS]
    listed = ",".join((*V_REGIONS, "CDR3"))
    return [
        *("Header", "SEQ_ID", "Sequence", "Quality_Score", "Document_Header", "Strand_Corrected_Sequence", "Notes", "Errors", "Command"),
        *("Recombination_Type", "Percent_Identity", "Alignment_Length", "Direction", "Locus", "Chain", "Codon_Start", "Query_Start", "Query_End", "Codon_Frame"),
        *("5_Prime_Annotation", "3_Prime_Annotation", "Stop_Codon", "CDR3_Junction_In_Frame", "Full_Length", "Productive"),
        *("Full_Length_Sequence.NT", "Full_Length_Sequence.AA", "Top_V-Gene_Hits", "V-Gene_Alignment_Scores", "Top_J-Gene_Hits", "J-Gene_Alignment_Scores"),
        *(f"{r}_Sequence.{k}" for k in ("NT", "AA") for r in REGIONS),
        *(f"{r}_Sequence.{k}.Gapped" for k in ("NT", "AA") for r in V_REGIONS),
        *("VRegion.SHM.NT", "VRegion.SHM.Per_nt", f"Reading_Frames: {','.join(REGIONS)}"),
        *(f"VGENE: Total_{k}" for k in ("Matches", "Mismatches", "Indel")),
        *("JRegion.SHM.NT", "JRegion.SHM.Per_nt"),
        *(f"JGENE: Total_{k}" for k in ("Matches", "Mismatches", "Indel")),
        *(f"VGENE_{k}: {listed}" for k in ("Matches", "Mismatches", "Indels")),
        *("VGENE: Query_Start", "VGENE: Query_End"),
        *(f"VGENE: Query_{s}" for s in spans),
        *("VGENE: Germline_Start", "VGENE: Germline_End", "JGENE: Query_Start", "JGENE: Query_End", "JGENE: Germline_Start", "JGENE: Germline_End"),
        *("VGENE: Alignment_Sequence_Query", "VGENE: Alignment_Sequence_Germline"),
        *(f"VGENE: Alignment_{s}" for s in spans),
        *("JGENE: Alignment_Sequence_Query", "JGENE: Alignment_Sequence_Germline"),
        *("Isotype", "Isotype mismatches", "Isotype percent similarity", "Isotype barcode direction"),
    ]


def _span(text: Column) -> tuple[Column, Column]:
    p = F.split(text, "::")
    return F.get(p, F.lit(0)).try_cast("int"), F.get(p, F.lit(1)).try_cast("int")


def _piece(text: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (from 0, both included); '' where a bound is missing."""
    return F.coalesce(F.substring(text, start + 1, end - start + 1), F.lit(""))


def _amino(nt: Column, frame: Column) -> Column:
    return F.when(frame > 0, translate(F.substring(nt, frame + 1, F.length(nt)))).otherwise(translate(nt))


def parse_alignments(
    rows: DataFrame,
    least_identity: float = 0.2,
    least_length: int = 50,
    insertions: str = "keep",
    fr4_pattern: str | None = None,
    isotypes: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """The annotation layout's columns (all there are, as texts or numbers) of an aligner's rows.

    ``insertions`` against the germline are kept, removed, or removed 'on_stop',
    only where the sequence has a stop codon.  With ``fr4_pattern`` the CDR3 and
    FR4 are found from the end of FR3 on; ``isotypes`` are barcodes to look for
    behind the annotated part.
    """
    if insertions not in ("keep", "remove", "on_stop"):
        raise ValueError(insertions)
    given = set(rows.columns)

    def c(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) if name in given else F.lit("")

    def number(name: str) -> Column:
        return c(name).try_cast("int")

    seq, strand = c("Sequence"), c("Strand_Corrected_Sequence")
    size = {g: F.when((c(f"{g}GENE: Query_Start") != "") & (c(f"{g}GENE: Query_End") != ""), number(f"{g}GENE: Query_End") - number(f"{g}GENE: Query_Start") + 1) for g in "VJ"}
    length = F.coalesce(size["V"], F.lit(0)) + F.coalesce(size["J"], F.lit(0))
    length = F.when(length <= 0, length + 1).otherwise(length)
    matches = reduce(lambda a, b: a + b, [F.when(size[g].isNotNull(), F.coalesce(number(f"{g}GENE: Total_Matches"), F.lit(0))).otherwise(0) for g in "VJ"])
    gene = lambda g: F.upper(F.get(F.split(F.get(F.split(c(f"Top_{g}-Gene_Hits"), ","), F.lit(0)), " "), F.lit(0)))
    short = {"VH": "IGH", "VK": "IGK", "VL": "IGL", "TA": "TRA", "TB": "TRB"}

    def locus_of(name: Column) -> Column:
        out = F.lit(None).cast("string")
        for k, v in {**short, **{x: x for x in CHAINS}}.items():
            out = F.when(name.startswith(k), v).otherwise(out)
        return out

    locus = F.when(c("Locus") != "", c("Locus")).otherwise(F.coalesce(locus_of(gene("V")), locus_of(gene("J")), F.lit("")))
    first_locus = F.get(F.split(locus, ","), F.lit(0))
    chain = F.lit("UNK")
    kind = F.lit("UNK")
    for k, (name, recombination) in CHAINS.items():
        chain = F.when(first_locus == k, name).otherwise(chain)
        kind = F.when(F.when(c("Chain") != "", F.lower(F.get(F.split(c("Chain"), ","), F.lit(0))) == name).otherwise(first_locus == k), recombination).otherwise(kind)
    chain = F.when(c("Chain") != "", c("Chain")).otherwise(chain)
    identity = matches / length.cast("double")
    failed = (
        F.when(seq == "", "Sequence not found")
        .when(~valid_alphabet(seq, NUCLEOTIDES), "Sequence contains unknown characters")
        .when(strand == "", c("Notes"))
        .when((identity < least_identity) | (length < least_length), F.concat(F.lit("Sequence results did not pass alignment filter settings after parsing output;"), c("Notes")))
        .when(kind == "UNK", "Chain type not recognized")
    )
    head, info = F.substring_index(c("Header"), " <", 1), c("Header")
    out = rows.select(
        "*",
        failed.alias("_failed"),
        identity.alias("_identity"),
        length.alias("_length"),
        locus.alias("_locus"),
        chain.alias("_chain"),
        kind.alias("_kind"),
        size["V"].alias("_v"),
        size["J"].alias("_j"),
        head.alias("_head"),
        info.alias("_info"),
    )

    # CDR3 and FR4
    fr3 = _span(c("VGENE: Query_FR3_Start::End"))
    if fr4_pattern:
        hit = F.struct(F.substring_index(c("JGENE: Alignment_Sequence_Query"), ";", 1).alias("query"), F.substring_index(c("JGENE: Alignment_Sequence_Germline"), ";", 1).alias("germline"), (number("JGENE: Query_Start") + 1).alias("start"))
        hits = F.when(F.col("_j").isNotNull(), F.array(hit)).otherwise(F.array().cast("array<struct<query:string,germline:string,start:int>>"))
        # The search reads four columns of its own; the table's are carried beside them in one struct.
        packed = out.select(F.struct("*").alias("_all"), strand.alias("sequence"), (fr3[1] + 2).alias("cdr3_start"), (number("Query_End") + 1).alias("end"), hits.alias("j_hits"))
        out = with_fr4(packed, fr4_pattern).select("_all.*", "cdr3_nt", "cdr3_aa", "cdr3_frame", "fr4_nt", "fr4_aa", "fr4_frame")
        found = {k: F.coalesce(F.col(k).cast("string"), F.lit("")) for k in ("cdr3_nt", "cdr3_aa", "fr4_nt", "fr4_aa")}
    else:
        found = {"cdr3_nt": c("CDR3_Sequence.NT"), "cdr3_aa": c("CDR3_Sequence.AA"), "fr4_nt": c("FR4_Sequence.NT"), "fr4_aa": c("FR4_Sequence.AA")}
        out = out.withColumns({"cdr3_frame": F.lit(None).cast("int"), "fr4_frame": F.lit(None).cast("int")})

    # Regions of the V gene
    five = c("5_Prime_Annotation")
    frame = F.coalesce(number("Codon_Start") - number("Query_Start"), F.lit(0))
    gaps = F.when(F.col("_v").isNotNull(), F.coalesce(number("VGENE: Total_Indel"), F.lit(0))).otherwise(0)
    indels = F.split(c("VGENE_Indels: FR1,CDR1,FR2,CDR2,FR3,CDR3"), ",")
    stop_before = _amino(c("Full_Length_Sequence.NT"), frame).contains("*")
    drop = {"keep": F.lit(False), "remove": F.lit(True), "on_stop": stop_before}[insertions]
    fields: dict[str, Column] = {}
    for i, r in enumerate(V_REGIONS):
        there = (~c(f"VGENE: Query_{r}_Start::End").isin("", "::")) & F.col("_v").isNotNull()
        offset = F.when(five == r, frame).otherwise(0)
        a, z = _span(c(f"VGENE: Alignment_{r}_Start::End"))
        query, germline = (_piece(c(f"VGENE: Alignment_Sequence_{x}"), a, z) for x in ("Query", "Germline"))
        gapped = there & (gaps > 0) & (F.coalesce(F.get(indels, F.lit(i)).try_cast("int"), F.lit(0)) > 0)
        pairs = F.slice(F.zip_with(F.split(query, ""), F.split(germline, ""), lambda q, g: F.struct(q.alias("q"), g.alias("g"))), offset + 1, F.length(query))
        inserted = F.size(F.filter(pairs, lambda p: p["g"] == "-"))
        cut = F.when(gapped & drop, inserted).otherwise(0)
        without = F.replace(F.array_join(F.transform(F.filter(pairs, lambda p: p["g"] != "-"), lambda p: p["q"]), ""), F.lit("-"), F.lit(""))
        fields |= {f"_{r}_there": there, f"_{r}_cut": cut, f"_{r}_nt": F.when(cut > 0, without).otherwise(c(f"{r}_Sequence.NT")), f"_{r}_gapped": F.when(gapped, F.replace(query, F.lit("-"), F.lit("n"))).otherwise("")}
        fields[f"_{r}_offset"] = offset
    out = out.withColumns({**fields, "_frame": frame, "_gaps": gaps, **{f"_{k}": v for k, v in found.items()}})
    total = lambda names: reduce(lambda a, b: a + b, names)
    n_cut = total([F.col(f"_{r}_cut") for r in V_REGIONS])
    last = F.lit(None).cast("int")
    for r in V_REGIONS:
        last = F.when(F.col(f"_{r}_there"), _span(c(f"VGENE: Query_{r}_Start::End"))[1] + 1).otherwise(last)
    rebuilt = F.concat(*[F.when(F.col(f"_{r}_there"), F.col(f"_{r}_nt")).otherwise("") for r in V_REGIONS], _piece(strand, last, number("Query_End")))
    no_v = F.col("_v").isNull()
    from_cdr3 = no_v & (F.col("_cdr3_nt") != "") if fr4_pattern else F.lit(False)
    whole = F.when(n_cut > 0, rebuilt).when(from_cdr3, F.concat("_cdr3_nt", "_fr4_nt")).otherwise(c("Full_Length_Sequence.NT"))
    out = out.withColumns({"_n_cut": n_cut, "_whole": whole, "_five": F.when(from_cdr3, "CDR3").otherwise(five)})
    out = out.withColumn("_whole_aa", _amino(F.col("_whole"), F.when(from_cdr3, 0).otherwise(F.col("_frame"))))

    # Frames: given ones, or counted on through regions where there are gaps
    old = F.split(c("VGENE_Reading_Frames: FR1,CDR1,FR2,CDR2,FR3,CDR3"), ",")
    frames, at = [], number("Codon_Start")
    for i, r in enumerate(V_REGIONS):
        there = F.col(f"_{r}_there")
        frames.append(F.when(there & (F.col("_gaps") > 0), (at % 3 + 1).cast("string")).otherwise(F.coalesce(F.get(old, F.lit(i)), F.lit(""))))
        at = at + F.when(there, F.length(F.col(f"_{r}_nt")) - F.col(f"_{r}_offset")).otherwise(0)
    for i, (name, start) in enumerate((("cdr3_frame", "cdr3"), ("fr4_frame", "fr4"))):
        moved = F.pmod(F.col(name) - 1 - F.col("_n_cut"), F.lit(3)) + 1
        frames.append(F.coalesce(moved.cast("string"), F.get(old, F.lit(5 + i)), F.lit("")))

    # Mutations, productivity, notes
    mutations = F.coalesce(number("VGENE: Total_Mismatches"), F.lit(0)) + F.col("_gaps") - F.col("_n_cut")
    # Twice the mismatches, without indels: results that these are compared with count so.
    j_mutations = 2 * F.coalesce(number("JGENE: Total_Mismatches"), F.lit(0))
    stop = F.col("_whole_aa").contains("*")
    has_cdr3 = F.col("_cdr3_aa") != ""
    in_frame = has_cdr3 & F.col("_whole_aa").contains(F.col("_cdr3_aa"))
    productive = F.when(stop, "NO").when(~has_cdr3, "MAYBE").when(in_frame, F.when(F.col("_five") == "FR1", "YES").otherwise("MAYBE")).otherwise("NO")
    cut_from = F.array_join(F.filter(F.array(*[F.when(F.col(f"_{r}_cut") > 0, r) for r in V_REGIONS]), lambda x: x.isNotNull()), ",")
    said = F.concat(
        F.when(F.col("_n_cut") > 0, F.concat(F.lit("Insertions have been removed from: "), cut_from, F.lit(";"))).otherwise(""),
        F.when(~stop & ~has_cdr3, "There are no stop codons in the sequence, but the CDR3 sequence could not be found;").when(~stop & ~in_frame, "The CDR3 is out-of-frame with respect to the translated sequence;").otherwise(""),
        c("Notes"),
    )
    good = F.col("_failed").isNull()
    made: dict[str, Column] = {
        "Header": F.col("_head"),
        "Document_Header": F.col("_info"),
        "Quality_Score": c("Sequence quality") if "Sequence quality" in given else c("Quality_Score"),
        "Notes": F.when(good, said).otherwise(F.col("_failed")),
        "Errors": F.when(good, c("Errors")).otherwise(F.col("_failed")),
        "Percent_Identity": F.when((seq != "") & (strand != ""), F.col("_identity")),
        "Alignment_Length": F.when((seq != "") & (strand != ""), F.col("_length")),
    }
    results: dict[str, Column] = {
        "Recombination_Type": F.col("_kind"),
        "Locus": F.col("_locus"),
        "Chain": F.col("_chain"),
        "5_Prime_Annotation": F.col("_five"),
        "Stop_Codon": stop,
        "CDR3_Junction_In_Frame": in_frame,
        "Full_Length": (F.col("_five") == "FR1") & (c("3_Prime_Annotation") == "FR4"),
        "Productive": productive,
        "Full_Length_Sequence.NT": F.col("_whole"),
        "Full_Length_Sequence.AA": F.col("_whole_aa"),
        "VRegion.SHM.NT": F.when(F.col("_v").isNotNull(), mutations),
        "VRegion.SHM.Per_nt": F.when(F.col("_v").isNotNull(), F.round(100 * mutations / F.col("_v"), 2)),
        "JRegion.SHM.NT": F.when(F.col("_j").isNotNull(), j_mutations),
        "JRegion.SHM.Per_nt": F.when(F.col("_j").isNotNull(), F.round(100 * j_mutations / F.col("_j"), 2)),
        f"Reading_Frames: {','.join(REGIONS)}": F.concat_ws(",", *frames),
        **{f"{r.upper()}_Sequence.{k.upper()}": F.col(f"_{r}_{k}") for r in ("cdr3", "fr4") for k in ("nt", "aa")},
    }
    for r in V_REGIONS:
        results[f"{r}_Sequence.NT"] = F.col(f"_{r}_nt")
        results[f"{r}_Sequence.AA"] = F.when(F.col(f"_{r}_there"), _amino(F.col(f"_{r}_nt"), F.col(f"_{r}_offset"))).otherwise("")
        results[f"{r}_Sequence.NT.Gapped"] = F.col(f"_{r}_gapped")
        results[f"{r}_Sequence.AA.Gapped"] = F.when(F.col(f"_{r}_gapped") != "", _amino(F.col(f"_{r}_gapped"), F.col(f"_{r}_offset"))).otherwise("")
    if isotypes:
        behind = F.when(good, F.substring(strand, F.greatest(number("Query_End") - 9, F.lit(1)), F.length(strand)))
        packed = out.select(F.struct("*").alias("_all"), behind.alias("_behind"))
        found_in = barcode.aligned(packed, "_behind", list(isotypes))
        out = found_in.select("_all.*", F.col("barcode").alias("_iso"), F.col("mismatches").alias("_iso_mismatches"), F.col("strand").alias("_iso_strand"))
        results |= {"Isotype": F.col("_iso"), "Isotype mismatches": F.col("_iso_mismatches"), "Isotype barcode direction": F.col("_iso_strand")}
    always = ("Sequence", "SEQ_ID", "Strand_Corrected_Sequence", "Locus", "5_Prime_Annotation", "3_Prime_Annotation")
    final = []
    for name in columns():
        if name in made:
            value = made[name]
        elif name in results:
            value = F.when(good, results[name])
            if name in always:
                value = F.when(good, results[name]).otherwise(c(name))
        else:
            value = c(name) if name in always else F.when(good, c(name))
        final.append(value.alias(name))
    return out.select(*final)
