"""Gene and allele names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import as_column

# Loci by recombination type.
VDJ_LOCI = ("TRB", "TB", "IGH", "TRD")
VJ_LOCI = ("IGK", "TRA", "TA", "IGL", "TRG")


def _gene_word(name: Column, allele: bool = False) -> Column:
    words = F.split(name, " ")
    word = F.when(F.size(words) == 1, name).otherwise(F.coalesce(F.get(F.filter(words, lambda w: w.contains("*") | w.contains("-")), F.lit(0)), F.lit("")))
    return word if allele else F.substring_index(word, "*", 1)


def gene_names(genes: Column | str) -> Column:
    """Each comma-separated entry without species and allele; null gives ''."""
    return F.coalesce(F.array_join(F.transform(F.split(as_column(genes), ","), lambda g: _gene_word(g)), ","), F.lit(""))


def first_gene(genes: Column | str, allele: bool = False) -> Column:
    """The first entry's gene, with its allele if asked for."""
    return F.coalesce(_gene_word(F.get(F.split(as_column(genes), ","), F.lit(0)), allele), F.lit(""))


def allele_words(genes: Column | str) -> Column:
    """Upper-cased name, its words, and the parts of the words before '*'; each once, sorted."""
    name = F.upper(as_column(genes))
    words = F.filter(F.split(name, r"[ ;,()\[\]]"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.concat(F.array(name), words, F.transform(words, lambda w: F.substring_index(w, "*", 1)))))


def allele_parts(genes: Column | str) -> Column:
    """Words split at '*' too."""
    return F.array_distinct(F.filter(F.split(F.upper(as_column(genes)), r"[ ;,()\[\]*]"), lambda w: w != ""))


def clean_gene_list(genes: Column | str) -> Column:
    c = F.replace(as_column(genes), F.lit(", or"), F.lit(","))
    c = F.replace(c, F.lit(" or "), F.lit(","))
    return F.trim(F.replace(c, F.lit("(see comment)"), F.lit("")))


def top_genes(genes: Column | str, scores: Column | str) -> Column:
    """Distinct leading genes while the score is not below the first; all, where scores are no list of numbers."""
    g = F.split(as_column(genes), ",")
    numbers = F.transform(F.split(as_column(scores), ","), lambda x: x.try_cast("double"))
    usable = F.coalesce((F.size(numbers) > 1) & ~F.exists(numbers, lambda x: x.isNull()), F.lit(False))
    # The first score below the top ends the list.
    lower = F.filter(F.transform(numbers, lambda x, i: F.when(x < numbers[0], i)), lambda i: i.isNotNull())
    n = F.coalesce(F.get(lower, F.lit(0)), F.size(numbers))
    picked = F.when(usable, F.slice(g, F.lit(1), F.greatest(n, F.lit(1)))).otherwise(g)
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(as_column(genes), F.lit("")) == "", none).otherwise(F.array_sort(F.array_distinct(picked)))


def split_by_top_score(genes: Column | str, scores: Column | str) -> Column:
    """Query index of a gene array: words of the genes with the greatest score, then of the others."""
    g, s = as_column(genes), as_column(scores)
    best = F.array_max(s)
    marked = F.transform(g, lambda x, i: F.struct(x.alias("g"), (F.get(s, i) == best).alias("top")))
    scored = F.coalesce(F.size(s) > 0, F.lit(False))
    words = lambda xs: F.array_sort(F.array_distinct(F.flatten(F.transform(xs, allele_words))))
    top = F.when(scored, F.transform(F.filter(marked, lambda x: F.coalesce(x["top"], F.lit(False))), lambda x: x["g"])).otherwise(g)
    rest = F.when(scored, F.transform(F.filter(marked, lambda x: ~F.coalesce(x["top"], F.lit(False))), lambda x: x["g"])).otherwise(F.array().cast("array<string>"))
    entries = F.array(F.struct(words(top).alias("PARSED_ALLELES")), F.struct(words(rest).alias("PARSED_ALLELES")))
    return F.when(F.size(g) > 0, F.when(F.size(rest) > 0, entries).otherwise(F.slice(entries, 1, 1)))


def _locus_type(gene: Column) -> Column:
    out = F.lit(None).cast("string")
    for n in (2, 3):
        p = F.substring(gene, 1, n)
        out = F.when(p.isin(*[x for x in VDJ_LOCI if len(x) == n]), "VDJ").when(p.isin(*[x for x in VJ_LOCI if len(x) == n]), "VJ").otherwise(out)
    return out


def recombination_type(v: Column | str, j: Column | str | None = None, unknown: str = "N/A") -> Column:
    """VDJ or VJ by the locus of the V gene, else of the J gene."""
    found = [_locus_type(F.upper(as_column(x))) for x in (v, j) if x is not None]
    return F.coalesce(*found, F.lit(unknown))


def recombination_of_isotype(isotype: Column | str) -> Column:
    i = F.upper(as_column(isotype))
    p = F.substring(i, 1, 3)
    return F.when(p.isin("IGK", "IGL", "TRA"), "VJ").when(F.substring(i, 1, 2).isin("IG", "TR"), "VDJ").otherwise("UNK")


def hit_list(hits: Column | str) -> Column:
    """``gene(score),...`` as an array of (gene, score)."""
    return F.transform(F.split(as_column(hits), ","), lambda h: F.struct(F.substring_index(h, "(", 1).alias("gene"), F.replace(F.get(F.split(h, r"\("), F.lit(1)), F.lit(")"), F.lit("")).try_cast("double").alias("score")))


def best_first(hits: Column | str) -> Column:
    """Hits by falling score; of equals the first in the list stays first, and those without a score are last."""
    marked = F.transform(as_column(hits), lambda h, i: F.struct(h.alias("h"), i.alias("i")))

    def order(a: Column, b: Column) -> Column:
        x, y = F.coalesce(a["h"]["score"], F.lit(float("-inf"))), F.coalesce(b["h"]["score"], F.lit(float("-inf")))
        return F.when(x > y, -1).when(x < y, 1).otherwise(a["i"] - b["i"])

    return F.transform(F.array_sort(marked, order), lambda m: m["h"])


def alignment_stats(alignment: Column | str) -> Column:
    """The first alignment's places and counts: germline start|end|length|query start|end|edits."""
    p = F.split(F.substring_index(as_column(alignment), ";", 1), r"\|")
    edits = F.get(p, F.lit(5))
    count = lambda c: (F.length(edits) - F.length(F.replace(edits, F.lit(c), F.lit("")))).cast("int")
    length = F.get(p, F.lit(2)).try_cast("int")
    return F.struct(
        F.get(p, F.lit(0)).try_cast("int").alias("germ_start"),
        F.get(p, F.lit(1)).try_cast("int").alias("germ_end"),
        F.get(p, F.lit(3)).try_cast("int").alias("query_start"),
        F.get(p, F.lit(4)).try_cast("int").alias("query_end"),
        length.alias("length"),
        count("S").alias("mismatches"),
        count("D").alias("deletions"),
        count("I").alias("insertions"),
        ((count("S") + count("D") + count("I")) / length).alias("shm"),
        edits.alias("edits"),
    )
