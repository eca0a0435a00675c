"""Nucleotide and amino-acid functions as Column expressions."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

# Complement of each IUPAC nucleotide code.
_FROM = "ACGTRYSWKMBDHVN"
_TO = "TGCAYRSWMKVHDBN"

# The standard genetic code, codons in the order T, C, A, G.
_AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): a for c, a in zip(product("TCAG", repeat=3), _AMINO)}


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reverse_complement(seq: Column | str) -> Column:
    """Reversed complement; characters that are no code become N, or n if their code point is 91 or more."""
    known = _FROM + _FROM.lower()
    c = as_column(seq)
    clean = F.regexp_replace(c, f"[^{known}\\x{{5b}}-\\x{{10ffff}}]", "N")
    clean = F.regexp_replace(clean, f"[^{known}]", "n")
    # Most texts hold codes alone and need no pattern.
    clean = F.when(F.translate(c, known, "") == "", c).otherwise(clean)
    return F.reverse(F.translate(clean, known, _TO + _TO.lower()))


def translate(seq: Column | str, frame: int = 0, pad: bool = False) -> Column:
    """Amino acids of whole codons from ``frame`` on; unknown codons are X, stops are *.

    ``pad`` completes the last codon with N instead of dropping it.
    """
    s = F.upper(F.substring(as_column(seq), frame + 1, 1 << 30))
    s = F.translate(s, "U", "T")
    if pad:
        s = F.when(F.length(s) % 3 == 0, s).otherwise(F.rpad(s, (F.length(s) + 3 - F.length(s) % 3).cast("int"), F.lit("N")))
    table = F.create_map(*[F.lit(x) for pair in CODONS.items() for x in pair])
    n = F.floor(F.length(s) / 3).cast("int")
    codons = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.coalesce(F.try_element_at(table, F.substring(s, i * 3 + 1, F.lit(3))), F.lit("X")))
    return F.when(s.isNotNull(), F.when(n > 0, F.array_join(codons, "")).otherwise(F.lit("")))


def hamming(a: Column | str, b: Column | str) -> Column:
    """Differing positions over the shorter length, and the rest of the longer one."""
    a, b = as_column(a), as_column(b)
    n = F.least(F.length(a), F.length(b))
    same = F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: (F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(n > 0, same).otherwise(0) + F.abs(F.length(a) - F.length(b))


def valid_alphabet(seq: Column | str, letters: str) -> Column:
    """Whether all characters, upper-cased, are among ``letters``."""
    return F.coalesce(~F.upper(as_column(seq)).rlike(f"[^{letters}]"), F.lit(False))


def valid_nucleotides(seq: Column | str) -> Column:
    return valid_alphabet(seq, _FROM + "U")


def valid_amino_acids(seq: Column | str) -> Column:
    return valid_alphabet(seq, "ACDEFGHIKLMNPQRSTVWYX*")


def matches_with_n(query: Column | str, subject: Column | str) -> Column:
    """Whether ``query``, in which N stands for any of ATGCN, occurs in ``subject``."""
    return F.regexp_like(as_column(subject), F.regexp_replace(F.upper(as_column(query)), "N", "[ATGCN]"))


def strand(query: Column | str, subject: Column | str) -> Column:
    """'+' if the query occurs in the subject, '-' if its reverse complement does, else ''."""
    q = as_column(query)
    return F.when(matches_with_n(q, subject), "+").when(matches_with_n(reverse_complement(q), subject), "-").otherwise("")


def degap(seq: Column | str, gaps: str = "_.") -> Column:
    return F.translate(as_column(seq), gaps, "")
