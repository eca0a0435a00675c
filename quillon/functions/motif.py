"""CDR3 motifs: position weight matrices, their patterns, and the search on both strands."""

from __future__ import annotations

import json
import math
import re
import warnings
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sequences import CODONS

LEAST = 1e-16
_PAIRS = str.maketrans("ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN")


@dataclass
class Motif:
    """Weights by position (from 1) and amino acid on either side of a CDR3."""

    locus: str
    left: dict[int, dict[str, float]]
    right: dict[int, dict[str, float]]
    left_trim: int
    right_trim: int
    patterns: tuple = field(default=(), compare=False)
    tables: tuple = field(default=(), compare=False)

    def __post_init__(self):
        self.tables = tuple(weight_table(m) for m in (self.left, self.right))
        self.patterns = tuple(re.compile(pattern(m)) for m in (self.left, self.right))


def read_motifs(text: str) -> list[Motif]:
    """Motifs from JSON rows ``[locus, left, right, left trim, right trim]``."""
    side = lambda m: {int(p): {a: float(x) for a, x in w.items()} for p, w in m.items()}
    return [Motif(r[0], side(r[1]), side(r[2]), int(r[3]), int(r[4])) for r in json.loads(text)]


def choose_motifs(rows: DataFrame, species: Sequence[str], loci: Sequence[str]) -> list[Motif]:
    """Motifs of any of the species and loci from ``rows(species, locus, motifs)``, where motifs is JSON for ``read_motifs``.

    Motif tables are small: a row for each species and locus.
    """
    wanted = rows.filter(F.lower("species").isin(*[x.lower() for x in species]) & F.upper("locus").isin(*[x.upper() for x in loci]))
    out = [m for r in wanted.orderBy("species", "locus").select("motifs").collect() for m in read_motifs(r.motifs)]
    missing = sorted({x.upper() for x in loci} - {m.locus.upper() for m in out})
    if missing:
        warnings.warn(f"no motif for {', '.join(missing)}", stacklevel=2)
    return out


def perplexity(weights: dict[str, float]) -> float:
    return 2 ** -sum(p * math.log2(p) for p in weights.values() if p > 0)


def pattern(motif: dict[int, dict[str, float]]) -> str:
    """Nucleotide pattern of the likely amino acids at each position; any codon where the motif has none."""
    out = []
    for pos in range(1, max(motif) + 1):
        weights = motif.get(pos)
        if not weights:
            out.append("[ACGT]{3}")
            continue
        k = max(1, round(perplexity(weights)))
        likely = [a for a, p in sorted(weights.items(), key=lambda x: (-x[1], x[0]))[:k] if p > 0.01]
        codons = sorted(c for c, a in CODONS.items() if a in likely)
        out.append(f"(?:{'|'.join(codons)})" if codons else "[ACGT]{3}")
    return "".join(out)


def amino_acids(nt: str) -> str:
    nt = nt + "N" * (-len(nt) % 3)
    return "".join(CODONS.get(nt[i : i + 3], "X") for i in range(0, len(nt), 3))


_LETTERS = "ACDEFGHIKLMNPQRSTVWY"
_CODE = np.full(256, len(_LETTERS), dtype=np.int64)  # X, * and whatever else weigh nothing
_CODE[np.frombuffer(_LETTERS.encode(), dtype=np.uint8)] = np.arange(len(_LETTERS))


def weight_table(motif: dict[int, dict[str, float]]) -> np.ndarray:
    """Weights by position and amino acid; 1 for each where the motif has none, 0 for X and *."""
    table = np.ones((max(motif), len(_LETTERS) + 1))
    table[:, -1] = 0.0
    for pos, weights in motif.items():
        table[pos - 1, :-1] = [weights.get(a, 0.0) for a in _LETTERS]
    return table


def best_window(aa: str, motif: dict[int, dict[str, float]], table: np.ndarray | None = None) -> tuple[float, int]:
    """Greatest product of weights over all windows, and where; windows with X or * do not count."""
    table = weight_table(motif) if table is None else table
    n = len(aa) - len(table) + 1
    if n < 1:
        return 0.0, -1
    codes = _CODE[np.frombuffer(aa.encode("ascii", "replace"), dtype=np.uint8)]
    product = np.ones(n)
    for i, weights in enumerate(table):
        product *= weights[codes[i : i + n]]
    at = int(product.argmax())
    return (float(product[at]), at) if product[at] > 0 else (0.0, -1)


def find_cdr3(seq: str | None, motifs: list[Motif], locus: str | None = None) -> dict | None:
    """The CDR3 by patterns where exactly one place fits, else by weights in one frame, or None."""
    if not seq:
        return None
    seq = seq.upper()
    strands = (("+", seq), ("-", seq.translate(_PAIRS)[::-1]))
    chosen = [m for m in motifs if locus is None or m.locus == locus]
    hits = []
    for m in chosen:
        for sign, s in strands:
            for a in m.patterns[0].finditer(s):
                for b in m.patterns[1].finditer(s, a.end()):
                    if (b.start() - a.start()) % 3 == 0:
                        start, stop = a.start() + 3 * m.left_trim, b.end() - 3 * (max(m.right) - m.right_trim)
                        if stop > start:
                            hits.append((m.locus, sign, start, s[start:stop], 1.0))
                        break
    if len(hits) != 1:
        best = None
        for m in chosen:
            for sign, s in strands:
                for frame in range(3):
                    aa = amino_acids(s[frame:])
                    p, i = best_window(aa, m.left, m.tables[0])
                    q, j = best_window(aa, m.right, m.tables[1])
                    if p * q > LEAST and j > i and (best is None or p * q > best[4]):
                        start, stop = frame + 3 * (i + m.left_trim), frame + 3 * (j + m.right_trim)
                        if stop > start:
                            best = (m.locus, sign, start, s[start:stop], p * q)
        hits = [best] if best else []
    if not hits:
        return None
    name, sign, start, nt, score = hits[0]
    return {"locus": name, "strand": sign, "start": start, "nt": nt, "aa": amino_acids(nt), "score": score}


def with_cdr3(reads: DataFrame, seq: str, motifs: list[Motif]) -> DataFrame:
    """``reads`` with a struct ``cdr3``; motif sets are small and travel with the function."""
    schema = reads.selectExpr("*", "cast(null as struct<locus:string,strand:string,start:int,nt:string,aa:string,score:double>) as cdr3").schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(cdr3=[find_cdr3(s, motifs) for s in b[seq]])

    return reads.mapInPandas(run, schema)
