"""Barcodes in reads: containment, fixed-place Hamming distance, and best placement."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.genes import recombination_of_isotype
from ..functions.sequences import reverse_complement

#: More barcodes than this do not go into one expression or broadcast.
MOST_BARCODES = 2000


def _bounded(barcodes: list[tuple[str, str]]) -> list[tuple[str, str]]:
    if len(barcodes) > MOST_BARCODES:
        raise ValueError(f"at most {MOST_BARCODES} barcodes; split the set")
    return barcodes


def contained(reads: DataFrame, seq: str, barcodes: list[tuple[str, str]], name: str = "barcode", none: str = "nomatch") -> DataFrame:
    """``reads`` with the first barcode (in order) that the sequence contains."""
    out = F.lit(none)
    for label, code in reversed(_bounded(barcodes)):
        out = F.when(F.col(seq).contains(code), label).otherwise(out)
    return reads.withColumn(name, out)


def _distance(fragment: Column, code: str) -> Column:
    """Hamming distance to a literal; a missing position counts."""
    out = F.lit(0)
    for i, c in enumerate(code):
        out = out + F.when(F.substring(fragment, i + 1, 1) == c, 0).otherwise(1)
    return out


def nearest(reads: DataFrame, seq: str, barcodes: list[tuple[str, str]], most: int = 1, at_end: bool = False, name: str = "barcode", none: str = "unmatched") -> DataFrame:
    """``reads`` with the barcode of least Hamming distance to the sequence's start or end, and the distance.

    Ties go to the first barcode; none within ``most`` mismatches gives ``none``.
    """
    def fragment(code: str) -> Column:
        n = len(code)
        return F.right(F.col(seq), F.lit(n)) if at_end else F.substring(F.col(seq), 1, n)

    hits = F.array(*[F.struct(_distance(fragment(code), code).alias("d"), F.lit(i).alias("i"), F.lit(label).alias("label")) for i, (label, code) in enumerate(_bounded(barcodes))])
    best = F.array_min(hits)
    return reads.withColumn("_best", best).withColumn(name, F.when(F.col("_best.d") <= most, F.col("_best.label")).otherwise(none)).withColumn("mismatches", F.when(F.col("_best.d") <= most, F.col("_best.d"))).drop("_best")


def summary(assigned: DataFrame, name: str = "barcode") -> DataFrame:
    return assigned.groupBy(name).agg(F.count("*").alias("counts"))


def best_offset(seq: str, code: str) -> tuple[int, int]:
    """Mismatches and offset of the best placement of ``code`` in ``seq``; the smallest offset of equals, (-1, -1) if it does not fit."""
    n, k = len(seq), len(code)
    if n < k or k == 0:
        return -1, -1
    s, c = np.frombuffer(seq.encode("ascii", "replace"), dtype=np.uint8), np.frombuffer(code.encode("ascii", "replace"), dtype=np.uint8)
    # Matches at all offsets as a sum of cross-correlations, one for each letter of the code.
    size = 1 << (n + k - 2).bit_length() if n + k > 2 else 2
    total = np.zeros(size // 2 + 1, dtype=complex)
    for letter in np.unique(c):
        total += np.fft.rfft(s == letter, size) * np.conj(np.fft.rfft(c == letter, size))
    matches = np.rint(np.fft.irfft(total, size)[: n - k + 1]).astype(int)
    at = int(matches.argmax())
    return k - int(matches[at]), at


#: Cells (reads by padded length) correlated at a time.
_CELLS = 1 << 20


def best_offsets(reads: list[str], codes: list[str]) -> list[list[tuple[int, int]]]:
    """``best_offset`` of each code in each read, with all reads of a block and all codes correlated together."""
    out: list[list[tuple[int, int]]] = [[(-1, -1)] * len(codes) for _ in reads]
    order = sorted(range(len(reads)), key=lambda i: len(reads[i]))
    arrays = [np.frombuffer(c.encode("ascii", "replace"), dtype=np.uint8) for c in codes]
    longest = max(map(len, codes), default=0)
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and (stop + 1 - start) * (len(reads[order[stop]]) + longest) <= _CELLS:
            stop += 1
        rows = order[start:stop]
        start = stop
        n = np.array([len(reads[i]) for i in rows])
        width = int(n.max()) + longest
        if width == longest:
            continue
        size = 1 << (width - 1).bit_length()
        text = np.zeros((len(rows), width), dtype=np.uint8)
        for k, i in enumerate(rows):
            text[k, : n[k]] = np.frombuffer(reads[i].encode("ascii", "replace"), dtype=np.uint8)
        spectra = {x: np.fft.rfft(text == x, size, axis=1) for x in np.unique(np.concatenate(arrays)).tolist()}
        for j, c in enumerate(arrays):
            if not len(c):
                continue
            total = sum(spectra[x] * np.conj(np.fft.rfft(c == x, size)) for x in np.unique(c).tolist())
            matches = np.rint(np.fft.irfft(total, size, axis=1)[:, :width]).astype(np.int64)
            matches[np.arange(width) > (n - len(c))[:, None]] = -1
            at = matches.argmax(axis=1)
            for k in np.flatnonzero(n >= len(c)).tolist():
                out[rows[k]][j] = len(c) - int(matches[k, at[k]]), int(at[k])
    return out


def aligned(reads: DataFrame, seq: str, barcodes: list[tuple[str, str]], most: int = 2) -> DataFrame:
    """``reads`` with the best barcode placement on either strand: barcode, mismatches, offset, strand, recombination.

    Reads that contain a barcode (or its reverse complement) exactly are found
    by expressions; only the others go to the correlation.
    """
    codes = _bounded(barcodes)
    exact = F.lit(None).cast("struct<label:string,mismatches:int,place:int,strand:string>")
    flipped = {label: reverse_complement(F.lit(code)) for label, code in codes}
    for strand in "-+":
        for label, code in reversed(codes):
            x = F.lit(code) if strand == "+" else flipped[label]
            exact = F.when(F.col(seq).contains(x), F.struct(F.lit(label).alias("label"), F.lit(0).alias("mismatches"), (F.instr(F.col(seq), code) - 1 if strand == "+" else F.locate(code, reverse_complement(seq)) - 1).cast("int").alias("place"), F.lit(strand).alias("strand"))).otherwise(exact)
    marked = reads.withColumn("_hit", exact)
    found = marked.filter("_hit is not null")
    pairs = str.maketrans("ACGTacgtN", "TGCAtgcaN")

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            plus = [s if isinstance(s, str) else "" for s in b[seq]]
            places = best_offsets([*plus, *(s.translate(pairs)[::-1] for s in plus)], [code for _, code in codes])
            hits = []
            for i in range(len(plus)):
                found = [(d, sign, j, at) for sign, row in enumerate((places[i], places[len(plus) + i])) for j, (d, at) in enumerate(row) if 0 <= d <= most]
                best = min(found, default=None)  # least mismatches, then the plus strand, then the first barcode
                hits.append(best and {"label": codes[best[2]][0], "mismatches": best[0], "place": best[3], "strand": "+-"[best[1]]})
            yield b.assign(_hit=hits)

    rest = marked.filter("_hit is null")
    out = found.unionByName(rest.mapInPandas(search, rest.schema))
    return out.select(*[F.col(f"`{c}`") for c in reads.columns], F.col("_hit.label").alias("barcode"), "_hit.mismatches", F.col("_hit.place").alias("offset"), "_hit.strand", recombination_of_isotype("_hit.label").alias("recombination"))


def isotype_summary(hits: DataFrame) -> DataFrame:
    return hits.filter("barcode is not null").groupBy("barcode").agg(F.count("*").alias("counts"), F.avg("mismatches").alias("mean_mismatches"))
