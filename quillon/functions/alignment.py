"""Positions in gapped alignments: reading frames, ends, gap removal, and where FR4 begins."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .motif import amino_acids


def in_frame(seq: str) -> str:
    """``seq`` with N in front, so that its last codon is whole."""
    return "N" * (-len(seq) % 3) + seq


def start_in_frame(start: int, germline_start: int, region: str, germline_region: str, to_first: bool = False) -> tuple[int, int]:
    """Start (from 1) and frame of a read whose first region ends in frame with the germline.

    ``to_first`` moves the start up to the germline's first base.
    """
    inner = sum(c != "-" for c in germline_region)
    following = germline_start + inner
    if to_first:
        start, germline_start = start - (germline_start - 1), 1
    start -= (germline_start - 1) % 3 - (following - 1) % 3
    if start < 1:
        start += -((start - 1) // 3) * 3
    return start, (start - 1) % 3 + 1


def end_in_read(end: int, read_length: int, germline_end: int = 0, germline_length: int = 0, to_last: bool = False) -> int:
    """End of a read's region, moved to the germline's end if asked for, by whole codons back into the read."""
    if to_last:
        end += germline_length - germline_end
    over = end - read_length
    return end - -(-over // 3) * 3 if over > 0 else end


def without_gaps(query: str, germline: str, insertions: str = "keep") -> dict:
    """The query of an alignment without gaps, with deletions as n, and its amino acids.

    ``insertions`` are kept, removed, or removed 'on_stop': only where keeping
    them makes a stop codon.
    """
    if insertions not in ("keep", "remove", "on_stop"):
        raise ValueError(insertions)
    q, g = np.array(list(query)), np.array(list(germline))
    gapped = bool((q == "-").any() or (g == "-").any())

    def cut(drop: bool) -> tuple[str, str]:
        s = "".join(q[g != "-"] if drop else q)
        return s.replace("-", ""), s.replace("-", "n")

    drop = insertions == "remove"
    plain, marked = cut(drop)
    if insertions == "on_stop" and "*" in amino_acids(plain.upper()):
        drop = gapped
        plain, marked = cut(drop)
    return {"nt": plain, "nt_gapped": marked if gapped else None, "aa": amino_acids(plain.upper()), "aa_gapped": amino_acids(marked.upper()) if gapped else None, "adjusted": drop and gapped}


def fr4_start(pattern: str, hits: list[dict], tail: str, tail_start: int) -> int | None:
    """Where FR4 begins in the read (from 1), or None.

    The last match of ``pattern`` in the first germline hit that has one, carried
    over the gaps of its alignment; else the last match in the read's own
    ``tail``, which begins at ``tail_start``.
    """
    motif = re.compile(pattern, re.I)
    last = lambda s: max((m.start() for m in motif.finditer(s)), default=None)
    for hit in hits:
        at = last(hit["germline"].replace("-", ""))
        if at is not None:
            place = np.flatnonzero(np.array(list(hit["germline"])) != "-")
            column = int(place[at - 1]) + 1 if at else 0
            return hit["start"] + sum(c != "-" for c in hit["query"][:column])
    at = last(tail)
    return None if at is None else at + tail_start


def cdr3_and_fr4(read: str, cdr3_start: int, fr4: int | None, end: int, known_end: int | None = None) -> dict:
    """CDR3 and FR4 of a read by their starts; without FR4, the CDR3 up to ``known_end``."""
    out = dict.fromkeys(("cdr3_nt", "cdr3_aa", "cdr3_frame", "fr4_nt", "fr4_aa", "fr4_frame"))
    stop = fr4 - 1 if fr4 is not None and fr4 > cdr3_start else known_end
    if stop is not None and stop >= cdr3_start:
        nt = read[cdr3_start - 1 : stop]
        out |= {"cdr3_nt": nt, "cdr3_aa": amino_acids(nt.upper()), "cdr3_frame": (cdr3_start - 1) % 3 + 1}
    if fr4 is not None and fr4 > cdr3_start:
        nt = read[fr4 - 1 : end]
        out |= {"fr4_nt": nt, "fr4_aa": amino_acids(nt.upper()), "fr4_frame": (fr4 - 1) % 3 + 1}
    return out


FR4_SCHEMA = "cdr3_nt string, cdr3_aa string, cdr3_frame int, fr4_nt string, fr4_aa string, fr4_frame int"


def with_fr4(rows: DataFrame, pattern: str) -> DataFrame:
    """``rows(sequence, cdr3_start, end, j_hits)`` with the fields of ``cdr3_and_fr4``; j_hits are (query, germline, start).

    The other columns ride along as they are.
    """
    added = T.StructType.fromDDL(FR4_SCHEMA)
    schema = T.StructType([*rows.schema.fields, *added.fields])
    kinds = {"string": pa.string(), "int": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = []
            for read, start, end, hits in zip(*(b[c].to_pylist() for c in ("sequence", "cdr3_start", "end", "j_hits"))):
                if read is None or start is None:
                    got.append({})
                    continue
                end = len(read) if end is None else end
                got.append(cdr3_and_fr4(read, start, fr4_start(pattern, hits or [], read[start - 1 : end], start), end))
            extra = [pa.array([x.get(f.name) for x in got], kinds[f.dataType.simpleString()]) for f in added.fields]
            yield pa.RecordBatch.from_arrays([*b.columns, *extra], names=schema.names)

    return rows.mapInArrow(run, schema)
