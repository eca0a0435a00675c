"""Names of files and folders."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sequences import as_column

# The endings that are taken off a file name.
EXTENSIONS = ("fasta", "fastq", "fq", "fna", "txt", "csv", "fas", "fa", "json", "query", "annotation", "analysis", "IFFile")


def without_extension(name: Column | str, extensions: Sequence[str] = EXTENSIONS) -> Column:
    """A file name without its last ending, if that is one of ``extensions``."""
    c = as_column(name)
    last = F.substring_index(c, ".", -1)
    known = c.contains(".") & last.isin(*extensions)
    return F.when(known, F.substring(c, F.lit(1), F.length(c) - F.length(last) - 1)).otherwise(c)


def next_folder(stem: str, existing: Iterable[str]) -> str:
    """``stem``, or with the next number behind it where folders of that name exist."""
    pattern = re.compile(re.escape(stem) + r"(?:_(\d+))?")
    taken = [int(m.group(1) or 0) for m in map(pattern.fullmatch, existing) if m]
    return f"{stem}_{max(taken) + 1}" if taken else stem
