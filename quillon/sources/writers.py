"""Writers: delimited, flat and nested JSON, FASTA, FASTQ, split by value."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.convert import default_quality, flatten
from .readers import DECORATOR, HEADER_JSON, read_any


def ordered(df: DataFrame, columns: Sequence[str] | Mapping[str, str] | None, keep_rest: bool = True) -> DataFrame:
    """Columns in the given order (a mapping renames), the others behind in name order if kept."""
    if columns is None:
        return df
    names = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    shown = [F.col(f"`{c}`").alias(n) for c, n in names.items() if c in df.columns]
    rest = [F.col(f"`{c}`") for c in sorted(df.columns) if c not in names] if keep_rest else []
    return df.select(*shown, *rest)


def split_columns(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``df`` with a column ``part`` that names its file: the values with blanks, commas and slashes as _."""
    return df.withColumn("part", F.regexp_replace(F.concat_ws(".", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("none")) for c in by]), r"[ ,\\/]", "_"))


def _write(lines: DataFrame, path: str, by: Sequence[str], header: str | None = None) -> None:
    writer = lines.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).text(path)


def save_delimited(df: DataFrame, path: str, sep: str = "\t", columns: Sequence[str] | Mapping[str, str] | None = None, keep_rest: bool = True, split_by: Sequence[str] = ()) -> None:
    """Flat rows with a header; lists are joined by a comma, or by a bar in comma files."""
    flat = ordered(flatten(df, lists="|" if sep == "," else ","), columns, keep_rest)
    if split_by:
        flat = split_columns(flat, split_by)
    writer = flat.write.mode("overwrite").option("sep", sep).option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", "")
    (writer.partitionBy("part") if split_by else writer).csv(path)


def save_flat_json(df: DataFrame, path: str, split_by: Sequence[str] = (), as_text: bool = False) -> None:
    flat = flatten(df, lists="," if as_text else None)
    if as_text:
        flat = flat.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in flat.columns])
    line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in flat.columns])).alias("value")
    _write(split_columns(flat, split_by).select("part", line) if split_by else flat.select(line), path, ["part"] if split_by else [])


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def _header(columns: Sequence[str], extra: Sequence[str]) -> Column:
    head = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.concat(head, F.lit(HEADER_JSON), F.to_json(F.struct(*extra))) if extra else head


def save_fasta(df: DataFrame, path: str, sequence: str, header: Sequence[str], extra: Sequence[str] = (), split_by: Sequence[str] = ()) -> None:
    """Rows without a sequence are left out; ``extra`` columns go into the header as JSON."""
    rows = df.filter(F.coalesce(F.col(sequence), F.lit("")) != "")
    line = F.concat(F.lit(">"), _header(header, extra), F.lit("\n"), F.col(sequence)).alias("value")
    _write(split_columns(rows, split_by).select("part", line) if split_by else rows.select(line), path, ["part"] if split_by else [])


def save_fastq(df: DataFrame, path: str, sequence: str, header: Sequence[str], quality: str | None = None, null_quality: int = 30, extra: Sequence[str] = ()) -> None:
    """As ``save_fasta`` with qualities; a missing one is ``null_quality`` throughout."""
    rows = df.filter(F.coalesce(F.col(sequence), F.lit("")) != "")
    q = default_quality(sequence, null_quality)
    q = F.coalesce(F.col(quality), q) if quality else q
    rows.select(F.concat(F.lit("@"), _header(header, extra), F.lit("\n"), F.col(sequence), F.lit("\n+\n"), q).alias("value")).write.mode("overwrite").text(path)


def decorator_line(columns: Sequence[str], translation: Mapping | None = None) -> str:
    return DECORATOR + json.dumps({"DESCRIPTION": list(columns), "TRANSLATION": dict(translation or {})}, sort_keys=True)


def part_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Documents for each file that a split write makes."""
    return split_columns(df, by).groupBy("part").agg(F.count("*").alias("documents"))


def written_counts(df: DataFrame) -> DataFrame:
    """Documents in each file of what was written, read back as ``df``."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("documents"))


def created_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, part, documents) of a delimited write that was split by value."""
    rows = spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(path).select(F.col("_metadata.file_path").alias("file"), F.col("part").cast("string").alias("part"))
    return rows.groupBy("file", "part").agg(F.count("*").alias("documents"))


def save_germline(genes: DataFrame, path: str, kind: str = "fasta") -> None:
    """A folder for each gene type: FASTA, a tab file with all fields, or FASTA with ``|`` between allele and functionality (``fft``)."""
    rows = genes.select("GENETYPE", F.explode("genes").alias("g"))
    if kind == "tab":
        writer = rows.select("GENETYPE", "g.*").write.mode("overwrite").partitionBy("GENETYPE")
        writer.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
        return
    if kind not in ("fasta", "fft"):
        raise ValueError(kind)
    name = F.concat_ws("|", "g.ALLELE_NAME", "g.FUNCTIONALITY") if kind == "fft" else F.col("g.ALLELE_NAME")
    rows.select("GENETYPE", F.concat(F.lit(">"), name, F.lit("\n"), "g.SEQUENCE").alias("value")).write.mode("overwrite").partitionBy("GENETYPE").text(path)


def save_germline_tables(genes: DataFrame, path: str) -> None:
    """Germline rows as tab files in folders by species, locus and gene type, as ``readers.resolve_germline`` looks for them."""
    folders = {"by_species": F.translate(F.lower("SPECIES"), " ", "_"), "by_locus": F.col("LOCUS"), "by_type": F.col("GENETYPE")}
    writer = genes.withColumns(folders).write.mode("overwrite").partitionBy(*folders)
    writer.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def convert(spark: SparkSession, source, path: str, to: str, kind: str | None = None, columns: Mapping[str, str] | Sequence[str] | None = None, **options) -> None:
    """A file of any readable format as another: ``tab``, ``csv``, ``json``, ``fasta`` or ``fastq``.

    ``columns`` choose, order and rename; ``options`` are those of the writer.
    """
    rows = read_any(spark, source, kind)
    if columns is not None:
        rows = ordered(rows, columns, keep_rest=False)
    if to in ("tab", "csv"):
        save_delimited(rows, path, sep="\t" if to == "tab" else ",", **options)
    elif to == "json":
        save_flat_json(rows, path, **options)
    elif to == "fasta":
        save_fasta(rows, path, **options)
    elif to == "fastq":
        save_fastq(rows, path, **options)
    else:
        raise ValueError(f"no writer for {to!r}")


def split_file(rows: DataFrame, path: str, pieces: int) -> list[str]:
    """``rows`` as ``pieces`` tab files of whole records, each with the header; their folders."""
    by = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]), F.lit(pieces)).alias("piece")
    writer = rows.select("*", by).write.mode("overwrite").partitionBy("piece")
    writer.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)
    return [f"{path}/piece={i}" for i in range(pieces)]


def table_to_fasta(df: DataFrame, path: str, sequence: str, header: Sequence[str]) -> None:
    df.select(F.concat(F.lit(">"), F.concat_ws("_", *header), F.lit("\n"), sequence).alias("value")).write.mode("overwrite").text(path)
