"""Readers for sequence and table files, all through Spark's own file access."""

from __future__ import annotations

import fnmatch
import io
import json
import tarfile
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DECORATOR = "#@"
HEADER_JSON = " <"


class FormatError(ValueError):
    """A file that is not what it should be."""


def split_header(header: Column) -> tuple[Column, Column]:
    """A read header and the JSON text after `` <``, null where there is none."""
    at = F.instr(header, HEADER_JSON)
    return F.when(at > 0, F.substring(header, F.lit(1), at - 1)).otherwise(header), F.when(at > 0, F.substring(header, at + len(HEADER_JSON), F.length(header)))


def with_header_json(df: DataFrame, schema: str | None = None) -> DataFrame:
    """``header`` without its JSON, and the JSON as ``info``: a struct by ``schema``, else a map of texts; bad JSON is null."""
    head, text = split_header(F.col("header"))
    return df.withColumn("info", F.from_json(text, schema or "map<string,string>")).withColumn("header", head)


def read_fasta(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """(header, sequence, info); sequences may be wrapped.  Files are split at records."""
    raw = spark.read.option("lineSep", "\n>").text(path)
    body = F.regexp_replace(F.regexp_replace("value", "^>", ""), "\r", "")
    lines = F.split(body, "\n")
    rows = raw.filter(F.trim("value") != "").select(F.trim(F.get(lines, F.lit(0))).alias("header"), F.array_join(F.transform(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), F.trim), "").alias("sequence"))
    return with_header_json(rows, schema)


def read_fastq(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """(header, sequence, quality, info); wrapped records are allowed, broken ones raise.

    A quality line may begin with @, so a record cannot be found from the
    middle of a file: each file is streamed by one task, line by line.  Split
    large files, as sequencers do.
    """
    lines = spark.read.option("wholetext", False).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.monotonically_increasing_id().alias("nr"), "value")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Rows of a block are in order of nr; blocks are in order of their start.
    ordered = lines.repartition(n, "file").sortWithinPartitions("file", "at", "nr")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, header, seq, bases, quality, state = None, "", [], "", "", 0
        out: list[tuple[str, str, str]] = []

        def ended() -> None:
            if state:
                raise FormatError(f"{file} ends in the record {header!r}")

        for b in batches:
            for name, line in zip(b["file"], b["value"]):
                line = line.rstrip("\r")
                if name != file:
                    ended()
                    file, state = name, 0
                if state == 0:
                    if not line.strip():
                        continue
                    if line[0] != "@":
                        raise FormatError(f"{file}: a header begins with @: {line[:80]!r}")
                    header, seq, quality, state = line[1:].strip(), [], "", 1
                elif state == 1:
                    if line != "+":
                        seq.append(line.strip())
                        continue
                    bases, state = "".join(seq), 2
                    if not bases:
                        out.append((header, "", ""))
                        state = 0
                else:
                    quality += line
                    if len(quality) > len(bases):
                        raise FormatError(f"{file}: lengths differ in the record {header!r}")
                    if len(quality) == len(bases):
                        out.append((header, bases, quality))
                        state = 0
            yield pd.DataFrame(out, columns=["header", "sequence", "quality"])
            out = []
        ended()

    return with_header_json(ordered.mapInPandas(run, "header string, sequence string, quality string"), schema)


def read_decorator(spark: SparkSession, path) -> dict:
    """The JSON of the leading ``#@`` line of a file, or {}."""
    head = spark.read.text(path).limit(1).collect()
    if head and head[0].value.startswith(DECORATOR):
        try:
            return json.loads(head[0].value[len(DECORATOR) :])
        except json.JSONDecodeError:
            return {}
    return {}


def read_delimited(spark: SparkSession, path, sep: str = "\t", header: bool = True, fields: Sequence[str] | None = None) -> DataFrame:
    """All-string columns; short rows are padded with ''; no quoting; ``#`` lines are left out.

    Without a header, columns are called ``Column 1`` and so on.
    """
    df = spark.read.option("sep", sep).option("header", header).option("quote", "").option("comment", "#").option("mode", "PERMISSIVE").csv(path)
    if not header:
        df = df.toDF(*[f"Column {i + 1}" for i in range(len(df.columns))])
    df = df.na.fill("")
    return df.select(*[F.col(f"`{f}`") for f in fields]) if fields else df


def read_json(spark: SparkSession, path, fields: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.json(path)
    return df.select(*fields) if fields else df


def guess_format(spark: SparkSession, path) -> tuple[str | None, str | None]:
    """(format, separator) from the first lines: JSON, or the one format that fits, else (None, None)."""
    head = [r.value for r in spark.read.text(path).limit(100).collect()]
    head = [x for x in head if x.strip() and not x.startswith(DECORATOR)]
    if not head:
        return None, None

    def is_json(x: str) -> bool:
        try:
            return isinstance(json.loads(x), dict)
        except ValueError:
            return False

    if all(map(is_json, head[:10])):
        return "json", None
    fits: list[tuple[str, str | None]] = []
    if head[0].startswith(">"):
        fits.append(("fasta", None))
    if head[0].startswith("@") and "+" in head[1:]:
        fits.append(("fastq", None))
    for sep in "\t,":
        n = {x.count(sep) for x in head[:10]}
        if len(n) == 1 and n != {0} and not fits:
            fits.append(("delimited", sep))
    return fits[0] if len(fits) == 1 else (None, None)


def read_any(spark: SparkSession, path, kind: str | None = None, **options) -> DataFrame:
    """The reader for ``kind``, or for the format that the file seems to have."""
    sep = None
    if kind is None:
        kind, sep = guess_format(spark, path)
    if kind == "fasta":
        return read_fasta(spark, path, **options)
    if kind == "fastq":
        return read_fastq(spark, path, **options)
    if kind == "json":
        return read_json(spark, path, **options)
    if kind in ("delimited", "tab", "csv"):
        return read_delimited(spark, path, sep=options.pop("sep", sep or {"csv": ","}.get(kind, "\t")), **options)
    raise FormatError(f"the format of {path} is not known")


def read_parallel_tables(spark: SparkSession, paths: dict[int, str], key: str = "Sequence number") -> DataFrame:
    """Tab files about the same reads, joined on ``key``; columns get the suffix ``_<number>``."""
    out = None
    for number, path in sorted(paths.items()):
        df = read_delimited(spark, path)
        df = df.select(F.col(f"`{key}`").alias(key), *[F.col(f"`{c}`").alias(f"{c}_{number}") for c in df.columns if c and c != key])
        out = df if out is None else out.join(df, key, "full_outer")
    if out is None:
        raise FormatError("no files")
    return out


def read_blocks(spark: SparkSession, path, separator: str) -> DataFrame:
    """(lines) of each block of a report whose blocks begin with ``separator``."""
    raw = spark.read.option("lineSep", separator).text(path)
    return raw.filter(F.trim("value") != "").select(F.split(F.regexp_replace(F.concat(F.lit(separator), "value"), r"\s+$", ""), "\r?\n").alias("lines"))


def read_germline(spark: SparkSession, paths: Sequence[str], species: str | None = None, loci: Sequence[str] = (), functional: Sequence[str] = ()) -> DataFrame:
    """Germline genes from tab files, narrowed by species, loci and functionality."""
    df = read_delimited(spark, list(paths))
    if species:
        df = df.filter(F.lower("SPECIES") == species.lower())
    if loci:
        df = df.filter(F.col("LOCUS").isin(*loci))
    return df.filter(F.col("FUNCTIONALITY").isin(*functional)) if functional else df


def germline_sets(docs: DataFrame, functional: Sequence[str] = ()) -> DataFrame:
    """Genes by gene type from documents with an array of genes, sorted by allele."""
    rows = docs.select("GENETYPE", F.explode("GERMLINE_GENES").alias("g"))
    if functional:
        rows = rows.filter(F.col("g.FUNCTIONALITY").isin(*functional))
    return rows.groupBy("GENETYPE").agg(F.sort_array(F.collect_list(F.struct("g.ALLELE_NAME", "g.SEQUENCE", "g.FUNCTIONALITY"))).alias("genes"))


def resolve_germline(spark: SparkSession, folder: str, species: str, loci: Sequence[str], gene_types: Sequence[str] = ("V", "J"), custom: Sequence[str] = ()) -> DataFrame:
    """Germline genes of a species, its loci and gene types: of ``custom`` files, else of a folder laid out by these.

    The folder is that of ``writers.save_germline_tables``; only its matching
    folders are listed and read.  Nothing found raises.
    """
    if custom:
        return read_germline(spark, custom, species, loci)
    rows = read_delimited(spark, folder)
    name = species.lower().replace(" ", "_")
    rows = rows.filter((F.col("by_species") == name) & F.col("by_locus").isin(*loci) & F.col("by_type").isin(*gene_types))
    if rows.isEmpty():
        raise FormatError(f"no germline genes of {species}, {', '.join(loci)} in {folder}")
    return rows.drop("by_species", "by_locus", "by_type")


def merge_files(spark: SparkSession, paths: Sequence[str], sep: str = "\t") -> DataFrame:
    """Files of one layout as one table; each file's header is read once for its own rows."""
    out = None
    for p in paths:
        rows = read_delimited(spark, p, sep)
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    if out is None:
        raise FormatError("no files")
    return out.na.fill("")


def read_for_reference(df: DataFrame, renames: dict[str, str], reads: str = "READS") -> DataFrame:
    """Renamed columns, blanks for nulls, and one read where no count is given."""
    out = df.withColumnsRenamed(renames)
    out = out.withColumn(reads, F.coalesce(F.col(reads).try_cast("long"), F.lit(1)) if reads in out.columns else F.lit(1).cast("long"))
    return out.na.fill("")


def read_archive(spark: SparkSession, path, members: str = "*") -> DataFrame:
    """(archive, member, line) of the text files in zip and tar archives whose names match ``members``.

    An archive is opened by one task and read member by member, line by line.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, content in zip(b["path"], b["content"]):
                for member, stream in _members(bytes(content), members):
                    lines: list[str] = []
                    for line in io.TextIOWrapper(stream, encoding="utf-8", errors="replace"):
                        lines.append(line.rstrip("\r\n"))
                        if len(lines) == 10_000:
                            yield pd.DataFrame({"archive": name, "member": member, "line": lines})
                            lines = []
                    if lines:
                        yield pd.DataFrame({"archive": name, "member": member, "line": lines})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "archive string, member string, line string")


def _members(content: bytes, pattern: str):
    data = io.BytesIO(content)
    if zipfile.is_zipfile(data):
        with zipfile.ZipFile(data) as z:
            for info in z.infolist():
                if not info.is_dir() and fnmatch.fnmatch(info.filename, pattern):
                    yield info.filename, z.open(info)
        return
    data.seek(0)
    with tarfile.open(fileobj=data) as t:
        for info in t:
            if info.isfile() and fnmatch.fnmatch(info.name, pattern):
                yield info.name, t.extractfile(info)
