"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"

#: The white space of the word and line contracts: space, tab, LF, VT, FF, CR.
SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over at least as many partitions as there are cores.

    A table that comes in fewer pieces, such as one small file, is dealt out
    before costly functions; any larger one stays as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="quillon-checkpoint-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share.

    It is read from ``spark.checkpoint.dir``; only where that is unset on one
    machine (tests) a folder of our own is made and set.  On a cluster that is
    refused, as executors would not see it.
    """
    sc = spark.sparkContext
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not conf:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf = _own_folder()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(conf)
    return conf


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint; for narrow frames."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    Unlike a checkpoint it is compressed, can be pruned by column and tells
    the planner its true size.  Only committed task attempts are visible, so
    values made in a task (such as random chunk ids) are safe to use from it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/quillon-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    return _staged(spark.read.schema(df.schema).parquet(path), path)


def kept(df: DataFrame, label: str) -> DataFrame:
    """As ``staged``, for a table that outlives the ``temporary`` block it is made in."""
    back = staged(df, label)
    if _made:
        _made[-1] = [x for x in _made[-1] if x is not back]
    return back


def staged_by(df: DataFrame, label: str, by: str, n: int, codec: str = "zstd") -> DataFrame:
    """As ``staged``, in ``n`` buckets of ``by``: grouping by it later moves none of these rows.

    Meant for rows of which a task writes few values of ``by``, so few files.
    """
    spark = df.sparkSession
    name = f"quillon_{label}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark).rstrip('/')}/{name}"
    df.write.bucketBy(n, by).option("compression", codec).option("path", path).format("parquet").saveAsTable(name)
    back = _staged(spark.table(name), path)
    spark.sql(f"drop table {name}")  # its entry in the catalog; files outside the warehouse stay
    return back


_made: list[list[DataFrame]] = []  # tables staged in each open ``temporary`` block


@contextmanager
def temporary() -> Iterator[None]:
    """Delete the tables that are staged in this block at its end: what is built on them has been written by then."""
    _made.append([])
    try:
        yield
    finally:
        discard(*_made.pop())


def _staged(back: DataFrame, path: str) -> DataFrame:
    back._quillon_path = path
    if _made:
        _made[-1].append(back)
    return back


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that no returned frame reads any more."""
    for df in frames:
        path = getattr(df, "_quillon_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def fresh(name: str, taken: list[str]) -> str:
    """``name``, or ``name`` with underscores in front, not among ``taken``."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name


def ascii_lower(column):
    """Lower-case A-Z only.  Text that is ASCII takes the fast built-in."""
    return F.when(F.octet_length(column) == F.char_length(column), F.lower(column)).otherwise(F.translate(column, ASCII_UPPER, ASCII_LOWER))


def doc_text(docs: DataFrame) -> DataFrame:
    """doc_id and the text's UTF-8 bytes; other columns are not read."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
