"""Line dedup by range-partitioned line hashes, in DataFrame functions only.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased.  Keys of at least ``MIN_CHARS`` code points found in at least
``MIN_DOCS`` documents lose all their lines except in the largest doc_id that
holds them.

Only 128-bit key hashes and positions travel.  Rows are range-partitioned by
hash and document and sorted by hash, document (largest first) and position, so
a window streams through the rows of each key: the first document keeps its
lines, the later ones lose theirs.  Keys with more than ``HOT`` lines never go
to one window: their document counts and largest doc_ids are pre-aggregated
(combined before the shuffle), and their rows meet those by an equi-join that
Spark broadcasts or splits by the measured size.

Decisions come back as a bitmap for each document: a bit for each line in
64-bit words, 1 where the line goes.  Only words with a set bit are stored, and
only documents that lose a line have any.  Texts stay where they are until the
bitmaps are applied.

Defined cases: null or empty text is one empty line.  Rows with the same doc_id
are one document when documents are counted, and the largest doc_id keeps its
lines in all of its rows.  Rows without doc_id are one document together, which
never holds the kept copy.  Extra columns are kept by ``dedup_lines``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACE, ascii_lower, fresh, staged, table

MIN_CHARS = 20
MIN_DOCS = 3
HOT = 2000


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_keys(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, row_key, pos, h1, h2) of each line with a key of ``min_chars`` or more.

    ``row_key`` tells rows that repeat a doc_id apart by their texts.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("row_key"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    rows = rows.select("doc_id", "row_key", "pos", F.btrim("line", F.lit(SPACE)).alias("line")).filter(F.char_length("line") >= min_chars)
    key = ascii_lower(F.col("line"))
    return rows.select("doc_id", "row_key", "pos", F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2"))


def drop_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, hot: int = HOT) -> DataFrame:
    """(doc_id, row_key, words): for each row that loses lines, a map from word number to 64 line bits."""
    lines = staged(line_keys(docs, min_chars), "lines")
    sizes = lines.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter(F.col("n") > hot).select("h1", "h2")
    big = staged(sizes, "hot")

    # Each document once for a key: counts of distinct documents stay exact and combine before the shuffle.
    in_hot = lines.join(big, ["h1", "h2"])
    known = in_hot.select("h1", "h2", "doc_id").distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc_id").alias("last")).filter(F.col("docs") >= min_docs)
    known = staged(known, "hot-keys")
    lost_hot = lines.join(known, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last"))).select("doc_id", "row_key", "pos")

    calm = lines.join(big, ["h1", "h2"], "left_anti")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("h1"), F.col("h2")]
    by_doc = F.col("doc_id").desc_nulls_last()
    calm = calm.repartitionByRange(n, *order).sortWithinPartitions(*order, by_doc, "pos")
    stream = Window.partitionBy(*order).orderBy(by_doc)
    seen = calm.withColumn("nth", F.dense_rank().over(stream))
    seen = seen.withColumn("docs", F.max("nth").over(Window.partitionBy(*order)))
    lost = seen.filter((F.col("nth") > 1) & (F.col("docs") >= min_docs)).select("doc_id", "row_key", "pos")

    bit = F.expr("shiftleft(1L, pos % 64)")
    words = lost.unionByName(lost_hot).groupBy("doc_id", "row_key", F.expr("pos div 64").cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    return words.groupBy("doc_id", "row_key").agg(F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("words"))


def with_bitmaps(docs: DataFrame, **limits: int) -> tuple[DataFrame, str, str]:
    """``docs`` with an array of kept lines and the number of lines, and those columns' names."""
    words = drop_bitmaps(docs, **limits)
    kept, n = fresh("kept_lines", docs.columns), fresh("n_lines", docs.columns)
    a, b, m = (fresh(x, docs.columns) for x in ("at_doc", "at_row", "drop_words"))
    words = words.select(F.col("doc_id").alias(a), F.col("row_key").alias(b), F.col("words").alias(m))
    out = docs.join(words, F.col("doc_id").cast("long").eqNullSafe(F.col(a)) & (F.xxhash64("text") == F.col(b)), "left")
    lines = _lines(F.col("text"))
    bits = F.transform(F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / 64).cast("int")), lambda w: F.coalesce(F.element_at(F.col(m), w), F.lit(0).cast("long")))
    dense = fresh("drop_bits", docs.columns)
    out = out.withColumn(dense, F.when(F.col(m).isNotNull(), bits))
    go = F.filter(lines, lambda x, i: F.getbit(F.get(F.col(dense), F.floor(i / 64).cast("int")), i % 64) == 0)
    out = out.withColumn(n, F.size(lines).cast("long")).withColumn(kept, F.when(F.col(dense).isNull(), lines).otherwise(go))
    return out.drop(a, b, m, dense), kept, n


def dedup_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """``docs`` with the repeated lines gone from its texts; n_chars follows where it is there.

    A text that loses no line stays as it is, null included.
    """
    out, kept, n = with_bitmaps(docs, **limits)
    text = F.when(F.size(kept) == F.col(n), F.col("text")).otherwise(F.array_join(kept, "\n"))
    out = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, kept, n = with_bitmaps(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col(n).alias("n_lines"), (F.col(n) - F.size(kept)).cast("long").alias("n_dropped"), F.sha2(F.array_join(kept, "\n"), 256).alias("kept_sha256"))


OP9_SQL = r"""
with docs as (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
rows as (
  select r, doc_id, i, lines[i] as line,
         translate(trim(lines[i], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from docs, unnest(range(1, len(lines) + 1)) as t(i)),
lost as (select k, max(doc_id) as last from rows where length(k) >= 20 group by k having count(distinct doc_id) >= 3)
select rows.doc_id, count(*) as n_lines,
       count(*) filter (where lost.k is not null and rows.doc_id is distinct from lost.last) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where lost.k is null or rows.doc_id is not distinct from lost.last), '')) as kept_sha256
from rows left join lost using (k) group by r, rows.doc_id
"""
