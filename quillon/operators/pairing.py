"""Heavy/light pairing, collapse by key, and cluster summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.convert import cdr3_productive, cluster_code, parse_shm
from ..functions.genes import gene_names, recombination_type

PAIRED, HEAVY, LIGHT, RECEPTOR, LONE = "paired", "OverlapError: heavy", "OverlapError: light", "ReceptorMismatchError", "CORRESPONDING READ FILE DID NOT PASS FILTERS"


def reject_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """The first rule that a row breaks, or null; a rule that is null counts as broken."""
    out = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        out = F.when(F.coalesce(broken, F.lit(True)), name).otherwise(out)
    return out


def funnel(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Rows per reject reason; those that pass are 'passed'."""
    return df.select(F.coalesce(reject_reason(rules), F.lit("passed")).alias("reason")).groupBy("reason").agg(F.count("*").alias("counts"))


def prepare_reads(rows: DataFrame, productive: Column | str | None = None) -> DataFrame:
    """Annotated rows (header, cdr3_nt, cdr3_aa, vgene, jgene, shm) with code, chain and reject reason.

    ``productive`` is a rule of one's own: a Column, or the text of an SQL expression over the rows.
    """
    chain = recombination_type("vgene", "jgene")
    productive = cdr3_productive("cdr3_nt", "cdr3_aa") if productive is None else F.expr(productive) if isinstance(productive, str) else productive
    rules = [
        ("no_header", F.coalesce(F.col("header"), F.lit("")) == ""),
        ("no_cdr3", F.coalesce(F.col("cdr3_nt"), F.lit("")) == ""),
        ("invalid_chain", chain == "N/A"),
        ("unproductive", ~productive),
    ]
    return rows.withColumns({"code": cluster_code("header"), "recomb": chain, "receptor": F.substring(F.upper(F.coalesce(F.nullif(F.col("vgene"), F.lit("")), F.col("jgene"))), 1, 2), "vgene": gene_names("vgene"), "jgene": gene_names("jgene"), "shm": parse_shm("shm"), "reject": reject_reason(rules)})


def pair_rows(df: DataFrame, code: str, chain: str, order: Sequence[str], keep: Sequence[str], heavy: str = "VDJ", light: str = "VJ", receptor: str | None = None) -> DataFrame:
    """Rows of one code taken two at a time in ``order``: a pair, or an error, or a lone row.

    Gives code, pair, note, and the ``keep`` fields of the heavy and the light row.
    """
    rows = df.filter(F.coalesce(F.col(code).cast("string"), F.lit("")) != "")
    place = F.row_number().over(Window.partitionBy(code).orderBy(*order))
    rows = rows.withColumn("_place", place).withColumn("pair", F.floor((F.col("_place") - 1) / 2).cast("long"))
    n_heavy, n_light = F.count_if(F.col(chain) == heavy), F.count_if(F.col(chain) == light)
    mixed = (F.min(receptor) != F.max(receptor)) if receptor else F.lit(False)
    note = F.when(F.count("*") < 2, LONE).when(n_heavy == 2, HEAVY).when(n_light == 2, LIGHT).when((n_heavy == 1) & (n_light == 1), F.when(mixed, RECEPTOR).otherwise(PAIRED)).otherwise("InvalidChain")
    sides = [F.min_by(F.when(F.col(chain) == c, F.col(k)), F.when(F.col(chain) == c, F.col("_place"))).alias(f"{s}_{k}") for s, c in (("heavy", heavy), ("light", light)) for k in keep]
    return rows.groupBy(code, "pair").agg(note.alias("note"), *sides)


def modes(df: DataFrame, keys: Sequence[str], item: str, sep: str = ",") -> DataFrame:
    """The most frequent values of ``item`` per key, ties in order and joined."""
    counts = df.filter(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.count("*").alias("_n"))
    best = Window.partitionBy(*keys).orderBy(F.desc("_n"))
    top = counts.withColumn("_r", F.dense_rank().over(best)).filter("_r = 1")
    return top.groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list(F.col(item).cast("string"))), sep).alias(f"{item}_mode"), F.max("_n").alias(f"{item}_count"))


def moments(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mergeable count, sum and sum of squares of ``value`` per key."""
    x = F.col(value).cast("double")
    return df.groupBy(*keys).agg(F.count(x).alias("n"), F.coalesce(F.sum(x), F.lit(0.0)).alias("s1"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("s2"))


def merge_moments(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return parts.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "s1", "s2")])


def mean_and_sd(n: str = "n", s1: str = "s1", s2: str = "s2") -> tuple[Column, Column]:
    """Mean and sample deviation rounded to 3; null below one and two values."""
    a, b, c = F.col(n), F.col(s1), F.col(s2)
    spread = F.greatest((F.round(c, 6) - F.round(b * b / a, 6)) / (a - 1), F.lit(0.0))
    return F.when(a > 0, F.round(b / a, 3)), F.when(a > 1, F.round(F.sqrt(spread), 3))


def collapse(df: DataFrame, keys: Sequence[str], order: Sequence[str], genes: Sequence[str] = (), value: str | None = None, first: Sequence[str] = ()) -> DataFrame:
    """One row per key: count, the fields of the first row in ``order``, gene modes, mean and deviation."""
    x = F.col(value).cast("double") if value else F.lit(None).cast("double")
    seed = F.struct(*order)
    out = df.groupBy(*keys).agg(F.count("*").alias("counts"), *[F.min_by(c, seed).alias(c) for c in first], F.count(x).alias("n"), F.coalesce(F.sum(x), F.lit(0.0)).alias("s1"), F.coalesce(F.sum(x * x), F.lit(0.0)).alias("s2"))
    for g in genes:
        out = out.join(modes(df, keys, g).drop(f"{g}_count"), list(keys), "left")
    mean, sd = mean_and_sd()
    return out.withColumns({"mean": mean, "sd": sd}) if value else out.drop("n", "s1", "s2")


def dominance(df: DataFrame, cluster: str, member: str, count: str) -> DataFrame:
    """Per cluster: size, total and seed counts, dominance and confidence in whole percent.

    The seed is the member with the greatest count; confidence is 100 where it
    stands alone.
    """
    order = Window.partitionBy(cluster).orderBy(F.desc(count), member)
    # Spark keeps two rows of a cluster from each partition before the shuffle, and the sums combine before theirs.
    best = df.select(cluster, member, count, F.row_number().over(order).alias("_r")).filter("_r <= 2")
    best = best.groupBy(cluster).agg(
        F.max(F.when(F.col("_r") == 1, F.col(member))).alias("seed"),
        F.max(F.when(F.col("_r") == 1, F.col(count))).alias("seed_counts"),
        F.max(F.when(F.col("_r") == 2, F.col(count))).alias("_second"),
    )
    best = best.withColumnRenamed(cluster, "_cluster")
    out = df.groupBy(cluster).agg(F.count("*").alias("size"), F.sum(count).alias("total_counts")).join(best, F.col(cluster).eqNullSafe(F.col("_cluster"))).drop("_cluster")
    dom = F.expr("cast(100 * seed_counts div total_counts as int)")
    conf = F.when(F.col("_second").isNull(), 100).otherwise(F.floor(100 - 100 * F.col("_second") / F.col("seed_counts")).cast("int"))
    return out.withColumns({"dominance": dom, "confidence": conf}).drop("_second")


def merge_reads(df: DataFrame, keys: Sequence[str], reads: str | None, tag: str, order: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """Equal sequences in one row: summed reads, joined set of tags, the first row's other fields."""
    n = F.sum(reads) if reads else F.count("*")
    return df.groupBy(*keys).agg(*[F.min_by(c, F.struct(*order)).alias(c) for c in first], n.cast("long").alias("reads"), F.array_join(F.array_sort(F.collect_set(tag)), "|").alias("tags"))


def cluster_summary(members: DataFrame, collapsed: DataFrame, member: str, genes: Sequence[str] = ()) -> DataFrame:
    """Per centroid: size, counts, dominance, confidence, the seed's genes, and mean and deviation of all members.

    ``members(member, counts, centroid)`` come from clustering, ``collapsed``
    has each member's moments n, s1, s2.
    """
    whole = members.join(collapsed.select(member, "n", "s1", "s2"), member)
    mean, sd = mean_and_sd()
    merged = merge_moments(whole, ["centroid"]).select("centroid", mean.alias("mean"), sd.alias("sd"))
    out = dominance(members, "centroid", member, "counts").join(merged, "centroid", "left")
    seeds = collapsed.select(F.col(member).alias("seed"), *[f"{g}_mode" for g in genes])
    return out.join(seeds, "seed", "left") if genes else out


def summary(out: dict[str, DataFrame]) -> DataFrame:
    """One row of metrics of ``run_pairing``."""
    reads = out["funnel"].agg(F.sum("counts").alias("reads"), F.sum(F.when(F.col("reason") == "passed", F.col("counts"))).alias("passed"))
    pairs = out["pairs"].agg(F.count("*").alias("n"), *[F.count_if(F.col("note") == n).alias(f"_{i}") for i, n in enumerate((PAIRED, HEAVY, LIGHT, RECEPTOR, LONE))])
    names = ("paired", "heavy_overlap", "light_overlap", "receptor_mismatch", "unpaired")
    unique = out["collapsed"].agg(F.count("*"))
    return reads.withColumns({**{n: pairs.select(f"_{i}").scalar() for i, n in enumerate(names)}, "unique_pairs": unique.scalar()})


def run_pairing(rows: DataFrame, extra: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The pairing analysis: funnel, pairs, pair statistics, and pairs collapsed by both CDR3s."""
    ready = prepare_reads(rows)
    good = ready.filter("reject is null")
    keep = ["header", "cdr3_nt", "vgene", "jgene", "shm", *extra]
    pairs = pair_rows(good, "code", "recomb", ["header", "cdr3_nt", "vgene"], keep, receptor="receptor")
    paired = pairs.filter(F.col("note") == PAIRED)
    keys = ["heavy_cdr3_nt", "light_cdr3_nt"]
    return {
        "funnel": ready.groupBy(F.coalesce("reject", F.lit("passed")).alias("reason")).agg(F.count("*").alias("counts")),
        "pairs": pairs,
        "statistics": pairs.groupBy("note").agg(F.count("*").alias("counts")),
        "collapsed": collapse(paired, keys, ["code", "pair"], ["heavy_vgene", "heavy_jgene", "light_vgene", "light_jgene"], "heavy_shm", ["code"]),
    }


def back_to_reads(pairs: DataFrame, collapsed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Each read's pair key with its cluster's dominance and confidence: read to pair to cluster."""
    keys = ["heavy_cdr3_nt", "light_cdr3_nt"]
    joined = pairs.join(collapsed.select(*keys), keys, "left_semi").join(clusters, "heavy_cdr3_nt", "left")
    sides = F.explode(F.array("heavy_header", "light_header"))
    return joined.select(sides.alias("header"), F.concat_ws(":", *keys).alias("pair_key"), "cluster", "dominance", "confidence").filter("header is not null")
