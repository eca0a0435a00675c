"""One query for each operator on the driver's tables, with the SQL that it must equal.

``QUERIES`` maps a name to a function of (session, folder), ``SQL`` to the same
result as DuckDB SQL where SQL can express it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import convert, genes, motif, sequences
from .operators import annotate, barcode, cluster, pairing, repertoire, stats, store
from .plans.filters import compile_filter, intersect_ids
from .plans.pipeline import run_pipeline
from .plans.session import Query, Session, with_duplicated_fields
from .sources import readers, writers
from .streaming import events as streams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Filters, projections, sorts


@query("""select l_orderkey, l_linenumber, l_quantity from lineitem
where (l_returnflag = 'R' or l_quantity > 45) and l_linestatus in ('F', 'O') and l_orderkey % 7 = 3 and not (l_discount >= 0.05) and l_tax is not null and l_linenumber <> 4""")
def find_filter_project(spark, sf):
    doc = {"$or": [{"l_returnflag": "R"}, {"l_quantity": {"$gt": 45}}], "l_linestatus": {"$in": ["F", "O"]}, "l_orderkey": {"$mod": [7, 3]}, "l_discount": {"$not": {"$gte": 0.05}}, "l_tax": {"$exists": True}, "l_linenumber": {"$ne": 4}}
    return Query(table(spark, sf, "lineitem")).where(doc).project(["l_orderkey", "l_linenumber", "l_quantity"]).df


@query("select o_orderkey, o_orderstatus from orders where o_totalprice between 1000 and 200000 and o_orderstatus not in ('P') and not (o_custkey < 100 or o_orderpriority = '5-LOW')")
def find_ranges_nor(spark, sf):
    doc = {"o_totalprice": {"$gte": 1000, "$lte": 200000}, "o_orderstatus": {"$nin": ["P"]}, "$nor": [{"o_custkey": {"$lt": 100}}, {"o_orderpriority": "5-LOW"}]}
    return Query(table(spark, sf, "orders")).where(doc).project({"o_orderkey": 1, "o_orderstatus": 1}).df


@query("select p_partkey, p_name from part where regexp_matches(p_name, '^(blue|red) .*t$') or regexp_matches(lower(p_type), 'promo')")
def find_regex(spark, sf):
    return Query(table(spark, sf, "part")).where({"$or": [{"p_name": {"$regex": "^(blue|red) .*t$"}}, {"p_type": {"$regex": "PROMO", "$options": "i"}}]}).project(["p_partkey", "p_name"]).df


@query("select * exclude (p_retailprice, p_size) from part where p_size > 40")
def project_exclude(spark, sf):
    return Query(table(spark, sf, "part")).where({"p_size": {"$gt": 40}}).project({"p_retailprice": 0, "p_size": 0}).df


@query("select p_partkey, p_name from part where list_contains(string_split(p_name, ' '), 'blue')")
def array_any_match(spark, sf):
    df = table(spark, sf, "part").withColumn("words", F.split("p_name", " "))
    return df.filter(compile_filter({"words": "blue"}, df.schema)).select("p_partkey", "p_name")


@query("select p_partkey, string_split(p_name, ' ')[2] as second from part where string_split(p_name, ' ')[1] = 'red' and len(string_split(p_name, ' ')) = 2")
def array_positions(spark, sf):
    df = table(spark, sf, "part").withColumn("words", F.split("p_name", " "))
    return df.filter(compile_filter({"words.0": "red", "words": {"$size": 2}}, df.schema)).select("p_partkey", F.get("words", F.lit(1)).alias("second"))


@query("select o_orderkey, o_custkey from orders order by o_custkey desc, o_orderkey limit 50 offset 20")
def sort_skip_limit(spark, sf):
    return Query(table(spark, sf, "orders")).sort([("o_custkey", -1), ("o_orderkey", 1)]).skip(20).limit(50).project(["o_orderkey", "o_custkey"]).df


@query("select count(*) as all_rows, 25 as limited from (select 1 from orders where o_orderstatus = 'F')")
def count_query(spark, sf):
    q = Query(table(spark, sf, "orders")).where({"o_orderstatus": "F"}).limit(25)
    return q.base.agg(F.count("*").alias("all_rows")).withColumn("limited", q.df.agg(F.count("*").cast("int")).scalar())


@query("select distinct unnest(string_split(p_name, ' ')) as value from part")
def distinct_array_values(spark, sf):
    return Query(table(spark, sf, "part").withColumn("words", F.split("p_name", " "))).distinct("words")


# Aggregations


@query("select event_type, array_to_string(list_sort(list(distinct user_id::varchar)), ',') as users from events where event_type is not null group by event_type")
def distinct_values(spark, sf):
    df = table(spark, sf, "events").withColumn("user", F.col("user_id").cast("string"))
    return repertoire.distinct_with_sets(df, "event_type", "user").select("event_type", F.array_join("user_set", ",").alias("users"))


@query("select l_returnflag, l_linestatus, count(*) as COUNTS, arg_min(l_suppkey, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) as l_suppkey from lineitem group by all having count(*) > 100")
def count_unique_values(spark, sf):
    return repertoire.count_unique(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], more_than=100)


def _parts(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_type", F.split("p_name", " ").alias("v"), F.split("p_brand", "#").alias("j"))


@query("select string_split(p_name, ' ')[1] as gene, p_type, count(*) as counts from part group by all")
def usage_first(spark, sf):
    return repertoire.usage(_parts(spark, sf), "v", ["p_type"])


@query("select gene, p_type, count(*) as counts from part, unnest(string_split(p_name, ' ')) as x(gene) group by all")
def usage_all(spark, sf):
    return repertoire.usage(_parts(spark, sf), "v", ["p_type"], first_only=False)


@query("select v.v as vgene, j.j as jgene, count(*) as counts from part, unnest(string_split(p_name, ' ')) as v(v), unnest(string_split(p_brand, '#')) as j(j) group by all")
def usage_pair(spark, sf):
    return repertoire.pair_usage(_parts(spark, sf), "v", "j", first_only=False)


@query("select string_split(p_name, ' ')[1] as vgene, string_split(p_brand, '#')[2] as jgene, p_type, count(*) as counts from part group by all")
def usage_pair_first(spark, sf):
    df = _parts(spark, sf).withColumn("j", F.slice("j", 2, 1))
    return repertoire.pair_usage(df, "v", "j", ["p_type"])


@query("select length(text)::bigint as length, lang, count(*) as counts from documents where length(text) > 2 and length(text) % 3 = 0 group by all")
def length_distribution(spark, sf):
    df = table(spark, sf, "documents").withColumn("n", F.length("text").cast("long"))
    return repertoire.length_distribution(df, "n", ["lang"], multiple_of_three=True, at_least=3)


@query("""with m as (select * from orders where o_orderstatus <> 'P')
select o_orderpriority as _id, count(*) as n, min(o_custkey) as low, arg_min(o_orderkey, (o_custkey, o_orderkey)) as first_key from m group by 1 having count(*) > 5""")
def pipeline_generic(spark, sf):
    stages = [{"$match": {"o_orderstatus": {"$ne": "P"}}}, {"$sort": {"o_custkey": 1, "o_orderkey": 1}}, {"$group": {"_id": "$o_orderpriority", "n": {"$sum": 1}, "low": {"$min": "$o_custkey"}, "first_key": {"$first": "$o_orderkey"}}}, {"$match": {"n": {"$gt": 5}}}]
    return run_pipeline(table(spark, sf, "orders"), stages).withColumn("n", F.col("n").cast("long"))


@query("""select w as word, t as kind, count(*) as n from (select unnest(string_split(p_name, ' ')) as w, upper(p_type) as t from part) group by all order by n desc, word, kind limit 12 offset 3""")
def pipeline_unwind(spark, sf):
    df = table(spark, sf, "part").withColumn("words", F.split("p_name", " "))
    stages = [{"$unwind": "$words"}, {"$project": {"w": "$words", "t": {"$toUpper": "$p_type"}}}, {"$group": {"_id": {"w": "$w", "t": "$t"}, "n": {"$sum": 1}}}, {"$sort": {"n": -1, "_id.w": 1, "_id.t": 1}}, {"$skip": 3}, {"$limit": 12}, {"$project": {"word": "$_id.w", "kind": "$_id.t", "n": 1}}]
    return run_pipeline(df, stages).select("word", "kind", F.col("n").cast("long").alias("n"))


@query("select l_returnflag, l_linestatus, count(*) as counts from lineitem group by all")
def analysis_counters(spark, sf):
    return repertoire.analysis_counters(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("""select field, datatype, array_to_string(list_sort(list(distinct p_type)), ',') as analyses from (
  select p_type, 'p_name' as field, 'string' as datatype from part where p_name is not null union all
  select p_type, 'p_size', 'int' from part where p_size is not null union all
  select p_type, 'p_retailprice', 'double' from part where p_retailprice is not null) group by all""")
def schema_profile(spark, sf):
    out = repertoire.schema_profile(table(spark, sf, "part"), "p_type", ["p_name", "p_size", "p_retailprice"])
    return out.withColumn("analyses", F.array_join("analyses", ","))


@query("select p_brand, sum(p_size)::bigint as counts from part group by all")
def sum_by_value(spark, sf):
    return repertoire.sum_by_value(table(spark, sf, "part"), "p_brand", "p_size")


# Joins


@query("select o_orderkey, o_custkey from orders where exists (select 1 from customer where c_custkey = o_custkey and c_mktsegment = 'MACHINERY' and c_nationkey in (1, 2, 3))")
def semi_join_metadata(spark, sf):
    c = table(spark, sf, "customer")
    ids = c.filter(compile_filter({"c_mktsegment": "MACHINERY", "c_nationkey": {"$in": [1, 2, 3]}}, c.schema)).select(F.col("c_custkey").alias("o_custkey"))
    return table(spark, sf, "orders").join(ids, "o_custkey", "left_semi").select("o_orderkey", "o_custkey")


def _session(spark, sf) -> Session:
    """Customers as experiments that their nation and market segment may read, orders as documents."""
    exps = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("_id"),
        F.col("c_mktsegment").alias("PROJECT_NAME"),
        F.col("c_name").alias("EXPERIMENT_NAME"),
        F.lit("Homo sapiens").alias("SPECIES"),
        F.array(F.concat(F.lit("lab_"), F.col("c_nationkey")), F.when(F.col("c_acctbal") > 9000, "all").otherwise("none")).alias("READ_ACCESS"),
        F.array(F.concat(F.lit("user"), F.col("c_nationkey"))).alias("OWNERS_OF_EXPERIMENT"),
        F.lit(True).alias("CURATED"),
        F.col("c_nationkey").cast("long").alias("SEQ_COUNT"),
    )
    seqs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("_id"), F.col("o_orderkey").alias("SEQ_ID"), F.col("o_custkey").cast("string").alias("EXP_ID"), F.col("o_orderstatus").alias("ANALYSIS_NAME"), F.col("o_orderpriority").alias("RECOMBINATION_TYPE"), F.struct(F.col("o_totalprice").alias("PRICE")).alias("DATA"))
    return Session(seqs, with_duplicated_fields(exps), {"user": "user7", "lab": ["7"]})


@query("select o_orderkey as _id, o_orderpriority as RECOMBINATION_TYPE from orders join customer on o_custkey = c_custkey where (c_nationkey = 7 or c_acctbal > 9000) and c_mktsegment = 'MACHINERY' and o_orderstatus in ('F', 'O')")
def access_control(spark, sf):
    q = _session(spark, sf).sequences(exps_query={"PROJECT_NAME": "Machin-ery"}, analysis=["F", "O"], fields=["RECOMBINATION_TYPE"])
    return q.df.select("_id", "RECOMBINATION_TYPE")


@query("select c_mktsegment as project, count(*) as n, count(*) filter (c_nationkey = 7) as owned from customer where c_nationkey = 7 or c_acctbal > 9000 group by all")
def metadata_getters(spark, sf):
    return _session(spark, sf).with_ownership().groupBy(F.col("PROJECT_NAME").alias("project")).agg(F.count("*").alias("n"), F.count_if("OWNED").alias("owned"))


@query("select array_to_string(list_sort(list(distinct c_mktsegment)), ',') as PROJECT_NAME, 'lab_1' as some_lab from customer where c_nationkey = 7 or c_acctbal > 9000")
def distinct_metadata(spark, sf):
    return _session(spark, sf).distinct_metadata(["PROJECT_NAME"]).select(F.array_join("PROJECT_NAME", ",").alias("PROJECT_NAME"), F.lit("lab_1").alias("some_lab"))


@query("select l.doc_id, quality, n_chars, lang from labels l left join documents d on l.doc_id = d.doc_id")
def raw_lookup(spark, sf):
    raw = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    return table(spark, sf, "labels").join(raw, "doc_id", "left").select("doc_id", "quality", "n_chars", "lang")


@query("""select o_orderkey, o_orderstatus, array_to_string(list_sort(list(l_linenumber || ':' || l_partkey) filter (l_orderkey is not null)), ',') as lines, count(l_orderkey) as n
from orders left join lineitem on l_orderkey = o_orderkey group by all""")
def group_by_parent(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "l_linenumber", "l_partkey"))), ",").alias("lines"), F.count("*").alias("n"))
    out = table(spark, sf, "orders").join(lines, "o_orderkey", "left")
    return out.select("o_orderkey", "o_orderstatus", "lines", F.coalesce("n", F.lit(0)).alias("n"))


_PAIRS_SQL = """with r as (
  select conv_id, turn, case role when 'user' then 'VDJ' when 'assistant' then 'VJ' else 'N/A' end as chain, (row_number() over (partition by conv_id order by turn, role, text) - 1) // 2 as pair from conversations where conv_id is not null),
p as (select conv_id, pair, count(*) as n, count(*) filter (chain = 'VDJ') as h, count(*) filter (chain = 'VJ') as l,
  min(turn) filter (chain = 'VDJ') as heavy_turn, min(turn) filter (chain = 'VJ') as light_turn from r group by all),
q as (select *, case when n < 2 then 'CORRESPONDING READ FILE DID NOT PASS FILTERS' when h = 2 then 'OverlapError: heavy' when l = 2 then 'OverlapError: light' when h = 1 and l = 1 then 'paired' else 'InvalidChain' end as note from p)
"""


def _pairs(spark, sf):
    chain = F.when(F.col("role") == "user", "VDJ").when(F.col("role") == "assistant", "VJ").otherwise("N/A")
    df = table(spark, sf, "conversations").withColumn("chain", chain)
    return pairing.pair_rows(df, "conv_id", "chain", ["turn", "role", "text"], ["turn"])


@query(_PAIRS_SQL + "select conv_id, pair, note, heavy_turn, light_turn from q")
def pair_by_code(spark, sf):
    return _pairs(spark, sf)


@query(_PAIRS_SQL + "select note, count(*) as counts from q group by all")
def pair_error_counts(spark, sf):
    return _pairs(spark, sf).groupBy("note").agg(F.count("*").alias("counts"))


@query("""select l_partkey, l_suppkey, count(*) as counts, round(avg(l_quantity), 3) as mean,
case when count(*) > 1 then round(sqrt(greatest((round(sum(l_quantity * l_quantity), 6) - round(sum(l_quantity) * sum(l_quantity) / count(*), 6)) / (count(*) - 1), 0)), 3) end as sd
from lineitem group by l_partkey, l_suppkey""")
def collapse_moments(spark, sf):
    out = pairing.collapse(table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"], ["l_orderkey", "l_linenumber"], value="l_quantity")
    return out.select("l_partkey", "l_suppkey", "counts", "mean", "sd")


@query("select l_returnflag, count(l_quantity) as n, sum(l_quantity) as s1, sum(l_quantity * l_quantity) as s2 from lineitem group by all")
def merged_moments(spark, sf):
    parts = pairing.moments(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return pairing.merge_moments(parts, ["l_returnflag"])


@query("""with c as (select p_brand, p_type, count(*) as n from part group by all), r as (select *, dense_rank() over (partition by p_brand order by n desc) as r from c)
select p_brand, array_to_string(list_sort(list(p_type)), ',') as p_type_mode, max(n) as p_type_count from r where r = 1 group by all""")
def mode_with_ties(spark, sf):
    return pairing.modes(table(spark, sf, "part"), ["p_brand"], "p_type")


@query("""with c as (select user_id, event_type, count(*) as n from events group by all),
r as (select *, row_number() over (partition by user_id order by n desc, event_type) as r from c)
select user_id, count(*) as size, sum(n)::bigint as total_counts, max(event_type) filter (r = 1) as seed, max(n) filter (r = 1) as seed_counts,
cast(100 * max(n) filter (r = 1) // sum(n) as int) as dominance,
case when max(n) filter (r = 2) is null then 100 else cast(floor(100 - 100.0 * max(n) filter (r = 2) / max(n) filter (r = 1)) as int) end as confidence from r group by all""")
def dominance_confidence(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return pairing.dominance(counts, "user_id", "event_type", "n")


# Statistics


@query("""with c as (select user_id, event_type, count(*) as n from events group by all), p as (select *, n / sum(n) over (partition by user_id) as p from c)
select user_id, count(*) as richness, count(*) filter (n >= 2) as seen_twice, round(sum(-p * ln(p)), 6) as shannon, round(exp(sum(-p * ln(p))), 6) as shannon_effective,
round(1 - sum(p * p), 6) as gini_simpson, round(1 / sum(p * p), 6) as simpson_effective from p group by all""")
def diversity(spark, sf):
    out = stats.diversity(table(spark, sf, "events"), "event_type", ["user_id"])
    # A sum of logarithms may leave -0.0 for a single class.
    return out.select("user_id", "richness", "seen_twice", *[(F.round(c, 6) + 0.0).alias(c) for c in ("shannon", "shannon_effective", "gini_simpson", "simpson_effective")])


@query("""with c as (select l_partkey, count(*) as n from lineitem group by all)
select t as threshold, round(avg(case when n >= t then 1.0 else 0.0 end), 6) as share from c, unnest([1, 2, 8, 16, 50, 100, 500, 1000]) as x(t) group by all""")
def count_cdf(spark, sf):
    counts = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n"))
    return stats.count_cdf(counts, "n").withColumn("share", F.round("share", 6))


@query("""with c as (select p_brand, count(*) as n from part group by all)
select p_brand, n, row_number() over w as rank, round(n / sum(n) over (), 6) as share, round(sum(n) over w / sum(n) over (), 6) as cumulative from c window w as (order by n desc, p_brand rows unbounded preceding)""")
def rank_abundance(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return stats.rank_abundance(counts, "p_brand", "n").withColumns({c: F.round(c, 6) for c in ("share", "cumulative")})


@query("select p_brand, count(*) filter (p_type = 'ECONOMY') as ECONOMY, count(*) filter (p_type = 'PROMO') as PROMO, count(*) filter (p_type = 'SMALL') as SMALL, count(*) as TOTAL from part group by all")
def usage_pivot(spark, sf):
    return stats.count_table(table(spark, sf, "part"), ["p_brand"], "p_type", ["ECONOMY", "PROMO", "SMALL"])


@query("""with c as (select l_returnflag, l_linestatus, count(*) filter (l_linenumber = 1) as a, count(*) filter (l_linenumber = 2) as b, count(*) as t from lineitem group by all)
select l_returnflag, l_linestatus, round(a / sum(a) over (partition by l_linestatus), 6) as "1", round(b / sum(b) over (partition by l_linestatus), 6) as "2", round(t / sum(t) over (partition by l_linestatus), 6) as TOTAL from c""")
def usage_frequency(spark, sf):
    counts = stats.count_table(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_linenumber", [1, 2])
    out = stats.frequencies(counts, ["1", "2", "TOTAL"], ["l_linestatus"])
    return out.select("l_returnflag", "l_linestatus", *[F.round(f"`{c}`", 6).alias(c) for c in ("1", "2", "TOTAL")])


@query("select p_type, coalesce(sum(p_size) filter (p_brand = 'Brand#1'), 0)::bigint as \"Brand#1\", coalesce(sum(p_size) filter (p_brand = 'Brand#2'), 0)::bigint as \"Brand#2\" from part group by all")
def gene_matrix(spark, sf):
    return stats.matrix(table(spark, sf, "part"), "p_type", "p_brand", ["Brand#1", "Brand#2"], "p_size")


@query("with u as (select distinct lang, text from documents where length(text) > 2) select lang, count(*) as n_unique, round(avg(length(text)), 4) as mean_length, round(stddev_samp(length(text)), 4) as sd_length from u group by all")
def length_stats(spark, sf):
    return stats.length_stats(table(spark, sf, "documents"), "text", ["lang"]).withColumns({c: F.round(c, 4) for c in ("mean_length", "sd_length")})


@query("""select p_name, arg_min(p_brand, p_partkey) as p_brand, count(*) as TOTAL, count(*) filter (p_type = 'ECONOMY') as ECONOMY, count(*) filter (p_type = 'LARGE') as LARGE from part group by all""")
def unique_sequences(spark, sf):
    return stats.unique_sequences(table(spark, sf, "part"), "p_name", "p_type", ["ECONOMY", "LARGE"], ["p_partkey"], ["p_brand"])


@query("select source, count(*) as sequences, count(*) filter (length(text) > 0) as results, count(*) filter (lang = 'en') as english, count(*) filter (contains(text, '*')) as stops from documents group by all")
def file_funnel(spark, sf):
    return stats.file_funnel(table(spark, sf, "documents"), "source", results=F.length("text") > 0, english=F.col("lang") == "en", stops=F.col("text").contains("*"))


@query("""select case when coalesce(text, '') = '' then 'missing' when contains(text, '*') then 'stop' when regexp_matches(text, '[#$%|]') then 'characters' when lang not in ('en', 'fr') then 'language' when length(text) < 200 then 'short' else 'passed' end as reason, count(*) as counts from documents group by all""")
def reject_funnel(spark, sf):
    rules = [("missing", F.coalesce("text", F.lit("")) == ""), ("stop", F.col("text").contains("*")), ("characters", F.col("text").rlike("[#$%|]")), ("language", ~F.col("lang").isin("en", "fr")), ("short", F.length("text") < 200)]
    return pairing.funnel(table(spark, sf, "documents"), rules)


@query("select md5(text) as key, min(doc_id) as doc_id, count(*) as reads, array_to_string(list_sort(list(distinct source)), '|') as tags from documents where text is not null group by text")
def merge_reads(spark, sf):
    out = pairing.merge_reads(table(spark, sf, "documents").filter("text is not null"), ["text"], None, "source", ["doc_id"], ["doc_id"])
    return out.select(F.md5("text").alias("key"), "doc_id", "reads", "tags")


@query("select p_type, count(*) as counts, round(100.0 * count(*) / sum(count(*)) over (), 1) as percent from part group by all")
def gene_hist_percent(spark, sf):
    return stats.share_histogram(table(spark, sf, "part"), "p_type")


# Barcodes, clusters, motifs


_CODES = [("small", "small"), ("blue", "blue"), ("bolt", "bolt"), ("reds", "red ")]


@query("select barcode, count(*) as counts from (select case when contains(p_name, 'small') then 'small' when contains(p_name, 'blue') then 'blue' when contains(p_name, 'bolt') then 'bolt' when contains(p_name, 'red ') then 'reds' else 'nomatch' end as barcode from part) group by all")
def barcode_contains(spark, sf):
    return barcode.summary(barcode.contained(table(spark, sf, "part"), "p_name", _CODES))


_HAMMING_SQL = """with c(i, label, code) as (values (0, 'bolt', 'bolt'), (1, 'blot', 'blot'), (2, 'ring', 'ring')),
d as (select p_partkey, i, label, list_sum([case when substr(right(p_name, 4), k, 1) = substr(code, k, 1) then 0 else 1 end for k in [1, 2, 3, 4]])::int as d from part, c),
b as (select p_partkey, arg_min(label, (d, i)) as label, min(d) as d from d group by all)
select p_partkey, case when d <= 2 then label else 'unmatched' end as barcode, case when d <= 2 then d end as mismatches from b"""


@query(_HAMMING_SQL)
def barcode_hamming(spark, sf):
    out = barcode.nearest(table(spark, sf, "part"), "p_name", [("bolt", "bolt"), ("blot", "blot"), ("ring", "ring")], most=2, at_end=True)
    return out.select("p_partkey", "barcode", "mismatches")


def _nucleotides(column: str):
    """Letters of a text as nucleotides, everything else dropped."""
    letters = F.regexp_replace(F.lower(column), "[^a-z]", "")
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


@query()
def motif_score(spark, sf):
    side = lambda aa: {i + 1: {a: 0.7 if a == x else 0.3 / 19 for a in "ACDEFGHIKLMNPQRSTVWY"} for i, x in enumerate(aa)}
    m = motif.Motif("IGH", side("YC"), side("WG"), 1, 0)
    reads = table(spark, sf, "benchmark").select("item_id", _nucleotides("text").alias("seq"))
    return motif.with_cdr3(reads, "seq", [m]).select("item_id", "cdr3.*")


# Sets, functions, rows


@query("select c_custkey from (select c_custkey from customer intersect select o_custkey from orders) where c_custkey not in (select c_custkey from customer where c_mktsegment = 'FURNITURE')")
def set_intersect_except(spark, sf):
    c = table(spark, sf, "customer")
    both = c.select("c_custkey").intersect(table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")))
    return both.join(c.filter("c_mktsegment = 'FURNITURE'").select("c_custkey"), "c_custkey", "left_anti")


@query("select 'VDJ' as kind, p_partkey from part where p_size < 10 union all select 'VJ', p_partkey from part where p_type = 'PROMO'")
def union_with_key(spark, sf):
    p = table(spark, sf, "part")
    return p.filter("p_size < 10").select(F.lit("VDJ").alias("kind"), "p_partkey").unionByName(p.filter("p_type = 'PROMO'").select(F.lit("VJ").alias("kind"), "p_partkey"))


@query("select n_name as id from nation where n_nationkey in (2, 3)")
def id_intersection(spark, sf):
    n = table(spark, sf, "nation")
    ids = intersect_ids([[1, 2, 3, 4], [2, 3, 4, 9]], {"$ne": 4})
    return n.filter(F.col("n_nationkey").isin(ids)).select(F.col("n_name").alias("id"))


@query("select o_orderkey || '::' || o_custkey as ID, o_orderstatus as \"STATE.STATUS\", array_to_string([o_orderpriority, o_orderstatus], ',') as \"STATE.LIST\" from orders")
def flatten_concat_id(spark, sf):
    o = table(spark, sf, "orders").select(convert.seq_exp_id("o_orderkey", "o_custkey").alias("ID"), F.struct(F.struct(F.col("o_orderstatus").alias("STATUS"), F.array("o_orderpriority", "o_orderstatus").alias("LIST")).alias("STATE")).alias("DATA"))
    return convert.flatten(o, lift="DATA", lists=",")


@query("""select p_partkey, string_split(p_brand, '#')[1] as gene, case when contains(p_name, '-') or contains(p_name, '*') then p_name else '' end as named,
array_to_string(list_sort(list_distinct(list_concat([upper(p_name)], string_split(upper(p_name), ' ')))), ',') as alleles from part""")
def gene_parse(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", genes.gene_names(F.translate("p_brand", "#", "*")).alias("gene"), genes.first_gene("p_name").alias("named"), F.array_join(genes.allele_words("p_name"), ",").alias("alleles"))


@query("""with n as (select doc_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as s from documents)
select doc_id, md5(reverse(translate(s, 'ACGT', 'TGCA'))) as flipped, (length(s) // 3)::int as codons, substr(s, 1, 3) as first_codon from n""")
def revcomp(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", _nucleotides("text").alias("s"))
    return d.select("doc_id", F.md5(sequences.reverse_complement("s")).alias("flipped"), convert.cdr_length("s").alias("codons"), F.substring("s", 1, 3).alias("first_codon"))


_AMINO = ", ".join(f"'{c}': '{a}'" for c, a in sequences.CODONS.items())


@query(f"""with n as (select item_id, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as s from benchmark)
select item_id, array_to_string([coalesce(map {{{_AMINO}}}[substr(s, 3 * i + 1, 3)], 'X') for i in range(length(s) // 3)], '') as aa from n""")
def translate(spark, sf):
    b = table(spark, sf, "benchmark").select("item_id", _nucleotides("text").alias("s"))
    return b.select("item_id", sequences.translate("s").alias("aa"))


@query("select event_id, (json_extract(props, '$.k'))::int as k, event_type from events where (json_extract(props, '$.k'))::int > 50")
def json_header(spark, sf):
    e = table(spark, sf, "events").withColumn("header", F.concat("event_type", F.lit(readers.HEADER_JSON), "props"))
    out = readers.with_header_json(e, "k int")
    return out.filter("info.k > 50").select("event_id", "info.k", F.col("header").alias("event_type"))


@query("select lower(regexp_replace(c_name, '[\\s_,;\\-/:]', '', 'g')) as plain, c_acctbal > 0 as positive, round(c_acctbal / 3, 4) as third, cast(trunc(c_acctbal) as int) as whole from customer")
def field_conversions(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(convert.index_text("c_name").alias("plain"), convert.to_bool(F.when(F.col("c_acctbal") > 0, "Yes").otherwise("no")).alias("positive"), convert.to_percent(F.col("c_acctbal") / 3).alias("third"), convert.to_int(F.col("c_acctbal").cast("string")).alias("whole"))


@query("select o_orderkey, o_orderkey || ':' || o_custkey || ':7:20' as code, '' as bare from orders")
def header_codes(spark, sf):
    head = F.concat(F.lit("M:1:F:"), F.col("o_orderkey"), F.lit(":"), F.col("o_custkey"), F.lit(":7:20"))
    return table(spark, sf, "orders").select("o_orderkey", convert.cluster_code(F.concat(head, F.lit(" 1:N:0"))).alias("code"), convert.cluster_code(head).alias("bare"))


@query("""select p_partkey, case when p_size % 7 < p_size then string_split(p_name, ' ')[1] else array_to_string(list_sort(list_distinct(string_split(p_name, ' '))), ',') end as top,
array_to_string(list_sort(list_distinct(string_split(p_name, ' '))), ',') as unscored from part""")
def top_scored_genes(spark, sf):
    names = F.translate("p_name", " ", ",")
    scores = F.concat_ws(",", "p_size", F.col("p_size") % 7)
    return table(spark, sf, "part").select("p_partkey", F.array_join(genes.top_genes(names, scores), ",").alias("top"), F.array_join(genes.top_genes(names, F.lit("x")), ",").alias("unscored"))


@query("""select kind, count(*) as n from (select case p_size % 5 when 0 then 'VDJ' when 1 then 'VJ' when 2 then 'VDJ' when 3 then 'VJ' else 'N/A' end as kind from part) group by kind""")
def recombination_types(spark, sf):
    v = F.element_at(F.array(*map(F.lit, ("IGHV1", "IGKV1", "TBV", "", "XX"))), F.col("p_size") % 5 + 1)
    j = F.when(F.col("p_size") % 5 == 3, "IGLJ2").otherwise("")
    return table(spark, sf, "part").select(genes.recombination_type(v, j).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("select c_custkey, round(c_acctbal, 3) as shm, cast(c_custkey as varchar) as inner_number, case when length(c_mktsegment) > 0 then length(c_mktsegment) end as n, 100 - c_acctbal as rest from customer")
def shm_fields(spark, sf):
    c = table(spark, sf, "customer")
    text = F.concat(F.format_string("%.2f", "c_acctbal"), F.lit(" (9)"))
    return c.select("c_custkey", convert.parse_shm(text).alias("shm"), convert.in_parentheses(F.concat(F.lit("7 ("), F.col("c_custkey"), F.lit(")"))).alias("inner_number"), convert.length_or_null("c_mktsegment").alias("n"), convert.shm_from_identity("c_acctbal").alias("rest"))


@query("""select c_custkey as SEQ_ID, array_to_string(list_sort(list(distinct o_orderstatus || '.' || o_orderpriority) filter (o_orderkey is not null)), ',') as analyses from customer
left join (select o_custkey, o_orderkey, o_orderstatus, o_orderpriority from orders where o_orderkey in (select min(o_orderkey) from orders group by o_custkey, o_orderstatus, o_orderpriority)) on o_custkey = c_custkey group by c_custkey""")
def reads_with_analyses(spark, sf):
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    first = o.groupBy("o_custkey", "o_orderstatus", "o_orderpriority").agg(F.min("o_orderkey").alias("o_orderkey"))
    kind = "struct<KEY:bigint>"
    raw = c.select(F.col("c_custkey").alias("SEQ_ID"), F.lit("e").alias("EXP_ID"), F.lit("@SEQ").alias("ANALYSIS_NAME"), F.lit(None).cast("string").alias("RECOMBINATION_TYPE"), F.struct(F.col("c_custkey").alias("KEY")).cast(kind).alias("DATA"))
    rows = first.select(F.col("o_custkey").alias("SEQ_ID"), F.lit("e").alias("EXP_ID"), F.col("o_orderstatus").alias("ANALYSIS_NAME"), F.col("o_orderpriority").alias("RECOMBINATION_TYPE"), F.struct(F.col("o_orderkey").alias("KEY")).cast(kind).alias("DATA"))
    exps = spark.createDataFrame([("e", "P", "E", "S", ["all"], ["u"], 1, True)], "_id string, PROJECT_NAME string, EXPERIMENT_NAME string, SPECIES string, READ_ACCESS array<string>, OWNERS_OF_EXPERIMENT array<string>, SEQ_COUNT int, CURATED boolean")
    out = Session(raw.unionByName(rows), with_duplicated_fields(exps), {"user": "u"}).reads(same_document=True)
    return out.select("SEQ_ID", F.array_join(F.array_sort(F.map_keys("ANALYSES")), ",").alias("analyses"))


# Writes


@query("""with a as (select * from orders where o_orderkey % 3 <> 0), b as (select o_orderkey, upper(o_orderstatus) || '!' as s from orders where o_orderkey % 2 = 0)
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey, coalesce(b.s, a.o_orderstatus) as o_orderstatus, a.o_custkey from a full join b on a.o_orderkey = b.o_orderkey""")
def upsert_merge(spark, sf):
    o = table(spark, sf, "orders")
    old = o.filter("o_orderkey % 3 <> 0").select("o_orderkey", "o_orderstatus", "o_custkey")
    new = o.filter("o_orderkey % 2 = 0").select("o_orderkey", F.concat(F.upper("o_orderstatus"), F.lit("!")).alias("o_orderstatus"))
    return store.upsert(old, new, ["o_orderkey"])


@query("select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_nationkey < 5)")
def anti_delete(spark, sf):
    gone = table(spark, sf, "customer").filter("c_nationkey < 5").select(F.col("c_custkey").alias("o_custkey"))
    return store.delete(table(spark, sf, "orders"), gone, ["o_custkey"]).select("o_orderkey", "o_custkey")


@query("""select c_nationkey as exp, c_custkey as id, 'new' as state from customer where c_nationkey in (1, 2) union all select c_nationkey, c_custkey, 'old' from customer where c_nationkey not in (1, 2)""")
def insert_replace(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("exp"), F.col("c_custkey").alias("id"))
    return store.insert(c.withColumn("state", F.lit("old")), c.filter("exp in (1, 2)").withColumn("state", F.lit("new")), "exp")


@query("""with w as (select p_brand, p_type, dense_rank() over (partition by p_brand order by p_type) - 1 as n, p_partkey from part) select p_partkey, p_brand, n::int as p_type from w""")
def dictionary_encode(spark, sf):
    coded, _ = store.encode_strings(table(spark, sf, "part").select("p_partkey", "p_brand", "p_type"), "p_type", "p_brand")
    return coded.select("p_partkey", "p_brand", "p_type")


@query("select replace(replace(replace(p_brand || '.' || p_type, ' ', '_'), ',', '_'), '/', '_') as part, count(*) as documents from part group by all")
def split_counts(spark, sf):
    return writers.part_counts(table(spark, sf, "part"), ["p_brand", "p_type"])


@query("select p_partkey, p_name from part where length(regexp_replace(p_name, '[^n-z]', '', 'g')) * 100 >= 40 * length(p_name)")
def quality_filter(spark, sf):
    # A name as a quality string: letters from n on are good bases.
    return annotate.quality_filter(table(spark, sf, "part"), "p_name", ord("n") - 33, 40).select("p_partkey", "p_name")


# Extensions


@query("select time_bucket(interval '1 hour', ts)::varchar as window_start, event_type, count(*) as counts, round(sum(value), 4) as total from events group by all")
def windowed_events(spark, sf):
    out = streams.windowed_counts(table(spark, sf, "events"))
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "counts", F.round("total", 4).alias("total"))


@query("select l_returnflag, l_linestatus, count(*) as counts from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_counts(spark, sf):
    return table(spark, sf, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("counts"))
