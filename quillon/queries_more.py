"""Further queries for single operators and functions, each with the SQL that it must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import alignment, convert, genes, motif, names, sequences
from .operators import alignments, annotate, barcode, cluster, pairing, store
from .pipelines import pairing_pipeline, prepare_paired, prepare_single
from .plans.filters import FieldRules, FilterError, compile_filter
from .plans.pipeline import register_accumulator, run_pipeline
from .plans.session import RAW, Dispatcher, Query, Session, with_duplicated_fields
from .queries import query, table
from .queries_files import _NT_SQL, nucleotides


def _session(spark, sf) -> Session:
    """Customers as experiments, orders as documents; open orders are raw reads."""
    c, o = table(spark, sf, "customer"), table(spark, sf, "orders")
    exps = c.select(
        F.col("c_custkey").cast("string").alias("_id"),
        F.col("c_mktsegment").alias("PROJECT_NAME"),
        F.col("c_name").alias("EXPERIMENT_NAME"),
        F.lit("Homo sapiens").alias("SPECIES"),
        F.array(F.lit("all")).alias("READ_ACCESS"),
        F.array(F.concat(F.lit("user"), F.col("c_nationkey"))).alias("OWNERS_OF_EXPERIMENT"),
        (F.col("c_nationkey") < 10).alias("CURATED"),
        (F.col("c_nationkey") * 1000).cast("long").alias("SEQ_COUNT"),
    )
    analysis = F.when(F.col("o_orderstatus") == "O", RAW).otherwise(F.col("o_orderstatus"))
    seqs = o.select(F.col("o_orderkey").alias("_id"), F.col("o_orderkey").alias("SEQ_ID"), F.col("o_custkey").cast("string").alias("EXP_ID"), analysis.alias("ANALYSIS_NAME"), F.col("o_orderpriority").alias("RECOMBINATION_TYPE"), F.struct(F.struct(F.array(F.upper("o_orderpriority")).alias("VGENES")).alias("VREGION")).alias("DATA"))
    genes_of = F.struct(F.struct(F.array(F.struct(genes.allele_words("o_orderpriority").alias("PARSED_ALLELES"))).alias("VGENES")).alias("VREGION"))
    seqs = seqs.join(o.select(F.col("o_orderkey").alias("_id"), genes_of.alias("QUERY_DATA")), "_id")
    return Session(seqs, with_duplicated_fields(exps), {"user": "user7", "write_access": True})


@query("select c_custkey::varchar as _id, c_mktsegment as PROJECT_NAME from customer where c_mktsegment = 'MACHINERY' and c_nationkey < 10 and c_nationkey * 1000 >= 3000")
def metadata_coercion(spark, sf):
    """Texts with capitals and punctuation, flags and numbers as texts become what the fields hold."""
    doc = {"PROJECT_NAME": "Machi-NERY", "CURATED": "yes", "SEQ_COUNT": {"$gte": "3,000"}}
    return _session(spark, sf).experiments(doc, fields=["PROJECT_NAME"]).df.select("_id", "PROJECT_NAME")


@query("select c_custkey::varchar as _id from customer where c_custkey in (1, 5, 7)")
def experiment_ids(spark, sf):
    s = _session(spark, sf)
    return s.experiments(exp_id=["1", "5"]).df.select("_id").unionByName(s.experiments(exp_id="7").df.select("_id"))


@query("select o_orderkey as _id from orders where o_orderstatus <> 'O' and o_orderpriority = '1-URGENT'")
def gene_redirection(spark, sf):
    """A query on the gene list goes to its parsed words, upper-cased; raw reads are left out by default."""
    return _session(spark, sf).sequences({"DATA.VREGION.VGENES": "1-urgent"}, fields=["_id"]).df.select("_id")


@query("select o_orderkey as _id from orders where o_orderstatus <> 'O' and regexp_matches(o_orderpriority, 'URG|LOW')")
def regex_redirection(spark, sf):
    return _session(spark, sf).sequences({"DATA.VREGION.VGENES": {"$regex": "urg|low"}}).df.select("_id")


@query("select o_orderkey % 7 as bucket, count(*) as n from orders where o_custkey % 10 = 3 group by all")
def custom_rules(spark, sf):
    rules = FieldRules(redirect={"CUSTOMER": "last_digit"}, convert={"CUSTOMER": lambda v: int(str(v).lstrip("#"))})
    o = table(spark, sf, "orders").withColumn("last_digit", F.col("o_custkey") % 10)
    return o.filter(compile_filter({"CUSTOMER": "#3"}, o.schema, rules)).groupBy((F.col("o_orderkey") % 7).alias("bucket")).agg(F.count("*").alias("n"))


@query("select * from (values ('$where'), ('$text'), ('$near')) as t(operator)")
def refused_operators(spark, sf):
    schema = table(spark, sf, "part").schema
    refused = []
    for op, doc in (("$where", {"$where": "1"}), ("$text", {"$text": {"$search": "x"}}), ("$near", {"p_name": {"$near": [1, 2]}}), ("$comment", {"$comment": "fine"})):
        try:
            compile_filter(doc, schema)
        except FilterError:
            refused.append((op,))
    return spark.createDataFrame(refused, "operator string")


@query("select c_custkey::varchar as _id, c_name as EXPERIMENT_NAME from customer where c_mktsegment = 'BUILDING' order by _id limit 5")
def dispatched_chain(spark, sf):
    steps = [{"command": "experiments", "args": [{"PROJECT_NAME": "building"}]}, {"command": "sort", "args": [[("_id", 1)]]}, {"command": "limit", "args": [5]}, {"command": "project", "args": [["_id", "EXPERIMENT_NAME"]]}]
    return Dispatcher(_session(spark, sf)).run(steps).df


@query("""with r as (select o_orderkey from orders where o_orderstatus = 'O' order by o_orderkey limit 40)
select o_orderkey as SEQ_ID, o_custkey::varchar as EXP_ID from r join orders using (o_orderkey)""")
def limited_reads(spark, sf):
    return _session(spark, sf).reads(limit=40).select("SEQ_ID", "EXP_ID")


@query("""select o_orderpriority as _id, arg_min(o_orderkey, (o_orderstatus, -o_custkey, o_orderkey)) as first_key, arg_max(o_orderkey, (o_orderstatus, -o_custkey, o_orderkey)) as last_key,
round(exp(avg(ln(o_totalprice))), 4) as geo from orders group by 1""")
def pipeline_mixed_sort(spark, sf):
    register_accumulator("$geoMean", lambda c: F.exp(F.avg(F.ln(c))))
    stages = [{"$sort": {"o_orderstatus": 1, "o_custkey": -1, "o_orderkey": 1}}, {"$group": {"_id": "$o_orderpriority", "first_key": {"$first": "$o_orderkey"}, "last_key": {"$last": "$o_orderkey"}, "geo": {"$geoMean": "$o_totalprice"}}}]
    return run_pipeline(table(spark, sf, "orders"), stages).withColumn("geo", F.round("geo", 4))


@query("select p_type as _id, p_name as first_name from (select p_type, p_name, row_number() over (partition by p_type order by p_name desc, p_size, p_partkey) as r from part) where r = 1")
def pipeline_text_descending(spark, sf):
    stages = [{"$sort": {"p_name": -1, "p_size": 1, "p_partkey": 1}}, {"$group": {"_id": "$p_type", "first_name": {"$first": "$p_name"}}}]
    return run_pipeline(table(spark, sf, "part"), stages)


@query("select 'p_type' as field, p_type as value, count(*) as counts from part group by all union all select 'words', w, count(*) from (select p_partkey, unnest(list_distinct(string_split(p_name, ' '))) as w from part) group by all")
def facets(spark, sf):
    return Query(table(spark, sf, "part").withColumn("words", F.split("p_name", " "))).facets(["p_type", "words"])


@query("select p_partkey from part where (contains(lower(p_name), 'ring') and contains(lower(p_name), 'blue')) or (contains(lower(p_type), 'ring') and contains(lower(p_type), 'blue'))")
def searched_rows(spark, sf):
    return Query(table(spark, sf, "part")).search("Blue RING", ["p_name", "p_type"]).project(["p_partkey"]).df


@query("select unnest([20, 40, 60, 80, 100]) as percent, 25 as rows")
def row_progress(spark, sf):
    told: list[int] = []
    n = sum(1 for _ in Query(table(spark, sf, "nation")).rows(progress=told.append, every=20))
    return spark.createDataFrame([(x, n) for x in told], "percent int, rows int")


@query("select c_custkey, case when c_custkey % 3 = 0 then c_name when c_custkey % 3 = 1 then c_name || '.xyz' else c_name || '.v1' end as stem from customer")
def file_names(spark, sf):
    k = F.col("c_custkey") % 3
    name = F.concat("c_name", F.when(k == 0, ".fasta").when(k == 1, ".xyz").otherwise(".v1.json"))
    return table(spark, sf, "customer").select("c_custkey", names.without_extension(name).alias("stem"))


@query("select * from (values ('PROJECT_NAME', 'My Project'), ('READ_ACCESS', 'user1,user2'), ('SEARCHED', 'myproject'), ('STATE', 'user1 2024-01-01 true 0'), ('TAKEN', 'refused')) as t(field, value)")
def experiment_fields(spark, sf):
    existing = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("PROJECT_NAME"), F.col("c_name").alias("EXPERIMENT_NAME"), F.array(F.concat(F.lit("user"), "c_nationkey")).alias("OWNERS_OF_EXPERIMENT"))
    needed = ["PROJECT_NAME", "EXPERIMENT_NAME", "OWNERS_OF_EXPERIMENT"]
    make = lambda doc: store.experiment_document(doc, {"user": "user1", "curator": True}, needed, [f"user{i}" for i in range(25)], existing, "2024-01-01")
    doc = make({"PROJECT_NAME": "My, Pro/ject;", "EXPERIMENT_NAME": "E", "OWNERS_OF_EXPERIMENT": ["user1"], "READ_ACCESS": ["user2"], "LAB_NOTES": ""})
    first = existing.orderBy("EXPERIMENT_NAME").first()
    try:
        make({"PROJECT_NAME": first.PROJECT_NAME.lower(), "EXPERIMENT_NAME": f"{first.EXPERIMENT_NAME} ", "OWNERS_OF_EXPERIMENT": first.OWNERS_OF_EXPERIMENT})
        taken = "accepted"
    except store.InvalidInsert:
        taken = "refused"
    state = f"{doc['UPLOADED_BY']} {doc['EXPERIMENT_CREATION_DATE']} {str(doc['CURATED']).lower()} {doc['SEQ_COUNT']}"
    rows = [("PROJECT_NAME", doc["PROJECT_NAME"]), ("READ_ACCESS", ",".join(doc["READ_ACCESS"])), ("SEARCHED", doc["DUPLICATED_FIELDS"]["PROJECT_NAME"]), ("STATE", state), ("TAKEN", taken)]
    return spark.createDataFrame(rows, "field string, value string")


# Functions


@query(f"""with s as (select p_partkey, 'GCG' || {_NT_SQL.format(c="p_name")} || 'TGGGG' || {_NT_SQL.format(c="p_type")} as s from part),
p as (select *, list_max([i for i in range(1, length(s) - 3) if substr(s, i, 4) = 'TGGG']) as place from s)
select p_partkey, substr(s, 1, place - 1) as cdr3_nt, substr(s, place) as fr4_nt, ((place - 1) % 3 + 1)::int as fr4_frame from p""")
def fr4_positions(spark, sf):
    """FR4 at the last match of its pattern in the read, and the CDR3 before it."""
    rows = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("GCG"), nucleotides("p_name"), F.lit("TGGGG"), nucleotides("p_type")).alias("sequence"))
    none = F.array().cast("array<struct<query:string,germline:string,start:int>>")
    rows = rows.select("p_partkey", "sequence", F.lit(1).alias("cdr3_start"), F.length("sequence").alias("end"), none.alias("j_hits"))
    return alignment.with_fr4(rows, "TGGG").select("p_partkey", "cdr3_nt", "fr4_nt", "fr4_frame")


@query("""select p_partkey, array_to_string(list_sort(list_distinct([x for x in regexp_split_to_array(upper(p_name || '*01, (' || p_type || ')'), '[ ;,()\\[\\]*]') if x <> ''])), ',') as parts,
p_name || ',' || p_type as cleaned from part""")
def gene_words(spark, sf):
    p = table(spark, sf, "part")
    name = F.concat("p_name", F.lit("*01, ("), "p_type", F.lit(")"))
    listed = F.concat("p_name", F.lit(" or "), "p_type", F.lit(" (see comment)"))
    return p.select("p_partkey", F.array_join(F.array_sort(genes.allele_parts(name)), ",").alias("parts"), genes.clean_gene_list(listed).alias("cleaned"))


@query("""select kind, count(*) as n from (select case p_size % 4 when 0 then 'VJ' when 1 then 'VDJ' when 2 then 'VDJ' else 'UNK' end as kind from part) group by kind""")
def isotype_chains(spark, sf):
    i = F.element_at(F.array(*map(F.lit, ("igkc", "IGHG1", "TRBC", "mouse"))), F.col("p_size") % 4 + 1)
    return table(spark, sf, "part").select(genes.recombination_of_isotype(i).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("""with s as (select p_partkey, string_split(upper(p_name), ' ') as g, p_size % 3 as a, p_size % 2 as b from part)
select p_partkey, array_to_string(list_sort(list_distinct(case when a > b then [g[1]] when a < b then [g[2]] else g end)), ',') as top,
case when a = b then null when a > b then g[2] else g[1] end as rest from s""")
def split_scores(spark, sf):
    p = table(spark, sf, "part")
    entries = genes.split_by_top_score(F.split("p_name", " "), F.array(F.col("p_size") % 3, F.col("p_size") % 2))
    at = lambda i: F.array_join(F.get(entries, F.lit(i))["PARSED_ALLELES"], ",")
    return p.select("p_partkey", at(0).alias("top"), at(1).alias("rest"))


@query("select p_partkey, 'b' || p_partkey as first, 30.0::double as top, 'a' as second, 'c' as last, 3 as n from part")
def best_hits(spark, sf):
    text = F.concat(F.lit("a(20),b"), "p_partkey", F.lit("(30),c"))
    hits = genes.best_first(genes.hit_list(text))
    at = lambda i: F.get(hits, F.lit(i))
    return table(spark, sf, "part").select("p_partkey", at(0)["gene"].alias("first"), at(0)["score"].alias("top"), at(1)["gene"].alias("second"), at(2)["gene"].alias("last"), F.size(hits).alias("n"))


@query("""select p_partkey, p_size as germ_start, p_size + 100 as germ_end, 120 as length, 2 as mismatches, 1 as deletions, (p_size % 3)::int as insertions, round((3 + p_size % 3) / 120, 6) as shm from part""")
def alignment_counts(spark, sf):
    text = F.concat_ws("|", F.col("p_size"), F.col("p_size") + 100, F.lit(120), F.lit(5), F.lit(105), F.concat(F.lit("SA5GD9TSC20A"), F.repeat(F.lit("I7C"), (F.col("p_size") % 3).cast("int"))), F.lit("99;1|2|3|4|5||0"))
    return table(spark, sf, "part").select("p_partkey", genes.alignment_stats(text).alias("a")).select("p_partkey", "a.germ_start", "a.germ_end", "a.length", "a.mismatches", "a.deletions", "a.insertions", F.round("a.shm", 6).alias("shm"))


@query(f"""with s as (select p_partkey, p_name, {_NT_SQL.format(c='p_name')} as s, {_NT_SQL.format(c='p_type')} as q from part)
select p_partkey, contains(s, substr(q, 1, 1)) or contains(s, translate(substr(q, 1, 1), 'ACGT', 'TGCA')) as either,
case when regexp_matches(s, substr(q, 1, 1) || '[ATGCN]' || substr(q, 3, 1)) then '+'
     when regexp_matches(s, translate(substr(q, 3, 1), 'ACGT', 'TGCA') || '[ATGCN]' || translate(substr(q, 1, 1), 'ACGT', 'TGCA')) then '-' else '' end as strand,
regexp_matches(s, substr(q, 1, 1) || '[ATGCN]') as found, replace(replace(s, 'A', ''), 'C', '') as degapped,
not regexp_matches(upper(replace(p_name, ' ', '')), '[^ACGTRYSWKMBDHVNU]') as nucleotides, not regexp_matches(upper(replace(p_name, ' ', '')), '[^ACDEFGHIKLMNPQRSTVWYX*]') as amino_acids from s""")
def sequence_checks(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_name", nucleotides("p_name").alias("s"), nucleotides("p_type").alias("t"))
    q = F.concat(F.substring("t", 1, 1), F.lit("n"), F.substring("t", 3, 1))
    plain = F.replace("p_name", F.lit(" "), F.lit(""))
    one = F.substring("t", 1, 1)
    return rows.select(
        "p_partkey",
        (F.col("s").contains(one) | F.col("s").contains(sequences.reverse_complement(one))).alias("either"),
        sequences.strand(q, "s").alias("strand"),
        sequences.matches_with_n(F.concat(one, F.lit("N")), "s").alias("found"),
        sequences.degap("s", "AC").alias("degapped"),
        sequences.valid_nucleotides(plain).alias("nucleotides"),
        sequences.valid_amino_acids(plain).alias("amino_acids"),
    )


@query("""with r as (select p_partkey, [p_name, case when p_size % 2 = 0 then p_type else '' end, case when p_size % 3 = 0 then p_brand end] as r from part),
f as (select p_partkey, r, [i for i in [1, 2, 3] if coalesce(r[i], '') <> ''] as have from r)
select p_partkey, array_to_string([r[i] for i in have], '') as sequence, ['A', 'B', 'C'][have[1]] as five_prime, ['A', 'B', 'C'][have[len(have)]] as three_prime,
len(have) < have[len(have)] - have[1] + 1 as gap, len(have) = 3 as full_length from f""")
def region_join(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("A"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("").alias("B"), F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("C"))
    return rows.select("p_partkey", *[c.alias(k) for k, c in annotate.join_regions(["A", "B", "C"]).items()])


@query("""select c_custkey, c_custkey / nullif(c_nationkey, 0)::double as identity, round(100 * c_nationkey / nullif(c_custkey, 0)::double, 2) as shm,
case when c_nationkey % 5 = 0 then 'NO' when c_nationkey % 3 = 0 then 'MAYBE' when c_custkey % 2 = 0 and c_custkey % 3 = 0 then 'YES' when c_custkey % 2 = 0 then 'MAYBE' else 'NO' end as productive from customer""")
def rates(spark, sf):
    c = table(spark, sf, "customer")
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return c.select("c_custkey", convert.percent_identity("c_custkey", "c_nationkey").alias("identity"), convert.percent_shm("c_nationkey", "c_custkey").alias("shm"), convert.productivity(n % 5 == 0, n % 3 != 0, k % 2 == 0, k % 3 == 0).alias("productive"))


_AA = ", ".join(f"'{c}': '{a}'" for c, a in sequences.CODONS.items())


@query(f"""with s as (select p_partkey, {_NT_SQL.format(c="p_name || p_brand")} as nt from part),
t as (select p_partkey, nt, array_to_string([map {{{_AA}}}[substr(nt, 3 * i + 1, 3)] for i in range(length(nt) // 3)], '') as aa from s)
select p_partkey, length(nt) % 3 = 0 and length(nt) >= 9 and not contains(aa, '*') as productive from t""")
def cdr3_flags(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", F.concat("p_name", "p_brand").alias("x")).select("p_partkey", nucleotides("x").alias("nt"))
    return rows.select("p_partkey", convert.cdr3_productive("nt", sequences.translate("nt")).alias("productive"))


@query("""select o_orderkey, strftime(o_orderdate, '%m/%d/%y') as day, nullif(case when o_custkey % 2 = 0 then o_orderstatus else '' end, '') as status, repeat('?', length(o_orderstatus || o_orderpriority)) as quality,
lower(o_orderstatus) || ',' || lower(o_orderpriority) as words, o_custkey::varchar as single from orders""")
def text_fields(spark, sf):
    o = table(spark, sf, "orders")
    listed = F.concat_ws(" , ", "o_orderstatus", F.lit(""), F.concat(F.lit("the "), "o_orderpriority"))
    return o.select(
        "o_orderkey",
        convert.short_date("o_orderdate").alias("day"),
        convert.null_if_empty(F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderstatus")).otherwise("")).alias("status"),
        convert.default_quality(F.concat("o_orderstatus", "o_orderpriority")).alias("quality"),
        F.array_join(convert.word_list(listed, "lower", drop=("the",)), ",").alias("words"),
        convert.cluster_code_single(F.concat("o_custkey", F.lit("_"), "o_orderkey")).alias("single"),
    )


@query("select o_orderkey, [o_custkey, o_orderkey] as numbers, [o_orderpriority, o_orderstatus] as texts from orders")
def list_fields(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", convert.to_list(F.concat_ws(" ,", "o_custkey", "o_orderkey"), "long").alias("numbers"), convert.to_list(F.concat_ws("|", "o_orderpriority", "o_orderstatus")).alias("texts"))


@query("select o_orderkey, o_orderstatus as status, o_orderpriority as priority from orders")
def nested_again(spark, sf):
    flat = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("DATA.STATE.STATUS"), F.col("o_orderpriority").alias("DATA.PRIORITY"))
    return convert.nest(flat).select("o_orderkey", F.col("DATA.STATE.STATUS").alias("status"), F.col("DATA.PRIORITY").alias("priority"))


@query("select unnest([0.8, 0.85, 0.9, 0.95, 0.97])::double as cutoff")
def cutoffs(spark, sf):
    return spark.createDataFrame([(x,) for x in convert.frame_range(0.8, 0.97, 0.05)], "cutoff double")


# Annotated rows


_REF_SQL = """with r as (select p_partkey, case when p_size % 11 = 0 then '' else upper(replace(p_name, ' ', case when p_size % 7 = 0 then '*' else '' end)) end as absq, upper(substr(p_name, 1, 3)) as cdr, p_type, p_size from part),
m as (select p_partkey, case when absq = '' then 'missing_seq' when contains(absq, '*') then 'has_stop_codons' when regexp_matches(absq, '[^ACDEFGHIKLMNPQRSTVWY]') then 'unk_chars'
 when p_size % 5 = 0 then 'missing_cdr' when not contains(absq, cdr) then 'cdr_not_in_frame' when p_size % 3 = 0 then 'unk_recomb' else 'passed' end as reason from r)
"""


def _reference(spark, sf) -> DataFrame:
    p = table(spark, sf, "part")
    size = F.col("p_size")
    seq = F.when(size % 11 == 0, "").when(size % 7 == 0, F.upper(F.translate("p_name", " ", "*"))).otherwise(F.upper(F.replace("p_name", F.lit(" "), F.lit(""))))
    return p.select("p_partkey", seq.alias("ABSEQ"), F.when(size % 5 == 0, "").otherwise(F.upper(F.substring("p_name", 1, 3))).alias("CDR3"), F.when(size % 3 == 0, "X").otherwise("IGHV1").alias("VGENES"), F.lit("").alias("JGENES"))


@query(_REF_SQL + "select reason, count(*) as counts from m group by all")
def reference_funnel(spark, sf):
    return annotate.filter_reference_rows(_reference(spark, sf), ["CDR3"])[1]


@query(_REF_SQL + "select p_partkey, 'VDJ' as RECOMBINATIONTYPE from m where reason = 'passed'")
def reference_rows(spark, sf):
    return annotate.filter_reference_rows(_reference(spark, sf), ["CDR3"])[0].select("p_partkey", "RECOMBINATIONTYPE")


@query("""select why, count(*) as n from (select case when l_linenumber = 3 then 'illegal characters' when l_discount < 0.02 then 'low identity' when l_quantity < 10 then 'short alignment' end as why from lineitem) group by why""")
def alignment_errors(spark, sf):
    seq = F.when(F.col("l_linenumber") == 3, "ACGE").otherwise("ACGTN")
    why = annotate.alignment_error("l_discount", "l_quantity", seq, least_identity=0.02, least_length=10)
    return table(spark, sf, "lineitem").select(why.alias("why")).groupBy("why").agg(F.count("*").alias("n"))


_TRIM_SQL = """with q as (select p_partkey, p_name, [ascii(x) - 33 for x in string_split(p_name, '')] as q from part),
c as (select p_partkey, p_name, [i for i in range(greatest(length(p_name) - 4, 0) + 1) if list_sum(q[i + 1:i + 4]) < 4 * 66] as low from q)
select p_partkey, case when len(low) > 0 then substr(p_name, 1, low[1]) else p_name end as kept from c where length(case when len(low) > 0 then substr(p_name, 1, low[1]) else p_name end) >= 3"""


@query(_TRIM_SQL)
def trimmed_reads(spark, sf):
    """A name as its own quality string: a window's mean below 66 cuts it."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("kept"), F.col("p_name").alias("q"))
    return annotate.trim_reads(p, "kept", "q", window=4, least=66, min_length=3).select("p_partkey", "kept")


@query(_TRIM_SQL.replace("ascii(x) - 33", "ascii(x) - 33").replace("4 * 66", "4 * 15").replace(">= 3", ">= 8").replace("select p_partkey, case", "select p_partkey as header, case", 1) + " and 2 * length(regexp_replace(p_name, '[^a-z]', '', 'g')) >= length(p_name)")
def prepared_reads(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("header"), F.col("p_name").alias("sequence"), F.col("p_name").alias("quality"))
    return prepare_single(p, least_quality=ord("a") - 33, percent=50, min_length=8).select("header", F.col("sequence").alias("kept"))


_MERGE_SQL = f"""with s as (select p_partkey, {_NT_SQL.format(c="p_name || p_type")} as a, substr({_NT_SQL.format(c="p_name || p_type")}, 5) || 'ACGTACCA' as b, p_size from part),
m as (select p_partkey, a, case when p_size % 4 = 0 then 'TTTTTTTTTTTTTTTTTT' else b end as b from s),
o as (select p_partkey, a, b, [k for k in range(least(length(a), length(b)), 5, -1) if len([i for i in range(1, k + 1) if substr(right(a, k), i, 1) <> substr(b, i, 1)]) <= floor(k * 0.1)] as fits from m)
"""


def _mates(spark, sf) -> DataFrame:
    a = nucleotides("x")
    rows = table(spark, sf, "part").select("p_partkey", "p_size", F.concat("p_name", "p_type").alias("x")).select("p_partkey", "p_size", a.alias("first"))
    b = F.when(F.col("p_size") % 4 == 0, F.lit("T" * 18)).otherwise(F.concat(F.substring("first", 5, 1000), F.lit("ACGTACCA")))
    return rows.withColumn("second", sequences.reverse_complement(b))


@query(_MERGE_SQL + "select p_partkey, fits[1]::int as overlap, a || substr(b, fits[1] + 1) as merged from o")
def merged_pairs(spark, sf):
    return annotate.merge_pairs(_mates(spark, sf), "first", "second", least=6).select("p_partkey", "overlap", "merged")


@query(_MERGE_SQL + "select p_partkey || ' 1' as header, a || substr(b, fits[1] + 1) as sequence from o where len(fits) > 0")
def prepared_pairs(spark, sf):
    rows = _mates(spark, sf)
    mate = lambda nr, c: rows.select(F.concat_ws(" ", "p_partkey", F.lit(nr)).alias("header"), F.col(c).alias("sequence"), F.repeat(F.lit("I"), F.length(c)).alias("quality"))
    return prepare_paired(mate(1, "first"), mate(2, "second"), overlap=6).select("header", "sequence")


_ALIGNER_SQL = f"""with r as (select p_partkey, p_size, ['AAA', 'CTG', 'GAT', 'TTC', 'GCG'][p_size % 5 + 1] as codon, p_size % 4 = 0 as ins from part),
s as (select *, 'GGATTC' || codon as cdr1, case when p_size % 11 = 0 then 'Sequence contains unknown characters' when p_size % 7 = 0 then 'Sequence results did not pass alignment filter settings after parsing output;weak'
  when p_size % 13 = 0 then 'Chain type not recognized' end as failed from r),
t as (select *, case when ins then substr(cdr1, 1, 1) || substr(cdr1, 3) else cdr1 end as c1 from s),
u as (select *, 'GAGGTGCAG' || c1 || 'TGGGTCATTAGTAGATTCGCGAAATGGGGC' as nt from t),
v as (select *, array_to_string([map {{{_AA}}}[substr(nt, 3 * i + 1, 3)] for i in range(length(nt) // 3)], '') as aa from u),
w as (select *, contains(aa, '*') as stops, p_size % 5 <> 0 as found, contains(aa, 'AK') as framed from v)
select p_partkey::varchar as SEQ_ID, coalesce(failed, case when ins then 'Insertions have been removed from: CDR1;' else '' end ||
  case when not stops and not found then 'There are no stop codons in the sequence, but the CDR3 sequence could not be found;' when not stops and not framed then 'The CDR3 is out-of-frame with respect to the translated sequence;' else '' end || 'weak') as notes,
case when p_size % 7 = 0 then round(1 / 42, 6) else round((42 - p_size % 3) / 42, 6) end as identity,
case when failed is null then 'VDJ' end as recombination, case when failed is null then 'heavy' end as chain, case when failed is null then c1 end as cdr1, case when failed is null then case when ins then cdr1 else '' end end as gapped,
case when failed is null then aa end as aa, case when failed is null then p_size % 3 end as mutations, case when failed is null then round(100 * (p_size % 3) / 36, 2) end as percent,
case when failed is null then case when stops then 'NO' when not found then 'MAYBE' when framed then 'YES' else 'NO' end end as productive,
case when failed is null then case when ins then '1,1,3,3,3,' || case when found then '1' else '' end || ',' else 'a,b,c,d,e,' || case when found then '1' else '' end || ',' end end as frames from w"""


@query(_ALIGNER_SQL)
def aligner_rows(spark, sf):
    """The main aligner's table to annotated rows: filters, insertions removed, frames, mutations, productivity."""
    p = table(spark, sf, "part")
    size = F.col("p_size")
    ins = size % 4 == 0
    codon = F.element_at(F.array(*map(F.lit, ("AAA", "CTG", "GAT", "TTC", "GCG"))), size % 5 + 1)
    cdr1 = F.concat(F.lit("GGATTC"), codon)
    v = F.concat(F.lit("GAGGTGCAG"), cdr1, F.lit("TGGGTCATTAGTAGATTC"))
    read = F.concat(v, F.lit("GCGAAATGGGGC"))
    text = lambda x: F.lit(x)
    spans = {"FR1": "0::8", "CDR1": "9::17", "FR2": "18::23", "CDR2": "24::29", "FR3": "30::35"}
    fields = {
        "Header": F.concat(F.lit("r"), "p_partkey"),
        "SEQ_ID": F.col("p_partkey").cast("string"),
        "Sequence": F.when(size % 11 == 0, "ACZ").otherwise(read),
        "Strand_Corrected_Sequence": read,
        "Notes": text("weak"),
        "Query_Start": text("0"),
        "Query_End": text("47"),
        "Codon_Start": text("0"),
        "Top_V-Gene_Hits": F.when(size % 13 == 0, "XX1").otherwise("IGHV1-2*01,IGHV3"),
        "Top_J-Gene_Hits": text(""),
        "5_Prime_Annotation": text("FR1"),
        "3_Prime_Annotation": text("FR4"),
        "VGENE: Query_Start": text("0"),
        "VGENE: Query_End": text("35"),
        "JGENE: Query_Start": text("42"),
        "JGENE: Query_End": text("47"),
        "VGENE: Total_Matches": F.when(size % 7 == 0, "1").otherwise((36 - size % 3).cast("string")),
        "JGENE: Total_Matches": F.when(size % 7 == 0, "0").otherwise("6"),
        "VGENE: Total_Mismatches": (size % 3).cast("string"),
        "JGENE: Total_Mismatches": text("0"),
        "VGENE: Total_Indel": F.when(ins, "1").otherwise("0"),
        "VGENE_Indels: FR1,CDR1,FR2,CDR2,FR3,CDR3": F.when(ins, "0,1,0,0,0,0").otherwise("0,0,0,0,0,0"),
        "VGENE_Reading_Frames: FR1,CDR1,FR2,CDR2,FR3,CDR3": F.when(size % 5 != 0, "a,b,c,d,e,1").otherwise("a,b,c,d,e,"),
        "VGENE: Alignment_Sequence_Query": v,
        "VGENE: Alignment_Sequence_Germline": F.when(ins, F.concat(F.substring(v, 1, 10), F.lit("-"), F.substring(v, 12, 40))).otherwise(v),
        "Full_Length_Sequence.NT": read,
        "CDR3_Sequence.NT": F.when(size % 5 != 0, "GCGAAA").otherwise(""),
        "CDR3_Sequence.AA": F.when(size % 5 != 0, "AK").otherwise(""),
        **{f"VGENE: Query_{r}_Start::End": text(x) for r, x in spans.items()},
        **{f"VGENE: Alignment_{r}_Start::End": text(x) for r, x in spans.items()},
        **{f"{r}_Sequence.NT": F.substring(read, int(x.split("::")[0]) + 1, int(x.split("::")[1]) - int(x.split("::")[0]) + 1) for r, x in spans.items()},
    }
    out = alignments.parse_alignments(p.select(*[c.alias(k) for k, c in fields.items()]), least_length=40, insertions="remove")
    shown = {
        "SEQ_ID": "SEQ_ID",
        "Notes": "notes",
        "Recombination_Type": "recombination",
        "Chain": "chain",
        "CDR1_Sequence.NT": "cdr1",
        "CDR1_Sequence.NT.Gapped": "gapped",
        "Full_Length_Sequence.AA": "aa",
        "VRegion.SHM.NT": "mutations",
        "VRegion.SHM.Per_nt": "percent",
        "Productive": "productive",
        "Reading_Frames: FR1,CDR1,FR2,CDR2,FR3,CDR3,FR4": "frames",
    }
    return out.select(F.round("Percent_Identity", 6).alias("identity"), *[F.col(f"`{k}`").alias(v) for k, v in shown.items()])


# Keys, joins, stores


@query(f"""with s as (select p_brand, p_partkey, p_type, {_NT_SQL.format(c="p_name")} as s from part), k as (select p_brand || '.' || least(s, reverse(translate(s, 'ACGT', 'TGCA'))) as read_key, p_type || ':' || p_partkey as a from s)
select read_key, array_to_string(list_sort(list(a)), ',') as analyses from k group by all""")
def grouped_reads(spark, sf):
    """Half of the reads are given as their reverse complement, in lower case."""
    s = nucleotides("p_name")
    rows = table(spark, sf, "part").select("p_brand", "p_type", "p_partkey", F.when(F.col("p_partkey") % 2 == 0, s).otherwise(F.lower(sequences.reverse_complement(s))).alias("s"))
    out = store.group_reads(rows, "p_brand", "s", "p_type", ["p_partkey"])
    return out.select("read_key", F.array_join(F.array_sort(F.transform("analyses", lambda a: F.concat_ws(":", a["analysis"], a["p_partkey"]))), ",").alias("analyses"))


@query("select c_custkey, array_to_string(list_sort(case when c_custkey % 3 = 0 then list_distinct([c_mktsegment, 'new', 'n' || c_nationkey]) else [c_mktsegment, 'n' || c_nationkey] end), ',') as tags, case when c_custkey % 3 = 0 then null else c_name end as name from customer")
def upsert_sets(spark, sf):
    c = table(spark, sf, "customer")
    old = c.select("c_custkey", F.array("c_mktsegment", F.concat(F.lit("n"), "c_nationkey")).alias("tags"), F.col("c_name").alias("name"))
    new = c.filter("c_custkey % 3 = 0").select("c_custkey", F.array("c_mktsegment", F.lit("new")).alias("tags"), F.lit(None).cast("string").alias("name"))
    return store.upsert(old, new, ["c_custkey"], unset=["name"], add_to_set=["tags"]).select("c_custkey", F.array_join(F.array_sort("tags"), ",").alias("tags"), "name")


@query("select * from (values ('complete', true), ('missing', false), ('stranger', false), ('taken', false)) as t(kind, accepted)")
def experiment_checks(spark, sf):
    existing = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("PROJECT_NAME"), F.col("c_name").alias("EXPERIMENT_NAME"), F.array(F.concat(F.lit("user"), "c_nationkey")).alias("OWNERS_OF_EXPERIMENT"))
    first = existing.orderBy("EXPERIMENT_NAME").first()
    good = {"PROJECT_NAME": "P", "EXPERIMENT_NAME": "E", "OWNERS_OF_EXPERIMENT": ["user1"]}
    docs = {"complete": good, "missing": good | {"EXPERIMENT_NAME": ""}, "stranger": good | {"OWNERS_OF_EXPERIMENT": ["nobody"]}, "taken": first.asDict()}
    users = [f"user{i}" for i in range(25)]
    out = []
    for kind, doc in docs.items():
        try:
            store.validate_experiment(doc, ["PROJECT_NAME", "EXPERIMENT_NAME", "OWNERS_OF_EXPERIMENT"], users, existing)
            out.append((kind, True))
        except store.InvalidInsert:
            out.append((kind, False))
    return spark.createDataFrame(out, "kind string, accepted boolean")


def _chains(spark, sf) -> DataFrame:
    codons = F.array(*map(F.lit, ("GCG", "GAT", "CTG", "TTC", "AAA")))
    cdr3 = F.concat(F.lit("TGT"), F.element_at(codons, (F.col("l_partkey") % 5 + 1).cast("int")), F.lit("TGG"))
    return table(spark, sf, "lineitem").filter("l_linenumber in (1, 2)").select(
        F.concat(F.lit("M:1:F:"), "l_orderkey", F.lit(":1:2:3 1:N:0")).alias("header"),
        cdr3.alias("cdr3_nt"),
        sequences.translate(cdr3).alias("cdr3_aa"),
        F.when(F.col("l_linenumber") == 1, "IGHV1-2*01").otherwise("IGKV3-20*01").alias("vgene"),
        F.lit("").alias("jgene"),
        F.lit("1.5").alias("shm"),
    )


_CHAINS_SQL = """with r as (select l_orderkey, l_linenumber, 'TGT' || ['GCG', 'GAT', 'CTG', 'TTC', 'AAA'][l_partkey % 5 + 1] || 'TGG' as cdr3 from lineitem where l_linenumber in (1, 2)),
o as (select *, (row_number() over (partition by l_orderkey order by cdr3, l_linenumber) - 1) // 2 as pair from r),
p as (select l_orderkey, pair, min(cdr3) filter (l_linenumber = 1) as heavy, min(cdr3) filter (l_linenumber = 2) as light from o group by all having count(*) = 2 and count(distinct l_linenumber) = 2),
c as (select heavy, light, count(*) as n from p group by all)
"""


@query(_CHAINS_SQL + "select 'M:1:F:' || l_orderkey || ':1:2:3 1:N:0' as header, p.heavy || ':' || p.light as pair_key, p.heavy as cluster, 100 as dominance, 100 as confidence from p join c using (heavy, light), range(2) where c.n >= 0")
def pairing_to_reads(spark, sf):
    """The pairing analysis end to end; at identity 1 each heavy CDR3 is its own cluster."""
    out = pairing_pipeline(_chains(spark, sf), identity=1.0, at_least=1)
    return out["reads"]


@query(_CHAINS_SQL + "select heavy as centroid, count(*) as size, sum(n)::bigint as total_counts, 100 as dominance from (select heavy, sum(n) as n from c group by all) group by all")
def pairing_clusters(spark, sf):
    return pairing_pipeline(_chains(spark, sf), identity=1.0, at_least=1)["clusters"].select("centroid", "size", "total_counts", "dominance")


@query("select case when length(p_name) % 2 = 0 then 'passed' else 'unproductive' end as reason, count(*) as counts from part group by all")
def productive_rule(spark, sf):
    """A productivity rule given as the text of an expression."""
    rows = table(spark, sf, "part").select(F.concat(F.lit("M:1:F:"), "p_partkey", F.lit(":1:2:3 1:N:0")).alias("header"), F.col("p_name").alias("cdr3_nt"), F.lit("A").alias("cdr3_aa"), F.lit("IGHV1").alias("vgene"), F.lit("").alias("jgene"), F.lit("1").alias("shm"))
    ready = pairing.prepare_reads(rows, "length(cdr3_nt) % 2 = 0")
    return ready.groupBy(F.coalesce("reject", F.lit("passed")).alias("reason")).agg(F.count("*").alias("counts"))


# Barcodes and motifs


_ISO = [("IGHG", "ACGTTGCA"), ("IGK", "GATTACAG"), ("IGHM", "CCGGTTAA")]
_FFT_SQL = f"""with b(i, label, code) as (values (0, 'IGHG', 'ACGTTGCA'), (1, 'IGK', 'GATTACAG'), (2, 'IGHM', 'CCGGTTAA')),
r as (select item_id, {_NT_SQL.format(c='text')} as s from benchmark),
x as (select item_id, 0 as flip, '+' as strand, s from r union all select item_id, 1, '-', reverse(translate(s, 'ACGT', 'TGCA')) from r),
d as (select item_id, flip, strand, i, label, p, list_sum([case when substr(s, p + k, 1) = substr(code, k, 1) then 0 else 1 end for k in range(1, 9)])::int as d from x, b, unnest(range(length(s) - 7)) as t(p)),
best as (select item_id, arg_min(struct_pack(label := label, d := d, p := p, strand := strand), (d, flip, i, p)) as h from d group by item_id),
hits as (select r.item_id, case when h.d <= 2 then h.label end as barcode, case when h.d <= 2 then h.d end as mismatches, case when h.d <= 2 then h.p::int end as "offset", case when h.d <= 2 then h.strand end as strand from r left join best using (item_id))
"""


@query(_FFT_SQL + "select *, case barcode when 'IGK' then 'VJ' when 'IGHG' then 'VDJ' when 'IGHM' then 'VDJ' else 'UNK' end as recombination from hits")
def fft_barcode(spark, sf):
    reads = table(spark, sf, "benchmark").select("item_id", nucleotides("text").alias("seq"))
    return barcode.aligned(reads, "seq", _ISO).drop("seq")


@query(_FFT_SQL + "select barcode, count(*) as counts, round(avg(mismatches), 6) as mean_mismatches from hits where barcode is not null group by all")
def isotype_summary(spark, sf):
    reads = table(spark, sf, "benchmark").select("item_id", nucleotides("text").alias("seq"))
    return barcode.isotype_summary(barcode.aligned(reads, "seq", _ISO)).withColumn("mean_mismatches", F.round("mean_mismatches", 6))


_SIDES = {"IGH": ("YC", "WG"), "IGK": ("FC", "FG")}


@query("select * from (values ('IGH', 'YC', 1.0::double), ('IGK', 'FC', 1.0::double)) as t(locus, left_side, perplexity)")
def chosen_motifs(spark, sf):
    """Motifs by species and locus; a position with one certain amino acid has perplexity 1."""
    side = lambda aa: "{" + ", ".join(f'"{i + 1}": {{"{a}": 1.0}}' for i, a in enumerate(aa)) + "}"
    rows = [(species, locus, f'[["{locus}", {side(left)}, {side(right)}, 1, 0]]') for species in ("Homo sapiens", "Mus musculus") for locus, (left, right) in _SIDES.items()]
    found = motif.choose_motifs(spark.createDataFrame(rows, "species string, locus string, motifs string"), ["homo sapiens"], ["igh", "IGK"])
    return spark.createDataFrame([(m.locus, "".join(next(iter(w)) for _, w in sorted(m.left.items())), max(map(motif.perplexity, m.left.values()))) for m in found], "locus string, left_side string, perplexity double")


# Clusters


def _greedy_sql(counts: str, identity: float) -> str:
    return f"""with recursive c as ({counts}), o as (select s, n, row_number() over (order by n desc, s) as i from c),
g(i, s, n, centroid, seeds) as (
  select i, s, n, s, [s] from o where i = 1
  union all
  select o.i, o.s, o.n, coalesce(list_filter(g.seeds, lambda x: levenshtein(x, o.s) <= floor((1 - {identity}) * greatest(length(x), length(o.s)) + 1e-9))[1], o.s),
    case when len(list_filter(g.seeds, lambda x: levenshtein(x, o.s) <= floor((1 - {identity}) * greatest(length(x), length(o.s)) + 1e-9))) > 0 then g.seeds else list_append(g.seeds, o.s) end
  from g join o on o.i = g.i + 1)
"""


@query(_greedy_sql("select p_name as s, count(*) as n from part group by all", 0.75) + "select s as p_name, n, centroid, centroid = s as is_seed from g")
def greedy_cluster(spark, sf):
    counts = table(spark, sf, "part").groupBy("p_name").agg(F.count("*").alias("n"))
    return cluster.greedy_clusters(counts, "p_name", "n", 0.75)


@query(_greedy_sql("select p_name as s, sum(p_size) as n from part group by all having sum(p_size) >= 100", 0.8) + "select p_partkey, p_name, p_size::bigint as p_size, g.centroid as clonotype from part left join g on g.s = p_name")
def clonotype_join(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("long").alias("p_size"))
    return cluster.clonotypes(df, "p_name", "p_size", 0.8, at_least=100)


@query(_greedy_sql("select c_name as s, count(*) as n from customer where c_mktsegment = 'BUILDING' group by all", 0.95) + "select centroid, count(*) as size, sum(n)::bigint as total from g group by all")
def greedy_cluster_names(spark, sf):
    """Names with one common prefix, in a number that grows with the table: no gram of the prefix may pair them all."""
    counts = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'").groupBy("c_name").agg(F.count("*").alias("n"))
    return cluster.greedy_clusters(counts, "c_name", "n", 0.95).groupBy("centroid").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
