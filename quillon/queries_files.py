"""Queries that write files and read them back, with the SQL that the round trip must equal."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import annotate, cluster, pairing, store
from .operators.checkpoints import shared_folder
from .plans.session import Query
from .queries import query, table
from .sources import readers, writers
from .streaming import events as streams


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place in the folder that driver and executors share; the frames that read it keep it."""
    return f"{shared_folder(spark)}/quillon-files-{uuid.uuid4().hex}/{name}"


_WORDS_SQL = "select p_partkey::varchar as id, p_name as name, replace(p_name, ' ', '{sep}') as words, p_type as kind from part"


def _words(spark, sf) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", F.struct(F.col("p_name").alias("name"), F.split("p_name", " ").alias("words")).alias("DATA"), F.col("p_type").alias("kind"))


@query(_WORDS_SQL.format(sep=","))
def file_tab(spark, sf):
    path = fresh_path(spark, "tab")
    writers.save_delimited(_words(spark, sf), path, columns={"p_partkey": "id", "DATA.name": "name", "DATA.words": "words"})
    return readers.read_any(spark, path).select("id", "name", "words", "kind")


@query(_WORDS_SQL.format(sep="|"))
def file_comma(spark, sf):
    path = fresh_path(spark, "csv")
    writers.save_delimited(_words(spark, sf), path, sep=",", columns={"p_partkey": "id", "DATA.name": "name", "DATA.words": "words"})
    return readers.read_any(spark, path, "csv").select("id", "name", "words", "kind")


@query("select p_partkey, p_name as name, replace(p_name, ' ', ',') as words, p_type as kind from part")
def file_flat_json(spark, sf):
    path = fresh_path(spark, "flat")
    writers.save_flat_json(_words(spark, sf), path)
    back = readers.read_any(spark, path)
    return back.select("p_partkey", F.col("`DATA.name`").alias("name"), F.array_join("`DATA.words`", ",").alias("words"), "kind")


@query("select p_partkey::varchar as p_partkey, replace(p_name, ' ', ',') as words from part where p_type = 'PROMO'")
def file_text_json_split(spark, sf):
    path = fresh_path(spark, "split")
    writers.save_flat_json(_words(spark, sf), path, split_by=["kind"], as_text=True)
    return readers.read_json(spark, f"{path}/part=PROMO").select("p_partkey", F.col("`DATA.words`").alias("words"))


@query("select p_partkey, p_name as name, len(string_split(p_name, ' '))::int as n from part")
def file_nested_json(spark, sf):
    path = fresh_path(spark, "json")
    writers.save_json(_words(spark, sf), path)
    return readers.read_json(spark, path, ["p_partkey", "DATA"]).select("p_partkey", "DATA.name", F.size("DATA.words").alias("n"))


_NT_SQL = "translate(regexp_replace(lower({c}), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC')"


def nucleotides(column: str):
    letters = F.regexp_replace(F.lower(column), "[^a-z]", "")
    return F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


@query(f"select c_name || '|' || c_nationkey as header, {_NT_SQL.format(c='c_mktsegment')} as sequence, c_custkey, c_mktsegment as segment from customer")
def file_fasta(spark, sf):
    path = fresh_path(spark, "fasta")
    rows = table(spark, sf, "customer").select("c_name", "c_nationkey", "c_custkey", F.col("c_mktsegment").alias("segment"), nucleotides("c_mktsegment").alias("s"))
    none = rows.limit(3).withColumn("s", F.lit(""))  # rows without a sequence are left out
    writers.save_fasta(rows.unionByName(none), path, "s", ["c_name", "c_nationkey"], extra=["c_custkey", "segment"])
    return readers.read_any(spark, path, "fasta", schema="c_custkey long, segment string").select("header", "sequence", "info.c_custkey", "info.segment")


@query(f"select c_name as header, {_NT_SQL.format(c='c_mktsegment')} as sequence, case when c_nationkey < 5 then repeat('I', length({_NT_SQL.format(c='c_mktsegment')})) else repeat('?', length({_NT_SQL.format(c='c_mktsegment')})) end as quality from customer")
def file_fastq(spark, sf):
    path = fresh_path(spark, "fastq")
    rows = table(spark, sf, "customer").select("c_name", "c_nationkey", nucleotides("c_mktsegment").alias("s"))
    rows = rows.withColumn("q", F.when(F.col("c_nationkey") < 5, F.repeat(F.lit("I"), F.length("s"))))
    writers.save_fastq(rows, path, "s", ["c_name"], quality="q")
    return readers.read_any(spark, path, "fastq").select("header", "sequence", "quality")


@query("select p_name || '_' || p_brand as header, p_type as sequence from part")
def fasta_records(spark, sf):
    path = fresh_path(spark, "records")
    writers.table_to_fasta(table(spark, sf, "part"), path, "p_type", ["p_name", "p_brand"])
    return readers.read_fasta(spark, path).select("header", "sequence")


@query("select replace(p_type, ' ', '_') as part, count(*) as documents from part group by all")
def created_files(spark, sf):
    path = fresh_path(spark, "parts")
    writers.save_delimited(table(spark, sf, "part").select("p_partkey", "p_name", "p_type"), path, split_by=["p_type"])
    return writers.created_files(spark, path).groupBy("part").agg(F.sum("documents").alias("documents"))


@query("select chunk, count(*)::int as n, min(n_name) as low from (select n_name, (row_number() over (order by n_name) - 1) // 7 as chunk from nation) group by all")
def chunked_rows(spark, sf):
    q = Query(table(spark, sf, "nation")).sort([("n_name", 1)])
    return spark.createDataFrame([(i, len(rows), min(r.n_name for r in rows)) for i, rows in enumerate(q.rows(chunk=7))], "chunk long, n int, low string")


@query("select o_orderkey::varchar as key, o_orderstatus as status, o_orderpriority as priority, o_custkey::varchar as cust from orders")
def parallel_tables(spark, sf):
    o = table(spark, sf, "orders")
    paths = {}
    for nr, c in ((1, "o_orderstatus"), (2, "o_orderpriority"), (9, "o_custkey")):
        paths[nr] = fresh_path(spark, f"table{nr}")
        writers.save_delimited(o.select(F.col("o_orderkey").alias("Sequence number"), c), paths[nr])
    out = readers.read_parallel_tables(spark, paths)
    return out.select(F.col("Sequence number").alias("key"), F.col("o_orderstatus_1").alias("status"), F.col("o_orderpriority_2").alias("priority"), F.col("o_custkey_9").alias("cust"))


@query("""select c_custkey::varchar as key, 100 - round(c_acctbal / 100, 2) as v_percent, c_nationkey as v_shm, (7 - c_custkey % 3)::double as aa,
round(100 * (7 - c_custkey % 3)::double / (90 - 10), 4) as aa_percent from customer where c_custkey % 4 <> 0""")
def imgt_row(spark, sf):
    c = table(spark, sf, "customer").filter("c_custkey % 4 <> 0")
    key = F.col("c_custkey").alias("Sequence number")
    paths = {1: fresh_path(spark, "summary"), 9: fresh_path(spark, "mutations")}
    writers.save_delimited(c.select(key, F.round(F.col("c_acctbal") / 100, 2).alias("V-REGION identity %"), F.concat(F.lit(200) - F.col("c_nationkey"), F.lit("/200 nt")).alias("V-REGION identity nt")), paths[1])
    writers.save_delimited(c.select(key, F.lit("90 (88)").alias("V-REGION Nb of AA"), F.lit("10").alias("CDR3-IMGT Nb of AA"), F.lit("9 (8)").alias("V-REGION Nb of AA changes"), F.concat(F.col("c_custkey") % 3 + 2, F.lit(" (1)")).alias("CDR3-IMGT Nb of AA changes")), paths[9])
    out = annotate.imgt_mutations(readers.read_parallel_tables(spark, paths))
    return out.select(F.col("Sequence number").alias("key"), F.col("V_shm_percent").alias("v_percent"), F.col("V_shm").alias("v_shm"), F.col("V_shm_aa").alias("aa"), F.col("V_shm_aa_percent").alias("aa_percent"))


@query("""select n_name as header, case when n_nationkey % 2 = 0 then 'VDJ' else 'VJ' end as recombination, case when n_nationkey % 3 = 0 then 'YES' else 'NO' end as productive, '+' as strand,
'IGHV' || n_nationkey as v, 90.5::double as identity, n_regionkey as mismatches, 'IGHJ' || n_regionkey as j,
['FR1', 'CDR1'] as regions, [1 + n_nationkey, 76 + n_nationkey] as starts, n_nationkey % 2 = 0 as has_d from nation""")
def igblast_blocks(spark, sf):
    """Report blocks written as the aligner prints them."""
    t = "\t"
    n = table(spark, sf, "nation")
    heavy = F.col("n_nationkey") % 2 == 0
    v, j = F.concat(F.lit("IGHV"), "n_nationkey"), F.concat(F.lit("IGHJ"), "n_regionkey")
    productive = F.when(F.col("n_nationkey") % 3 == 0, "Yes").otherwise("No")
    hit = lambda g, name, mis: F.concat_ws(t, F.lit(g), F.lit("q"), name, F.lit("90.5"), F.lit("200"), mis, F.lit("0"), F.lit("1"))
    region = lambda name, start, stop: F.concat_ws(t, F.lit(name), F.col("n_nationkey") + start, F.col("n_nationkey") + stop, F.lit(stop - start + 1), F.lit(stop - start), F.lit(1), F.lit(0), F.lit("98.7"))
    lines = F.concat_ws(
        "\n",
        F.lit("# IGBLASTN 2.2.29+"),
        F.concat(F.lit("# Query: "), "n_name"),
        F.lit("# Database: human"),
        F.lit("# V-(D)-J rearrangement summary for query sequence (multiple equivalent top matches are separated by a comma)"),
        F.when(heavy, F.concat_ws(t, v, F.lit("IGHD1"), j, F.lit("VH"), F.lit("No"), F.lit("In-frame"), productive, F.lit("+"))).otherwise(F.concat_ws(t, v, j, F.lit("VK"), F.lit("No"), F.lit("In-frame"), productive, F.lit("+"))),
        F.lit("# V-(D)-J junction details based on top germline gene matches"),
        F.when(heavy, F.concat_ws(t, F.lit("GAGA"), F.lit("(CA)"), F.lit("GGT"), F.lit("N/A"), F.lit("TACTG"))).otherwise(F.concat_ws(t, F.lit("GAGA"), F.lit("CC"), F.lit("TACTG"))),
        F.lit("# Alignment summary between query and top germline V gene hit (from, to, length, matches, mismatches, gaps, percent identity)"),
        region("FR1", 1, 75),
        region("CDR1", 76, 99),
        F.concat_ws(t, F.lit("Total"), F.lit("N/A"), F.lit("N/A"), F.lit("99"), F.lit("97"), F.lit("2"), F.lit("0"), F.lit("98")),
        F.lit("# Hit table (the first field indicates the chain type of the hit)"),
        hit("V", v, F.col("n_regionkey").cast("string")),
        hit("J", j, F.lit("0")),
    )
    path = fresh_path(spark, "report")
    n.select(lines.alias("value")).write.text(path)
    blocks = readers.read_blocks(spark, path, "# IGBLASTN")
    f = annotate.parse_igblast_block(F.col("lines"))
    out = blocks.select(*[c.alias(k) for k, c in f.items()])
    first = lambda c: F.get(c, F.lit(0))
    return out.select(
        "header",
        "recombination",
        "productive",
        "strand",
        first(F.col("v_hits"))["gene"].alias("v"),
        first(F.col("v_hits"))["identity"].alias("identity"),
        first(F.col("v_hits"))["mismatches"].alias("mismatches"),
        first(F.col("j_hits"))["gene"].alias("j"),
        F.transform("regions", lambda r: r["region"]).alias("regions"),
        F.transform("regions", lambda r: r["start"]).alias("starts"),
        F.col("junction.d").isNotNull().alias("has_d"),
    )


@query("""select c_custkey, case when c_custkey % 5 = 0 then 'no alignment' end as note, case when c_custkey % 5 <> 0 then 'IGHV' || c_nationkey end as v,
case when c_custkey % 5 <> 0 then 100.0::double end as score, case when c_custkey % 5 <> 0 then 2 end as n_v, case when c_custkey % 5 <> 0 then 'IGH' end as locus,
case when c_custkey % 5 <> 0 then 'VDJ' end as recombination, case when c_custkey % 5 <> 0 then 3 end as mismatches, case when c_custkey % 5 <> 0 then 1 end as insertions, case when c_custkey % 5 <> 0 then '+' else '' end as strand from customer""")
def clone_table(spark, sf):
    c = table(spark, sf, "customer").withColumn("s", nucleotides("c_mktsegment"))
    reads = c.select(F.col("c_custkey").cast("string").alias("read_id"), F.col("c_name").alias("header"), F.concat(F.lit("AC"), "s").alias("sequence"))
    path = fresh_path(spark, "clones")
    rows = c.filter("c_custkey % 5 <> 0").select(
        F.col("c_custkey").alias("Read id"),
        F.concat(F.lit("IGHV"), "c_nationkey", F.lit("(100),IGHVx(90.5)")).alias("All V hits"),
        F.lit("").alias("All D hits"),
        F.lit("IGHJ1(50)").alias("All J hits"),
        F.lit("3|203|200|10|210|SA5GSC9TSG20AI30C|90;").alias("All V alignments"),
        F.col("s").alias("Read sequence"),
    )
    writers.save_delimited(rows, path)
    out = annotate.parse_clone_table(readers.read_delimited(spark, path), reads)
    there = F.col("note").isNull()
    return out.select(
        F.col("read_id").cast("long").alias("c_custkey"),
        "note",
        F.get("V_genes", F.lit(0)).alias("v"),
        F.get("V_scores", F.lit(0)).alias("score"),
        F.when(there, F.size("V_genes")).alias("n_v"),
        F.when(there, F.col("locus")).alias("locus"),
        F.when(there, F.col("recombination")).alias("recombination"),
        "V_alignment.mismatches",
        "V_alignment.insertions",
        "strand",
    )


@query("select c_name as header, case when c_custkey % 3 = 0 then 'no report' end as note, case when c_custkey % 3 <> 0 then c_nationkey end as hit from customer")
def joined_reports(spark, sf):
    c = table(spark, sf, "customer")
    report = c.filter("c_custkey % 3 <> 0").select(F.replace("c_name", F.lit("#"), F.lit(" #")).alias("header"), F.col("c_nationkey").alias("hit"))
    return annotate.join_reports(c.select(F.col("c_name").alias("header")), report).select("header", "note", "hit")


@query("select 'c' || c_nationkey as cluster, case when c_custkey % 2 = 0 then c_custkey || ':' || c_name else c_name || ':x' end as label, c_custkey < 25 as is_seed, case when c_custkey % 2 = 0 then c_custkey else c_nationkey + 1 end as count from customer")
def cluster_table(spark, sf):
    """Labels with the count in front, or in the tenth column where the ninth has none."""
    c = table(spark, sf, "customer")
    head = F.concat_ws("\t", F.when(F.col("c_custkey") < 25, "S").otherwise("H"), F.concat(F.lit("c"), "c_nationkey"), *[F.lit("*")] * 6)
    line = F.when(F.col("c_custkey") % 2 == 0, F.concat_ws("\t", head, F.concat_ws(":", "c_custkey", "c_name"), F.lit("*"))).otherwise(F.concat_ws("\t", head, F.concat(F.col("c_name"), F.lit(":x")), F.concat_ws(":", F.col("c_nationkey") + 1, F.lit("t"))))
    path = fresh_path(spark, "uc")
    c.select(line.alias("value")).unionByName(c.limit(2).select(F.lit("C\tc1\t5").alias("value"))).write.text(path)
    return cluster.read_uc(spark.read.text(path))


_GERM_SQL = "select 'IG' || substr(p_type, 1, 1) || 'V' || p_partkey as GENE, {nt} as SEQUENCE, 'IG' || substr(p_type, 1, 1) as LOCUS, case when p_size % 3 = 0 then 'F' when p_size % 3 = 1 then 'P' else 'ORF' end as FUNCTIONALITY, case when p_size % 2 = 0 then 'Homo sapiens' else 'Mus musculus' end as SPECIES from part".format(nt=_NT_SQL.format(c="p_name"))


def _germline(spark, sf) -> DataFrame:
    locus = F.concat(F.lit("IG"), F.substring("p_type", 1, 1))
    return table(spark, sf, "part").select(
        F.concat(locus, F.lit("V"), "p_partkey").alias("GENE"),
        nucleotides("p_name").alias("SEQUENCE"),
        locus.alias("LOCUS"),
        F.when(F.col("p_size") % 3 == 0, "F").when(F.col("p_size") % 3 == 1, "P").otherwise("ORF").alias("FUNCTIONALITY"),
        F.when(F.col("p_size") % 2 == 0, "Homo sapiens").otherwise("Mus musculus").alias("SPECIES"),
    )


@query(f"select GENE, SEQUENCE from ({_GERM_SQL}) where SPECIES = 'Homo sapiens' and LOCUS in ('IGE', 'IGP') and FUNCTIONALITY in ('F', 'P')")
def germline_files(spark, sf):
    path = fresh_path(spark, "germline")
    writers.save_delimited(_germline(spark, sf), path)
    return readers.read_germline(spark, [path], species="homo sapiens", loci=["IGE", "IGP"], functional=["F", "P"]).select("GENE", "SEQUENCE")


@query(f"select GENE, SEQUENCE from ({_GERM_SQL}) where SPECIES = 'Mus musculus' and LOCUS = 'IGE'")
def germline_default_folder(spark, sf):
    """The files of a species and locus in a folder laid out by both."""
    path = fresh_path(spark, "default")
    writers.save_germline_tables(_germline(spark, sf).withColumn("GENETYPE", F.lit("V")), path)
    return readers.resolve_germline(spark, path, species="Mus musculus", loci=["IGE"], gene_types=["V"]).select("GENE", "SEQUENCE")


@query(f"select LOCUS as GENETYPE, count(*)::int as n, array_to_string(list(GENE order by GENE), ',') as genes from ({_GERM_SQL}) where FUNCTIONALITY = 'F' group by all")
def germline_documents(spark, sf):
    docs = _germline(spark, sf).groupBy(F.col("LOCUS").alias("GENETYPE")).agg(F.collect_list(F.struct(F.col("GENE").alias("ALLELE_NAME"), "SEQUENCE", "FUNCTIONALITY")).alias("GERMLINE_GENES"))
    out = readers.germline_sets(docs, functional=["F"])
    return out.select("GENETYPE", F.size("genes").alias("n"), F.array_join(F.transform("genes", lambda g: g["ALLELE_NAME"]), ",").alias("genes"))


@query(f"select LOCUS as GENETYPE, GENE as header, SEQUENCE as sequence from ({_GERM_SQL}) where FUNCTIONALITY = 'F' and LOCUS = 'IGP'")
def germline_fasta(spark, sf):
    docs = _germline(spark, sf).groupBy(F.col("LOCUS").alias("GENETYPE")).agg(F.collect_list(F.struct(F.col("GENE").alias("ALLELE_NAME"), "SEQUENCE", "FUNCTIONALITY")).alias("GERMLINE_GENES"))
    path = fresh_path(spark, "genes")
    writers.save_germline(readers.germline_sets(docs, functional=["F"]), path)
    return readers.read_fasta(spark, f"{path}/GENETYPE=IGP").select(F.lit("IGP").alias("GENETYPE"), "header", "sequence")


@query(f"select GENE, SEQUENCE, FUNCTIONALITY from ({_GERM_SQL}) where LOCUS = 'IGE'")
def germline_tab_export(spark, sf):
    docs = _germline(spark, sf).groupBy(F.col("LOCUS").alias("GENETYPE")).agg(F.collect_list(F.struct(F.col("GENE").alias("ALLELE_NAME"), "SEQUENCE", "FUNCTIONALITY")).alias("GERMLINE_GENES"))
    path = fresh_path(spark, "tabs")
    writers.save_germline(readers.germline_sets(docs), path, kind="tab")
    back = readers.read_delimited(spark, f"{path}/GENETYPE=IGE")
    return back.select(F.col("ALLELE_NAME").alias("GENE"), "SEQUENCE", "FUNCTIONALITY")


@query("select p_name as SEQUENCE, coalesce(p_size, 1)::bigint as READS, p_type as KIND from part")
def reference_input(spark, sf):
    path = fresh_path(spark, "reference")
    writers.save_delimited(table(spark, sf, "part").select("p_name", "p_size", "p_type"), path)
    return readers.read_for_reference(readers.read_any(spark, path), {"p_name": "SEQUENCE", "p_size": "READS", "p_type": "KIND"}).select("SEQUENCE", "READS", "KIND")


@query("select p_name || '|' || p_brand as header, p_type as sequence from part")
def convert_file(spark, sf):
    """A tab file to FASTA by the conversion entry point, and read back."""
    source, path = fresh_path(spark, "source"), fresh_path(spark, "converted")
    writers.save_delimited(table(spark, sf, "part").select("p_name", "p_brand", "p_type"), source)
    writers.convert(spark, source, path, "fasta", sequence="p_type", header=["p_name", "p_brand"])
    return readers.read_any(spark, path).select("header", "sequence")


@query("select p_partkey::varchar as p_partkey, p_name from part")
def split_and_merge(spark, sf):
    path = fresh_path(spark, "pieces")
    places = writers.split_file(table(spark, sf, "part").select("p_partkey", "p_name"), path, pieces=3)
    return readers.merge_files(spark, places)


@query("select event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def stream_batches(spark, sf):
    events = table(spark, sf, "events")
    source = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    path, state = fresh_path(spark, "batches"), fresh_path(spark, "state")
    streams.write_batches(source, path, state, max_rows=5000, once=True).awaitTermination()
    return spark.read.schema(events.schema).parquet(path).groupBy("event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("""select o_custkey % 50 || '' as EXP_ID, count(*) as SEQ_COUNT, count(*) filter (o_orderstatus = 'F') as A_COUNT, count(*) filter (o_orderstatus = 'O') as O_COUNT from orders where o_custkey % 50 < 20 group by all""")
def load_from_file(spark, sf):
    """Annotated rows from a file under an experiment's id, and the counters that the load gives the metadata."""
    o = table(spark, sf, "orders").filter("o_custkey % 50 < 20")
    path = fresh_path(spark, "load")
    writers.save_delimited(o.select((F.col("o_custkey") % 50).alias("EXP_ID"), F.col("o_orderkey").alias("HEADER"), F.lit("ACGTAC").alias("SEQUENCE"), F.col("o_orderstatus").alias("ANALYSIS_NAME")), path)
    before = spark.createDataFrame([("3", "gone", "T", "F")], "EXP_ID string, HEADER string, SEQUENCE string, ANALYSIS_NAME string")
    rows, counters = store.load(before, readers.read_any(spark, path), "EXP_ID", "ANALYSIS_NAME")
    n = rows.groupBy("EXP_ID").agg(F.count("*").alias("SEQ_COUNT"))
    by = counters.groupBy("EXP_ID").pivot("ANALYSIS_NAME", ["F", "O"]).agg(F.sum("counts")).na.fill(0)
    return n.join(by, "EXP_ID").select("EXP_ID", "SEQ_COUNT", F.col("F").alias("A_COUNT"), F.col("O").alias("O_COUNT"))


@query("""select count(*) as reads, count(*) filter (l_quantity > 5) as passed, 
(select count(*) from (select l_orderkey, pair from (select l_orderkey, l_linenumber, (row_number() over (partition by l_orderkey order by l_linenumber) - 1) // 2 as pair from lineitem where l_quantity > 5 and l_linenumber in (1, 2)) group by all having count(distinct l_linenumber) = 2)) as paired from lineitem where l_linenumber in (1, 2)""")
def pairing_summary(spark, sf):
    rows = table(spark, sf, "lineitem").filter("l_linenumber in (1, 2)")
    ready = rows.select(
        F.concat(F.lit("M:1:F:"), "l_orderkey", F.lit(":1:2:3 1:N:0")).alias("header"),
        F.when(F.col("l_quantity") > 5, "TGTGCGAAATGG").otherwise("TGTGCGAAATG").alias("cdr3_nt"),
        F.lit("CAKW").alias("cdr3_aa"),
        F.when(F.col("l_linenumber") == 1, "IGHV1-2*01").otherwise("IGKV3-20*01").alias("vgene"),
        F.lit("").alias("jgene"),
        F.lit("1.5").alias("shm"),
    )
    return pairing.summary(pairing.run_pairing(ready)).select("reads", "passed", "paired")
