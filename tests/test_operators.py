import random
import math

import pytest
from pyspark.sql import functions as F

from quillon.functions.sequences import reverse_complement
from quillon.operators import alignments, annotate, barcode, cluster, pairing, repertoire, stats, store


def test_pairing_classes(spark):
    """Every class of pair, with codes consumed two rows at a time."""
    rows = [
        ("c1", "VDJ", "IG", 1), ("c1", "VJ", "IG", 2),
        ("c2", "VDJ", "IG", 1), ("c2", "VDJ", "IG", 2),
        ("c3", "VJ", "IG", 1), ("c3", "VJ", "IG", 2),
        ("c4", "VDJ", "TR", 1), ("c4", "VJ", "IG", 2),
        ("c5", "VDJ", "IG", 1),
        ("c8", "VDJ", "IG", 1), ("c8", "VJ", "IG", 2), ("c8", "VDJ", "IG", 3),
        ("c9", "VDJ", "IG", 1), ("c9", "VDJ", "IG", 2), ("c9", "VJ", "IG", 3), ("c9", "VJ", "IG", 4),
        ("", "VDJ", "IG", 1), (None, "VJ", "IG", 2),
    ]
    df = spark.createDataFrame(rows, "code string, chain string, receptor string, nr int")
    got = {(r.code, r.pair): (r.note, r.heavy_nr, r.light_nr) for r in pairing.pair_rows(df, "code", "chain", ["nr"], ["nr"], receptor="receptor").collect()}
    assert got == {
        ("c1", 0): (pairing.PAIRED, 1, 2),
        ("c2", 0): (pairing.HEAVY, 1, None),
        ("c3", 0): (pairing.LIGHT, None, 1),
        ("c4", 0): (pairing.RECEPTOR, 1, 2),
        ("c5", 0): (pairing.LONE, 1, None),
        ("c8", 0): (pairing.PAIRED, 1, 2),
        ("c8", 1): (pairing.LONE, 3, None),
        ("c9", 0): (pairing.HEAVY, 1, None),
        ("c9", 1): (pairing.LIGHT, None, 3),
    }


def test_run_pairing(spark):
    head = lambda n, k: f"M:1:F:1:1101:{n}:20 {k}:N:0"
    heavy, light = "TGTGCGAGAGATTGG", "TGTCAACAGTTT"
    rows = [
        (head(1, 1), heavy, "CARDW", "IGHV1*01", "IGHJ1", "2"), (head(1, 2), light, "CQQF", "IGKV1*01", "IGKJ1", "1"),
        (head(2, 1), heavy, "CARDW", "IGHV1*02", "IGHJ1", "4"), (head(2, 2), light, "CQQF", "IGKV1", "IGKJ1", "1"),
        (head(3, 1), None, None, "IGHV1", "IGHJ1", "4"), (head(3, 2), light, "CQQF", "IGKV1", "IGKJ1", "1"),
        ("", heavy, "CARDW", "IGHV1", "IGHJ1", "1"), (head(4, 1), heavy, "CARDW", "XV", "XJ", "1"), (head(5, 1), "TGTTAG", "C*", "IGHV1", "IGHJ1", "1"),
    ]
    df = spark.createDataFrame(rows, "header string, cdr3_nt string, cdr3_aa string, vgene string, jgene string, shm string")
    out = pairing.run_pairing(df)
    assert {r.reason: r.counts for r in out["funnel"].collect()} == {"passed": 5, "no_cdr3": 1, "no_header": 1, "invalid_chain": 1, "unproductive": 1}
    assert {r.note: r.counts for r in out["statistics"].collect()} == {pairing.PAIRED: 2, pairing.LONE: 1}
    (row,) = out["collapsed"].collect()
    assert (row.counts, row.heavy_vgene_mode, row.mean, row.sd) == (2, "IGHV1", 3.0, 1.414)


def test_collapse(spark):
    df = spark.createDataFrame([("k", 3, "b", 1.0), ("k", 1, "a", 2.0), ("k", 2, "a", 3.0), ("k", 4, "b", None), ("m", 1, None, None)], "key string, nr int, gene string, x double")
    got = {r.key: r for r in pairing.collapse(df, ["key"], ["nr"], ["gene"], "x", ["nr"]).collect()}
    assert (got["k"].counts, got["k"].gene_mode, got["k"].mean, got["k"].sd, got["k"].nr) == (4, "a,b", 2.0, 1.0, 1)
    assert (got["m"].mean, got["m"].sd, got["m"].gene_mode) == (None, None, None)


def test_dominance(spark):
    df = spark.createDataFrame([("c", "a", 6), ("c", "b", 3), ("c", "d", 1), ("e", "x", 2)], "c string, m string, n int")
    got = {r.c: (r.size, r.seed, r.dominance, r.confidence) for r in pairing.dominance(df, "c", "m", "n").collect()}
    assert got == {"c": (3, "a", 60, 50), "e": (1, "x", 100, 100)}


def test_diversity(spark):
    df = spark.createDataFrame([("a", i) for i in range(4)] + [("b", 1)] * 3, "k string, item int")
    got = {r.k: r for r in stats.diversity(df, "item", ["k"]).collect()}
    assert got["a"].richness == 4 and got["a"].shannon_effective == pytest.approx(4) and got["a"].simpson_effective == pytest.approx(4)
    assert got["b"].richness == 1 and got["b"].shannon == pytest.approx(0) and got["b"].simpson_effective == pytest.approx(1) and got["b"].seen_twice == 1
    assert stats.diversity(df, "item").first().shannon == pytest.approx(-sum(p * math.log(p) for p in (4 / 7, 1 / 7, 1 / 7, 1 / 7)))


def test_rank_and_cdf(spark):
    df = spark.createDataFrame([("a", 6), ("b", 3), ("c", 1)], "i string, n int")
    assert [(r.i, r.rank, round(r.cumulative, 3)) for r in stats.rank_abundance(df, "i", "n").orderBy("rank").collect()] == [("a", 1, 0.6), ("b", 2, 0.9), ("c", 3, 1.0)]
    assert {r.threshold: r.share for r in stats.count_cdf(df, "n", thresholds=[1, 2, 8]).collect()} == {1: 1.0, 2: pytest.approx(2 / 3), 8: 0.0}


def test_usage(spark):
    df = spark.createDataFrame([(["a", "b"], ["j"]), (["a"], ["j", "k"]), ([], ["j"]), (None, None)], "v array<string>, j array<string>")
    assert {r.gene: r.counts for r in repertoire.usage(df, "v").collect()} == {"a": 2}
    assert {r.gene: r.counts for r in repertoire.usage(df, "v", first_only=False).collect()} == {"a": 2, "b": 1}
    assert {(r.vgene, r.jgene): r.counts for r in repertoire.pair_usage(df, "v", "j", first_only=False).collect()} == {("a", "j"): 2, ("b", "j"): 1, ("a", "k"): 1}
    assert {(r.vgene, r.jgene): r.counts for r in repertoire.pair_usage(df, "v", "j").collect()} == {("a", "j"): 2}


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def greedy(items, identity):
    seeds, out = [], {}
    for s, _ in sorted(items.items(), key=lambda x: (-x[1], x[0])):
        out[s] = next((c for c in seeds if levenshtein(s, c) <= math.floor((1 - identity) * max(len(s), len(c)) + 1e-9)), s)
        if out[s] == s:
            seeds.append(s)
    return out


@pytest.mark.parametrize("identity", [0.6, 0.8, 0.95, 1.0])
def test_greedy_clusters(spark, identity):
    import random

    r = random.Random(3)
    base = ["".join(r.choice("ACGT") for _ in range(n)) for n in (6, 10, 15, 20)]
    items = {}
    for _ in range(60):
        s = list(r.choice(base))
        for _ in range(r.randrange(4)):
            k = r.randrange(3)
            at = r.randrange(len(s))
            s[at : at + (k != 1)] = r.choice("ACGT") if k else ""
        items["".join(s)] = r.randrange(1, 9)
    df = spark.createDataFrame(list(items.items()), "s string, n int")
    got = {x.s: x.centroid for x in cluster.greedy_clusters(df, "s", "n", identity).collect()}
    assert got == greedy(items, identity)


def test_clonotypes_and_uc(spark):
    df = spark.createDataFrame([("AAAA", 5), ("AAAT", 1), ("CCCC", 1)], "c string, n int")
    got = {r.c: r.clonotype for r in cluster.clonotypes(df, "c", "n", 0.75).collect()}
    assert got == {"AAAA": "AAAA", "AAAT": "AAAA", "CCCC": "CCCC"}
    lines = spark.createDataFrame([("S\t0\t9\t*\t*\t*\t*\t*\t7:x\t*",), ("H\t0\t9\t98\t+\t*\t*\t*\t2:y\t7:x",), ("C\t0\t2\t*\t*\t*\t*\t*\t7:x\t*",)], "value string")
    assert sorted((r.cluster, r["count"], r.is_seed) for r in cluster.read_uc(lines).collect()) == [("0", 2, False), ("0", 7, True)]


def test_barcodes(spark):
    df = spark.createDataFrame([("ACGTAA",), ("ACGAAA",), ("TTTTTT",), ("AC",), (None,)], "s string")
    codes = [("one", "ACGT"), ("two", "ACGA")]
    assert [r.barcode for r in barcode.contained(df, "s", codes).collect()] == ["one", "two", "nomatch", "nomatch", "nomatch"]
    got = [(r.barcode, r.mismatches) for r in barcode.nearest(df, "s", [("one", "ACGT"), ("x", "ACTT")], most=2).collect()]
    assert got[:4] == [("one", 0), ("one", 1), ("x", 2), ("one", 2)]
    assert {r.barcode: r.counts for r in barcode.summary(barcode.contained(df, "s", codes)).collect()} == {"one": 1, "two": 1, "nomatch": 3}
    with pytest.raises(ValueError):
        barcode.contained(df, "s", [("x", "A")] * 3000)


def test_best_offset():
    assert barcode.best_offset("TTACGTTT", "ACGA") == (1, 2)
    assert barcode.best_offset("ACACAC", "AC") == (0, 0)
    assert barcode.best_offset("AC", "ACG") == (-1, -1)
    import random

    r = random.Random(1)
    for _ in range(200):
        s, c = ("".join(r.choice("ACGT") for _ in range(n)) for n in (r.randrange(8, 40), r.randrange(1, 8)))
        want = min((sum(x != y for x, y in zip(s[i:], c)), i) for i in range(len(s) - len(c) + 1))
        assert barcode.best_offset(s, c) == want


def test_aligned(spark):
    df = spark.createDataFrame([("TTACGTACGTTT",), ("AAACGTACGTAA",), ("TTACGTACCTTT",), ("GGGGGGGGGGGG",), (None,)], "s string").withColumn("s", F.col("s"))
    got = [(r.barcode, r.mismatches, r.offset, r.strand, r.recombination) for r in barcode.aligned(df, "s", [("IGHG", "TACGTACG"), ("IGK", "AACGTACG")], most=1).collect()]
    assert ("IGHG", 0, 1, "+", "VDJ") in got and ("IGK", 0, 1, "+", "VJ") in got and ("IGHG", 1, 1, "+", "VDJ") in got
    assert sum(x[0] is None for x in got) == 2


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", ["x"], 5), (2, "b", None, 6)], "id int, s string, tags array<string>, n int")
    new = spark.createDataFrame([(2, None, ["y"]), (3, "c", None)], "id int, s string, tags array<string>")
    got = {r.id: (r.s, r.tags, r.n) for r in store.upsert(old, new, ["id"], add_to_set=["tags"]).collect()}
    assert got == {1: ("a", ["x"], 5), 2: ("b", ["y"], 6), 3: ("c", [], None)}
    got = {r.id: r.s for r in store.upsert(old, new, ["id"], unset=["s"]).collect()}
    assert got == {1: "a", 2: None, 3: "c"}
    got = {r.id: (r.s, r.n) for r in store.upsert(old, new, ["id"], replace=True).collect()}
    assert got == {1: ("a", 5), 2: (None, None), 3: ("c", None)}


def test_insert_and_delete(spark):
    old = spark.createDataFrame([("e1", 1), ("e2", 2)], "exp string, id int")
    new = spark.createDataFrame([("e1", 9)], "exp string, id int")
    rows = lambda df: sorted((r.exp, r.id) for r in df.collect())
    assert rows(store.insert(old, new, "exp")) == [("e1", 9), ("e2", 2)]
    assert rows(store.insert(old, new, "exp", append=True)) == [("e1", 1), ("e1", 9), ("e2", 2)]
    exps = spark.createDataFrame([("e1", ["ann"]), ("e2", ["bob"])], "_id string, OWNERS_OF_EXPERIMENT array<string>")
    assert rows(store.delete_owned(old, old, "exp", exps, "ann")) == [("e2", 2)]


def test_validate_experiment(spark):
    have = spark.createDataFrame([("P", "E", ["ann"])], "PROJECT_NAME string, EXPERIMENT_NAME string, OWNERS_OF_EXPERIMENT array<string>")
    good = {"PROJECT_NAME": "P", "EXPERIMENT_NAME": "F", "OWNERS_OF_EXPERIMENT": ["ann"]}
    store.validate_experiment(good, ["PROJECT_NAME"], ["ann"], have)
    for bad in ({**good, "EXPERIMENT_NAME": "E"}, {**good, "OWNERS_OF_EXPERIMENT": ["eve"]}, {**good, "PROJECT_NAME": ""}):
        with pytest.raises(store.InvalidInsert):
            store.validate_experiment(bad, ["PROJECT_NAME"], ["ann"], have)


def test_group_reads(spark):
    df = spark.createDataFrame([("h", "AACC", "A"), ("h", "GGTT", "B"), ("i", "AACC", "A")], "h string, s string, a string")
    got = sorted((r.h, r.s, [x.analysis for x in r.analyses]) for r in store.group_reads(df, "h", "s", "a", ["s"]).collect())
    assert got == [("h", "AACC", ["A", "B"]), ("i", "AACC", ["A"])]


def test_regions_and_errors(spark):
    df = spark.createDataFrame([("A", "B", "C", "D", "E", "F", "G"), ("", "B", "", "D", None, None, None), (*[None] * 7,)], ", ".join(f"{r} string" for r in annotate.REGIONS))
    got = df.select(*[c.alias(n) for n, c in annotate.join_regions().items()]).collect()
    assert tuple(got[0]) == ("ABCDEFG", "FR1", "FR4", False, True)
    assert tuple(got[1]) == ("BD", "CDR1", "CDR2", True, False)
    assert tuple(got[2]) == ("", None, None, False, False)
    one = spark.range(1)
    error = lambda i, n, s: one.select(annotate.alignment_error(F.lit(i), F.lit(n), F.lit(s)).alias("x")).first().x
    assert (error(0.9, 100, "ACGT"), error(0.1, 100, "ACGT"), error(0.9, 10, "ACGT"), error(0.9, 100, "A!")) == (None, "low identity", "short alignment", "illegal characters")


def test_clone_table(spark):
    df = spark.createDataFrame([("r1", "IGHV1(100),IGHV2(90)", None, "IGHJ4(50)", "ACGT")], "`Read id` string, `All V hits` string, `All D hits` string, `All J hits` string, `Read sequence` string")
    reads = spark.createDataFrame([("r1", "h1", "TTACGTT"), ("r2", "h2", "CC")], "read_id string, header string, sequence string")
    got = {r.read_id: r for r in annotate.parse_clone_table(df, reads).collect()}
    assert (got["r1"].V_genes, got["r1"].recombination, got["r1"].strand, got["r1"].note) == (["IGHV1", "IGHV2"], "VDJ", "+", None)
    assert got["r2"].note == "no alignment"


def test_igblast_blocks(spark):
    text = ["# IGBLASTN", "# Query: read 1", "# V-(D)-J rearrangement summary for query", "IGHV1*01\tIGHD1*01\tIGHJ1*01\tVH\tNo\tIn-frame\tYes\t+", "V\tread\tIGHV1*01\t99.0\t200\t2\t0\t1"]
    df = spark.createDataFrame([(text,)], "lines array<string>")
    row = df.select(*[c.alias(n) for n, c in annotate.parse_igblast_block(F.col("lines")).items()]).first()
    assert (row.header, row.recombination, row.productive, row.strand) == ("read 1", "VDJ", "YES", "+")
    assert tuple(row.v_hits[0]) == ("IGHV1*01", 99.0, 200, 2, 1) and row.j_hits == []
    reads = spark.createDataFrame([("read1",), ("read2",)], "header string")
    got = {r.header: r.note for r in annotate.join_reports(reads, spark.createDataFrame([(row.header, 1)], "header string, n int")).collect()}
    assert got == {"read1": None, "read2": "no report"}


def test_read_processing(spark):
    df = spark.createDataFrame([("a", "ACGTACGT", "IIIIIIII"), ("b", "ACGTACGT", "IIII!!!!")], "id string, s string, q string")
    assert [r.id for r in annotate.quality_filter(df, "q", 20, 60).collect()] == ["a"]
    assert {r.id: r.s for r in annotate.trim_reads(df, "s", "q", window=4, least=15, min_length=1).collect()} == {"a": "ACGTACGT", "b": "ACG"}
    whole = "ACGTTGCAAGGCTTACGATTGCCA"
    pairs = spark.createDataFrame([(whole[:16], whole[6:]), ("AAAAAAAAAAAA", "AAAAAAAAAAAA")], "x string, y string").withColumn("y", reverse_complement("y"))
    got = [r.merged for r in annotate.merge_pairs(pairs, "x", "y", least=10).collect()]
    assert got == [whole, "AAAAAAAAAAAA"]


def test_reference_rows_and_imgt(spark):
    df = spark.createDataFrame([("CARDW", "AR", "IGHV1", "IGHJ1"), ("", "AR", "IGHV1", ""), ("C*R", "R", "IGHV1", ""), ("CXZ1", "C", "IGHV1", ""), ("CAR", None, "IGHV1", ""), ("CAR", "QQ", "IGHV1", ""), ("CAR", "A", "X", "Y")], "ABSEQ string, cdr string, VGENES string, JGENES string")
    good, counts = annotate.filter_reference_rows(df, ["cdr"])
    assert [r.RECOMBINATIONTYPE for r in good.collect()] == ["VDJ"]
    assert {r.reason: r.counts for r in counts.collect()} == dict.fromkeys(["passed", "missing_seq", "has_stop_codons", "unk_chars", "missing_cdr", "cdr_not_in_frame", "unk_recomb"], 1)
    imgt = spark.createDataFrame([("95.5", "190/200 nt", "100 (98)", "-", "7", "-")], "`V-REGION identity %_1` string, `V-REGION identity nt_1` string, `V-REGION Nb of AA_9` string, `CDR3-IMGT Nb of AA_9` string, `V-REGION Nb of AA changes_9` string, `CDR3-IMGT Nb of AA changes_9` string")
    row = annotate.imgt_mutations(imgt).first()
    assert (row.V_shm_percent, row.V_shm, row.J_shm, row.V_shm_aa, row.V_shm_aa_percent) == (4.5, 10, None, 7.0, 7.0)


def test_external_aligner(spark):
    df = spark.createDataFrame([("a", "ACGT"), ("b", "GG"), ("c", None)], "h string, s string")
    out = annotate.run_external(df, ["awk", '/^>/{h=substr($0,2)} !/^>/{print h"\\t"length($0)}'], "h", "s", ["id", "n", "none"])
    assert sorted((r.id, r.n, r.none) for r in out.collect()) == [("a", "4", ""), ("b", "2", "")]


def test_pipelines(spark):
    from quillon import pipelines

    heavy, light = "TGTGCGAGAGATTGG", "TGTCAACAGTTT"
    rows = [(f"M:1:F:1:1101:{i}:20 {k}:N:0", s, a, v, j, "1") for i in range(3) for k, s, a, v, j in ((1, heavy, "CARDW", "IGHV1", "IGHJ1"), (2, light, "CQQF", "IGKV1", "IGKJ1"))]
    out = pipelines.pairing_pipeline(spark.createDataFrame(rows, "header string, cdr3_nt string, cdr3_aa string, vgene string, jgene string, shm string"))
    assert out["reads"].count() == 6 and {r.dominance for r in out["reads"].collect()} == {100}
    whole = "ACGTTGCAAGGCTTACGATTGCCA"
    a = spark.createDataFrame([("r 1", whole[:16], "I" * 16)], "header string, sequence string, quality string")
    b = spark.createDataFrame([("r 2", whole[6:], "I" * 18)], "header string, sequence string, quality string").withColumn("sequence", reverse_complement("sequence"))
    assert pipelines.prepare_paired(a, b).first().sequence == whole
    assert pipelines.prepare_single(a, min_length=5).count() == 1


def test_cluster_summary_and_report(spark):
    members = spark.createDataFrame([("a", 6, "a"), ("b", 3, "a"), ("c", 1, "c")], "m string, counts long, centroid string")
    collapsed = spark.createDataFrame([("a", 2, 3.0, 5.0, "V1"), ("b", 1, 3.0, 9.0, "V2"), ("c", 0, 0.0, 0.0, "V3")], "m string, n long, s1 double, s2 double, v_mode string")
    got = {r.centroid: (r.size, r.dominance, r.confidence, r.v_mode, r["mean"], r.sd) for r in pairing.cluster_summary(members, collapsed, "m", ["v"]).collect()}
    assert got == {"a": (2, 66, 50, "V1", 2.0, 1.0), "c": (1, 100, 100, "V3", None, None)}
    rows = [("M:1:F:1:1101:1:20 1:N:0", "TGTGCGAGAGATTGG", "CARDW", "IGHV1", "IGHJ1", "1"), ("", "TGT", "C", "IGHV1", "IGHJ1", "1")]
    report = pairing.summary(pairing.run_pairing(spark.createDataFrame(rows, "header string, cdr3_nt string, cdr3_aa string, vgene string, jgene string, shm string"))).first()
    assert (report.reads, report.passed, report.paired, report.unpaired, report.unique_pairs) == (2, 1, 0, 1, 0)


def test_offsets_of_many_reads_at_once(monkeypatch):
    r = random.Random(3)
    reads = ["".join(r.choice("ACGTN") for _ in range(r.randrange(0, 60))) for _ in range(80)]
    codes = ["ACGTTGCA", "GATTACAG", "C", "AC" * 20]
    for cells in (1, 500, 1 << 20):
        monkeypatch.setattr(barcode, "_CELLS", cells)
        assert barcode.best_offsets(reads, codes) == [[barcode.best_offset(s, c) for c in codes] for s in reads]


def test_a_shared_start_does_not_pair_all(spark):
    r = random.Random(2)
    rows = [("TGTGCGAAAGAT" + "".join(r.choice("ACGT") for _ in range(36)), 1) for _ in range(300)]
    rows += [(s[:20] + "A" + s[21:], 1) for s, _ in rows[:40]]
    df = spark.createDataFrame(rows, "s string, n long").distinct()
    got = {(x.a, x.b) for x in cluster.neighbours(df, "s", 0.9).collect()}
    want = {tuple(sorted((rows[i][0], rows[300 + i][0]))) for i in range(40) if rows[i][0] != rows[300 + i][0]}
    assert want <= got and len(got) < 2 * len(want) + 5


def test_alignments_with_a_search_for_fr4(spark):
    read = "GAGGTGCAG" + "AGATTCTGT" + "GCGAAAGATTACTGGGGCCAAGGC" + "ACGTTGCATT"
    row = {"Header": 'r1 <{"a": 1}', "Sequence": read, "Strand_Corrected_Sequence": read, "Query_Start": "0", "Query_End": "41", "Codon_Start": "0", "Locus": "IGH"}
    row |= {"5_Prime_Annotation": "FR1", "3_Prime_Annotation": "FR4", "VGENE: Query_Start": "0", "VGENE: Query_End": "17", "VGENE: Total_Matches": "18", "JGENE: Query_Start": "30", "JGENE: Query_End": "41", "JGENE: Total_Matches": "12"}
    row |= {"JGENE: Alignment_Sequence_Query": "TGGGGCCAAGGC", "JGENE: Alignment_Sequence_Germline": "TGGGGCCAAGGC", "VGENE: Query_FR1_Start::End": "0::8", "VGENE: Query_FR3_Start::End": "9::17", "FR1_Sequence.NT": read[:9], "FR3_Sequence.NT": read[9:18], "Full_Length_Sequence.NT": read[:42]}
    rows = spark.createDataFrame([tuple(row.values()), tuple("" if k == "Sequence" else v for k, v in row.items())], ", ".join(f"`{k}` string" for k in row))
    out = alignments.parse_alignments(rows, least_length=20, fr4_pattern="TGGGGC[ACGT]{3}GGC", isotypes=[("IGHG", "ACGTTGCA")])
    assert out.columns == alignments.columns() and len(out.columns) == len(set(out.columns)) == 95
    good, empty = sorted(out.collect(), key=lambda r: r["Notes"] == "Sequence not found")
    assert (good["Header"], good["Document_Header"]) == ("r1", row["Header"])
    assert (good["CDR3_Sequence.NT"], good["CDR3_Sequence.AA"], good["FR4_Sequence.NT"]) == ("GCGAAAGATTAC", "AKDY", "TGGGGCCAAGGC")
    assert (good["Productive"], good["Stop_Codon"], good["Full_Length"], good["Recombination_Type"], good["Isotype"]) == ("YES", False, True, "VDJ", "IGHG")
    assert good["FR1_Sequence.AA"] == "EVQ" and good["JRegion.SHM.NT"] == 0
    assert empty["Errors"] == "Sequence not found" and empty["Productive"] is None


def test_pipelines_with_an_aligner(spark):
    from quillon import pipelines

    read = "GAGGTGCAGCTGGTGGAGTCTGGGGGAGGC" * 4
    reads = spark.createDataFrame([("r1", read, "I" * len(read)), ("r2", read[:20], "I" * 20)], "header string, sequence string, quality string")
    line = """/^>/{h=substr($0,2)} !/^>/{n=length($0); print h"\\t"$0"\\t"$0"\\t0\\t"n-1"\\t0\\tIGH\\t0\\t"n-1"\\t"n}"""
    fields = ["Header", "Sequence", "Strand_Corrected_Sequence", "Query_Start", "Query_End", "Codon_Start", "Locus", "VGENE: Query_Start", "VGENE: Query_End", "VGENE: Total_Matches"]
    out = pipelines.aligner_pipeline(reads, ["awk", line.replace("\\\\", "\\")], fields, min_length=30).collect()
    assert [(r["Header"], r["Alignment_Length"], r["Recombination_Type"], r["Percent_Identity"]) for r in out] == [("r1", 120, "VDJ", 1.0)]  # r2 is too short
    clone = """/^>/{h=substr($0,2)} !/^>/{if (h=="r1") print h"\\tIGHV1(90)\\t\\tIGHJ4(50)"}"""
    out = pipelines.clone_pipeline(reads, ["awk", clone.replace("\\\\", "\\")], ["Read id", "All V hits", "All D hits", "All J hits"], min_length=10).collect()
    assert sorted((r.header, r.note, r.recombination if r.note is None else None) for r in out) == [("r1", None, "VDJ"), ("r2", "no alignment", None)]
