import math
import random

import pytest
from pyspark.sql import functions as F

from quillon.functions import convert, genes, motif, sequences


@pytest.fixture
def value(spark):
    def run(column):
        return spark.range(1).select(column.alias("x")).first().x

    return run


L = F.lit


@pytest.mark.parametrize(("seq", "want"), [("ACGT", "ACGT"), ("AACG", "CGTT"), ("", ""), ("acgR", "Ycgt"), ("A!Cx~", "nnGNT")])
def test_reverse_complement(value, seq, want):
    assert value(sequences.reverse_complement(L(seq))) == want


def test_translate(value):
    assert value(sequences.translate(L("ATGGCCTAAG"))) == "MA*"
    assert value(sequences.translate(L("ATGGCCTAAG"), pad=True)) == "MA*X"
    assert value(sequences.translate(L("ATGGCCTAAG"), frame=1)) == "WPK"
    assert value(sequences.translate(L("AT"))) == ""
    assert value(sequences.translate(L(None).cast("string"))) is None
    assert value(sequences.translate(L("NNNAUG"))) == "XM"


def test_distance_and_strand(value):
    assert value(sequences.hamming(L("ACGT"), L("AGGA"))) == 2
    assert value(sequences.hamming(L("ACG"), L("ACGTT"))) == 2
    assert value(sequences.hamming(L(""), L("AC"))) == 2
    assert value(sequences.strand(L("ANG"), L("TTACGTT"))) == "+"
    assert value(sequences.strand(L("AACC"), L("GGTTAA"))) == "-"
    assert value(sequences.strand(L("CCCC"), L("AAAA"))) == ""
    assert value(sequences.valid_nucleotides(L("ACGTN"))) and not value(sequences.valid_nucleotides(L("ACGZ1")))


def test_genes(value):
    assert value(genes.gene_names(L("Homo sapiens IGHV1-3*01,IGHV1-8*02"))) == "IGHV1-3,IGHV1-8"
    assert value(genes.gene_names(L(None).cast("string"))) == ""
    assert value(genes.first_gene(L("Homo sapiens IGHV1-3*01,IGHV1-8*02"), allele=True)) == "IGHV1-3*01"
    assert value(genes.top_genes(L("A,B,C"), L("9,9,7"))) == ["A", "B"]
    assert value(genes.top_genes(L("A,B"), L("9"))) == ["A", "B"]
    assert value(genes.top_genes(L("B,A,B"), L(None).cast("string"))) == ["A", "B"]
    assert value(genes.top_genes(L("A,B,C"), L("9,x,7"))) == ["A", "B", "C"]
    assert value(genes.top_genes(L(""), L("9"))) == []
    assert value(genes.clean_gene_list(L("A, or B or C (see comment)"))) == "A, B,C"
    assert value(genes.allele_words(L("Homo IGHV1*01"))) == sorted(["HOMO IGHV1*01", "HOMO", "IGHV1*01", "IGHV1"])


@pytest.mark.parametrize(("v", "want"), [("IGHV1-3", "VDJ"), ("IGKV1", "VJ"), ("TRBV2", "VDJ"), ("TAV", "VJ"), ("XYZ", "N/A"), ("", "N/A")])
def test_recombination(value, v, want):
    assert value(genes.recombination_type(L(v))) == want


@pytest.mark.parametrize(("i", "want"), [("IGHG", "VDJ"), ("IGK", "VJ"), ("TRA", "VJ"), ("XX", "UNK")])
def test_recombination_of_isotype(value, i, want):
    assert value(genes.recombination_of_isotype(L(i))) == want


def test_split_by_top_score(spark):
    df = spark.createDataFrame([(["A*01", "B", "C"], [9.0, 9.0]), (["A"], None), ([], None)], "g array<string>, s array<double>")
    got = [r.x for r in df.select(genes.split_by_top_score("g", "s").alias("x")).collect()]
    assert [x.PARSED_ALLELES for x in got[0]] == [["A", "A*01", "B"], ["C"]]
    assert [x.PARSED_ALLELES for x in got[1]] == [["A"]]
    assert got[2] is None


def test_hits_and_alignments(value):
    assert [tuple(x) for x in value(genes.hit_list(L("IGHV1(100.5),IGHV2(90)")))] == [("IGHV1", 100.5), ("IGHV2", 90.0)]
    got = value(genes.alignment_stats(L("1|51|50|2|52|S1S2D3I4;x")))
    assert (got.germ_start, got.query_end, got.mismatches, got.deletions, got.insertions, got.shm) == (1, 52, 2, 1, 1, 0.08)


def test_headers(value):
    assert value(convert.cluster_code(L("M1:2:FC:1:1101:15:20 1:N:0"))) == "1:1101:15:20"
    assert value(convert.cluster_code(L("M1:2:FC:1:1101:15:20"))) == ""
    assert value(convert.cluster_code_single(L("abc_def"))) == "abc"


def test_numbers(value):
    assert value(convert.parse_shm(L("12.3456"))) == 12.346
    assert value(convert.parse_shm(L("7 (9)"))) == 7.0
    assert value(convert.parse_shm(L("x"))) is None
    assert value(convert.in_parentheses(L("12 (13)"))) == "13"
    assert value(convert.in_parentheses(L("12"))) == "12"
    assert value(convert.shm_from_matches(L("95/100 nt"))) == 5
    assert value(convert.to_int(L("3.9"))) == 3
    assert value(convert.percent_shm(L(3), L(9))) == 33.33
    assert value(convert.to_percent(L("0"))) == 0.0
    assert value(convert.length_or_null(L(""))) is None


def test_texts(value):
    assert value(convert.index_text(L("My first_Exp"))) == "myfirstexp"
    assert value(convert.to_list(L("1,2,x"), "int")) == [1, 2, None]
    assert value(convert.to_list(L("a|b"))) == ["a", "b"]
    assert value(convert.word_list(L(" smith lab, Jones Lab"), "title", ("lab",))) == ["Smith", "Jones"]
    assert [value(convert.to_bool(L(x))) for x in ("Yes", "false", "1", "what")] == [True, False, True, None]
    assert value(convert.default_quality(L("ACGT"))) == "????"
    assert value(convert.short_date(L("2024-03-09").cast("date"))) == "03/09/24"


@pytest.mark.parametrize(("stop", "cdr3", "frame", "fr1", "want"), [(True, True, True, True, "NO"), (False, False, True, True, "MAYBE"), (False, True, True, True, "YES"), (False, True, True, False, "MAYBE"), (False, True, False, True, "NO")])
def test_productivity(value, stop, cdr3, frame, fr1, want):
    assert value(convert.productivity(L(stop), L(cdr3), L(frame), L(fr1))) == want


def test_frame_range():
    assert list(convert.frame_range(0.8, 1.0, 0.1)) == [0.8, 0.9, 1.0]
    assert list(convert.frame_range(0.9, 0.9, 0.1)) == [0.9]


def test_flatten_and_nest(spark):
    df = spark.createDataFrame([((1, (2, [3, 4])),)], "DATA struct<a:int,b:struct<c:int,d:array<int>>>")
    flat = convert.flatten(df, lift="DATA", lists="|")
    assert flat.columns == ["a", "b.c", "b.d"] and flat.first()["b.d"] == "3|4"
    assert convert.nest(flat).first().b.c == 2


def side(aa):
    return {i + 1: {a: 0.9 if a == x else 0.1 / 19 for a in "ACDEFGHIKLMNPQRSTVWY"} for i, x in enumerate(aa)}


def test_motif():
    m = motif.Motif("IGH", side("YYC"), side("WGQ"), 2, 1)
    seq = "ATG" + "TATTACTGT" + "GCTAGAGAT" + "TGGGGTCAA" + "GGG"
    got = motif.find_cdr3(seq, [m])
    assert (got["strand"], got["nt"], got["aa"]) == ("+", "TGTGCTAGAGATTGG", "CARDW")
    flipped = seq[::-1].translate(str.maketrans("ACGT", "TGCA"))
    assert motif.find_cdr3(flipped, [m])["aa"] == "CARDW" and motif.find_cdr3(flipped, [m])["strand"] == "-"
    assert motif.find_cdr3("ACGT" * 10, [m]) is None and motif.find_cdr3(None, [m]) is None
    assert motif.perplexity({"A": 0.5, "C": 0.5}) == pytest.approx(2)
    assert motif.best_window("AYYCX", side("YYC")) == (pytest.approx(0.9**3), 1)
    assert motif.read_motifs('[["IGH", {"1": {"C": 1.0}}, {"1": {"W": 1.0}}, 0, 1]]')[0].left == {1: {"C": 1.0}}


def test_alignment_places():
    from quillon.functions import alignment as al

    assert al.in_frame("ACGT") == "NNACGT" and al.in_frame("ACG") == "ACG"
    assert al.end_in_read(12, 10) == 9 and al.end_in_read(10, 10) == 10 and al.end_in_read(8, 20, 5, 9, to_last=True) == 12
    assert al.start_in_frame(5, 1, "ACGACG", "ACGACG") == (5, 2)
    start, frame = al.start_in_frame(1, 4, "ACGAC", "ACGAC", to_first=True)
    assert start >= 1 and frame == (start - 1) % 3 + 1
    got = al.without_gaps("ACTGA-CC", "AC-GATCC")
    assert (got["nt"], got["nt_gapped"], got["adjusted"]) == ("ACTGACC", "ACTGAnCC", False)
    assert al.without_gaps("ACTGACC", "AC-GACC", "remove")["nt"] == "ACGACC"
    assert al.without_gaps("TAGACC", "TA-ACC", "on_stop") == {"nt": "TAACC", "nt_gapped": "TAACC", "aa": "*X", "aa_gapped": "*X", "adjusted": True}
    assert al.without_gaps("ACG", "ACG") == {"nt": "ACG", "nt_gapped": None, "aa": "T", "aa_gapped": None, "adjusted": False}
    hit = {"query": "AC-GTGGGGC", "germline": "ACTGTGGGGC", "start": 11}
    assert al.fr4_start("TGGGG", [hit], "", 1) == 14
    assert al.fr4_start("TGGGG", [], "AATGGGGTGGGG", 5) == 12
    assert al.fr4_start("TGGGG", [], "AA", 5) is None
    assert al.cdr3_and_fr4("TGTGCGTGGGGC", 1, 7, 12)["cdr3_aa"] == "CA"
    assert al.cdr3_and_fr4("TGTGCGTGGGGC", 1, None, 12, 3)["cdr3_nt"] == "TGT"


def test_with_fr4(spark):
    from quillon.functions import alignment as al

    df = spark.createDataFrame([("TGTGCGTGGGGC", 1, 12, []), (None, None, None, None)], "sequence string, cdr3_start int, end int, j_hits array<struct<query:string,germline:string,start:int>>")
    got = al.with_fr4(df, "TGGGG").collect()
    assert (got[0].cdr3_nt, got[0].fr4_frame) == ("TGTGCG", 1) and got[1].cdr3_nt is None


def test_best_window_against_a_plain_search():
    r = random.Random(6)
    letters = "ACDEFGHIKLMNPQRSTVWY"
    for _ in range(60):
        side = {p: {a: r.choice((0.0, 0.1, 0.5, 1.0)) for a in r.sample(letters, 6)} for p in r.sample(range(1, 5), r.randint(1, 3))}
        aa = "".join(r.choice(letters + "X*") for _ in range(r.randrange(0, 30)))
        n, best, at = max(side), 0.0, -1
        for i in range(len(aa) - n + 1):
            w = aa[i : i + n]
            p = 0.0 if set(w) & set("X*") else math.prod(side[k].get(w[k - 1], 0.0) for k in side)
            if p > best * (1 + 1e-12):
                best, at = p, i
        got = motif.best_window(aa, side)
        assert math.isclose(got[0], best, rel_tol=1e-9) and (got[1] == at or math.isclose(best, got[0]))


def test_next_folder():
    from quillon.functions.names import next_folder

    assert next_folder("run", ["other", "runs"]) == "run"
    assert next_folder("run", ["run"]) == "run_1"
    assert next_folder("run", ["run", "run_2", "run_x"]) == "run_3"
