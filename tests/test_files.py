import pytest
from pyspark.sql import functions as F

from quillon.sources import readers, writers
from quillon.streaming import events


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("r1", "ACGT", 3), ("r2", "GG", 4), ("r3", None, 5)], "id string, seq string, n int")
    writers.save_fasta(df, f"{tmp_path}/a", "seq", ["id"], ["n"])
    assert readers.guess_format(spark, f"{tmp_path}/a") == ("fasta", None)
    got = sorted((r.header, r.sequence, r.info.n) for r in readers.read_any(spark, f"{tmp_path}/a", schema="n int").collect())
    assert got == [("r1", "ACGT", 3), ("r2", "GG", 4)]
    (tmp_path / "w.fasta").write_text(">one <not json\nAC\nGT\n>two\r\nTT\r\n")
    got = [(r.header, r.sequence, r.info) for r in readers.read_fasta(spark, f"{tmp_path}/w.fasta").collect()]
    assert got == [("one", "ACGT", None), ("two", "TT", None)]


def test_fastq(spark, tmp_path):
    (tmp_path / "a.fastq").write_text("@r1 x\nACGT\nAC\n+\n@III\nII\n@r2\nA\n+\n+\n@r3\n\n+\n\n@r4\nGG\n+\n@@\n")
    got = sorted((r.header, r.sequence, r.quality) for r in readers.read_fastq(spark, f"{tmp_path}/a.fastq").collect())
    assert ("r1 x", "ACGTAC", "@IIIII") in got and ("r2", "A", "+") in got and ("r4", "GG", "@@") in got
    (tmp_path / "bad.fastq").write_text("@r1\nACGT\n+\nIIIII\n")
    with pytest.raises(Exception, match="lengths differ"):
        readers.read_fastq(spark, f"{tmp_path}/bad.fastq").collect()
    (tmp_path / "cut.fastq").write_text("@r1\nACGT\n+\nII\n")
    with pytest.raises(Exception, match="ends in the record"):
        readers.read_fastq(spark, f"{tmp_path}/cut.fastq").collect()
    df = spark.createDataFrame([("r1", "ACGT", None), ("r2", "GG", "II")], "id string, seq string, q string")
    writers.save_fastq(df, f"{tmp_path}/out", "seq", ["id"], "q", null_quality=30)
    assert readers.guess_format(spark, f"{tmp_path}/out") == ("fastq", None)
    assert sorted((r.header, r.quality) for r in readers.read_any(spark, f"{tmp_path}/out").collect()) == [("r1", "????"), ("r2", "II")]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.tab").write_text(writers.decorator_line(["a", "b"]) + '\na\tb\n1\t"x\n2\n')
    assert readers.read_decorator(spark, f"{tmp_path}/a.tab")["DESCRIPTION"] == ["a", "b"]
    assert sorted((r.a, r.b) for r in readers.read_delimited(spark, f"{tmp_path}/a.tab").collect()) == [("1", '"x'), ("2", "")]
    (tmp_path / "n.csv").write_text("1,2\n3,4\n")
    assert readers.read_delimited(spark, f"{tmp_path}/n.csv", sep=",", header=False).columns == ["Column 1", "Column 2"]
    assert readers.guess_format(spark, f"{tmp_path}/n.csv") == ("delimited", ",")
    (tmp_path / "x.txt").write_text("plain\ntext here\n")
    assert readers.guess_format(spark, f"{tmp_path}/x.txt") == (None, None)
    with pytest.raises(readers.FormatError):
        readers.read_any(spark, f"{tmp_path}/x.txt")


def test_save_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, ("a b", ["x", "y"])), (2, ("c", []))], "id int, d struct<k:string,l:array<string>>")
    writers.save_delimited(df, f"{tmp_path}/t", columns={"d.k": "key", "id": "id"}, keep_rest=False)
    assert sorted((r.key, r.id) for r in readers.read_any(spark, f"{tmp_path}/t").collect()) == [("a b", "1"), ("c", "2")]
    writers.save_delimited(df, f"{tmp_path}/s", sep=",", split_by=["d.k"])
    got = readers.read_delimited(spark, f"{tmp_path}/s", sep=",")
    assert sorted(r.part for r in got.collect()) == ["a_b", "c"]
    assert {r.part: r.documents for r in writers.part_counts(df.select("id", F.col("d.k").alias("k")), ["k"]).collect()} == {"a_b": 1, "c": 1}


def test_json(spark, tmp_path):
    df = spark.createDataFrame([(1, ("a", [1, 2]))], "id int, d struct<k:string,l:array<int>>")
    writers.save_flat_json(df, f"{tmp_path}/f", as_text=True)
    assert readers.guess_format(spark, f"{tmp_path}/f") == ("json", None)
    row = readers.read_any(spark, f"{tmp_path}/f").first()
    assert (row["d.k"], row["d.l"], row["id"]) == ("a", "1,2", "1")
    writers.save_json(df, f"{tmp_path}/n")
    assert readers.read_json(spark, f"{tmp_path}/n").first().d.l == [1, 2]
    assert [r.documents for r in writers.written_counts(readers.read_json(spark, f"{tmp_path}/n")).collect()] == [1]


def test_parallel_tables_and_blocks(spark, tmp_path):
    (tmp_path / "1.txt").write_text("Sequence number\tV\n1\ta\n2\tb\n")
    (tmp_path / "2.txt").write_text("Sequence number\tJ\n2\tc\n1\td\n")
    got = readers.read_parallel_tables(spark, {1: f"{tmp_path}/1.txt", 2: f"{tmp_path}/2.txt"})
    assert sorted((r["Sequence number"], r.V_1, r.J_2) for r in got.collect()) == [("1", "a", "d"), ("2", "b", "c")]
    (tmp_path / "b.txt").write_text("# IGBLASTN\nq1\nx\n# IGBLASTN\nq2\n")
    assert sorted(r.lines for r in readers.read_blocks(spark, f"{tmp_path}/b.txt", "# IGBLASTN").collect()) == [["# IGBLASTN", "q1", "x"], ["# IGBLASTN", "q2"]]


def test_germline(spark, tmp_path):
    (tmp_path / "g.tab").write_text("GENE\tSEQUENCE\tLOCUS\tFUNCTIONALITY\tSPECIES\nV1\tAC\tIGH\tF\tMus musculus\nV2\tGG\tIGK\tP\tMus musculus\n")
    assert [r.GENE for r in readers.read_germline(spark, [f"{tmp_path}/g.tab"], "mus musculus", ["IGH"], ["F"]).collect()] == ["V1"]
    docs = spark.createDataFrame([("V", [("b", "CC", "F"), ("a", "AA", "F"), ("c", "GG", "P")])], "GENETYPE string, GERMLINE_GENES array<struct<ALLELE_NAME:string,SEQUENCE:string,FUNCTIONALITY:string>>")
    sets = readers.germline_sets(docs, ["F"])
    assert [g.ALLELE_NAME for g in sets.first().genes] == ["a", "b"]
    writers.save_germline(sets, f"{tmp_path}/out")
    assert sorted(r.header for r in readers.read_fasta(spark, f"{tmp_path}/out").collect()) == ["a", "b"]
    assert readers.read_for_reference(spark.createDataFrame([("x", None)], "a string, n string"), {"a": "b"}).first().asDict() == {"b": "x", "n": "", "READS": 1}


def test_streams(spark, tmp_path):
    source = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    source.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in")
    q = events.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("update").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination(120)
    assert spark.table("w").agg(F.sum("counts")).first()[0] == source.count()
    assert events.sessions(source).agg(F.sum("counts")).first()[0] == source.count()
    q = events.write_batches(stream, f"{tmp_path}/out", f"{tmp_path}/c2")
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(f"{tmp_path}/out").count() == source.count()


def test_archives(spark, tmp_path):
    import tarfile
    import zipfile

    (tmp_path / "a.txt").write_text("one\ntwo\n")
    with zipfile.ZipFile(tmp_path / "x.zip", "w") as z:
        z.write(tmp_path / "a.txt", "in/a.txt")
        z.writestr("b.csv", "no")
    with tarfile.open(tmp_path / "y.tar.gz", "w:gz") as t:
        t.add(tmp_path / "a.txt", "a.txt")
    for name, member in (("x.zip", "in/a.txt"), ("y.tar.gz", "a.txt")):
        got = [(r.member, r.line) for r in readers.read_archive(spark, f"{tmp_path}/{name}", "*.txt").collect()]
        assert got == [(member, "one"), (member, "two")]
