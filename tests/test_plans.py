import pytest

from quillon.plans.filters import FieldRules, FilterError, compile_filter, intersect_ids
from quillon.plans.pipeline import run_pipeline
from quillon.plans.session import EXPS_RULES, SEQS_RULES, Dispatcher, Query, Session, with_duplicated_fields

ROWS = [(1, "a", ["x", "y"], 5, (1, ["p"])), (2, "b", ["y"], None, (2, [])), (3, None, [], 7, (None, None)), (4, "A", None, 10, (4, ["p", "q"]))]


@pytest.fixture
def df(spark):
    return spark.createDataFrame(ROWS, "id int, s string, arr array<string>, n int, d struct<k:int,l:array<string>>")


@pytest.mark.parametrize(
    ("doc", "want"),
    [
        ({}, [1, 2, 3, 4]),
        ({"s": "a"}, [1]),
        ({"s": None}, [3]),
        ({"s": {"$ne": "a"}}, [2, 3, 4]),
        ({"s": {"$in": ["a", None]}}, [1, 3]),
        ({"s": {"$nin": ["a", "b"]}}, [3, 4]),
        ({"s": {"$regex": "^a", "$options": "i"}}, [1, 4]),
        ({"s": {"$exists": False}}, [3]),
        ({"none": {"$exists": False}}, [1, 2, 3, 4]),
        ({"arr": "y"}, [1, 2]),
        ({"arr": {"$ne": "y"}}, [3, 4]),
        ({"arr": {"$size": 2}}, [1]),
        ({"arr": {"$all": ["x", "y"]}}, [1]),
        ({"arr": ["y"]}, [2]),
        ({"arr.0": "y"}, [2]),
        ({"arr": {"$regex": "x"}}, [1]),
        ({"arr": {"$elemMatch": {"$gt": "x", "$lt": "z"}}}, [1, 2]),
        ({"n": {"$gte": 5, "$lt": 10}}, [1, 3]),
        ({"n": {"$not": {"$gt": 5}}}, [1, 2]),
        ({"n": {"$mod": [5, 0]}}, [1, 4]),
        ({"n": {"$type": "int"}}, [1, 3, 4]),
        ({"d.k": {"$lte": 2}}, [1, 2]),
        ({"d.l": "q"}, [4]),
        ({"$or": [{"id": 1}, {"n": 10}]}, [1, 4]),
        ({"$and": [{"id": {"$gt": 1}}, {"n": {"$exists": True}}]}, [3, 4]),
        ({"$nor": [{"id": 1}, {"s": "b"}]}, [3, 4]),
        ({"$comment": "x", "id": {"$eq": 2}}, [2]),
    ],
)
def test_filters(df, doc, want):
    assert sorted(r.id for r in df.filter(compile_filter(doc, df.schema)).collect()) == want


@pytest.mark.parametrize("doc", [{"$where": "x"}, {"s": {"$text": 1}}, {"none": 1}, {"$or": []}])
def test_unsupported_filters(df, doc):
    with pytest.raises(FilterError):
        compile_filter(doc, df.schema)


def test_rules(df):
    rules = FieldRules(redirect={"name": "s"}, convert={"name": str.lower, "n": int})
    keep = compile_filter({"name": "B", "n": None}, df.schema, rules)
    assert [r.id for r in df.filter(keep).collect()] == [2]
    assert [r.id for r in df.filter(compile_filter({"n": "7"}, df.schema, rules)).collect()] == [3]


def test_intersect_ids():
    assert intersect_ids([[1, 2, 3], [2, 3]], {"$in": [3, 9]}) == [3]
    assert intersect_ids([[1, 2, 3]], {"$ne": 2}) == [1, 3]
    assert intersect_ids([], None) == []
    with pytest.raises(FilterError):
        intersect_ids([[1]], {"$gt": 0})


def test_pipeline(df):
    out = run_pipeline(df, [{"$unwind": "$arr"}, {"$group": {"_id": "$arr", "n": {"$sum": 1}, "ids": {"$push": "$id"}, "set": {"$addToSet": "$s"}}}, {"$sort": {"_id": 1}}])
    assert [(r._id, r.n, sorted(r.ids), r.set) for r in out.collect()] == [("x", 1, [1], ["a"]), ("y", 2, [1, 2], ["a", "b"])]
    out = run_pipeline(df, [{"$sort": {"id": -1}}, {"$group": {"_id": None, "first": {"$first": "$id"}, "last": {"$last": "$id"}, "avg": {"$avg": "$n"}}}]).first()
    assert (out["first"], out["last"], out["avg"]) == (4, 1, pytest.approx(22 / 3))
    out = run_pipeline(df, [{"$match": {"id": {"$lt": 3}}}, {"$addFields": {"m": {"$add": ["$id", 1]}}}, {"$project": {"m": 1, "k": "$d.k", "c": {"$literal": "$x"}}}, {"$sort": {"m": 1}}])
    assert [tuple(r) for r in out.collect()] == [(2, 1, "$x"), (3, 2, "$x")]
    assert run_pipeline(df, [{"$unwind": "$d.l"}]).count() == 3
    assert run_pipeline(df, [{"$project": {"d": 0, "arr": 0}}]).columns == ["id", "s", "n"]
    assert run_pipeline(df, [{"$skip": 1}, {"$limit": 2}, {"$count": "c"}]).first().c == 2
    # Null group keys are kept.
    assert run_pipeline(df, [{"$group": {"_id": "$s", "n": {"$sum": "$n"}}}]).count() == 4
    with pytest.raises(FilterError):
        run_pipeline(df, [{"$lookup": {}}])


def test_query(df):
    q = Query(df).sort([("n", 1)])
    assert [r.id for r in q.rows()] == [2, 1, 3, 4]
    assert [r.id for r in Query(df).sort([("n", -1)]).rows()] == [4, 3, 1, 2]
    assert q.limit(2).count() == 4 and q.limit(2).count(with_limit_and_skip=True) == 2 and q.skip(3).df.count() == 1
    assert [len(x) for x in q.rows(chunk=3)] == [3, 1]
    assert sorted(r.value for r in q.distinct("arr").collect()) == ["x", "y"]
    assert "Scan" in q.explain()
    assert Query(df).project({"d.k": 0, "s": 0}).df.columns == ["id", "arr", "n", "d"]


@pytest.fixture
def session(spark):
    def make(**user):
        exps = spark.createDataFrame(
            [("e1", "Proj A", "Exp 1", "Homo sapiens", ["all"], ["ann"], 10, True), ("e2", "Proj B", "Exp 2", "Mus musculus", ["lab_x"], ["bob"], 0, True), ("e3", "Proj-A", "Exp 3", "Homo sapiens", ["ann"], ["ann", "bob"], 5, False)],
            "_id string, PROJECT_NAME string, EXPERIMENT_NAME string, SPECIES string, READ_ACCESS array<string>, OWNERS_OF_EXPERIMENT array<string>, SEQ_COUNT int, CURATED boolean",
        )
        kind = "_id string, SEQ_ID string, EXP_ID string, ANALYSIS_NAME string, RECOMBINATION_TYPE string, DATA struct<SEQUENCE:string,CDR3:struct<AA:string,AA_LENGTH:int>>"
        seqs = spark.createDataFrame(
            [("r1", "r1", "e1", "@SEQ", None, ("ACGT", None)), ("a1", "r1", "e1", "IMGT", "VDJ", (None, ("CAR", 3))), ("a2", "r1", "e1", "MIXCR", "VDJ", (None, ("CAK", 3))), ("r2", "r2", "e2", "@SEQ", None, ("GGGG", None)), ("a3", "r2", "e2", "IMGT", "VJ", (None, ("CQQ", 4)))],
            kind,
        )
        return Session(seqs, with_duplicated_fields(exps), user)

    return make


def test_access(session):
    ids = lambda df: sorted(r._id for r in df.collect())
    assert ids(session(user="ann").readable()) == ["e1", "e3"]
    assert ids(session(user="eve", lab=["x"]).readable()) == ["e1", "e2"]
    assert ids(session(user="root", administrator=True).readable()) == ["e1", "e2", "e3"]
    assert ids(session(user="bob").owned()) == ["e2", "e3"]
    assert ids(session(user="bob").writable()) == [] and ids(session(user="bob", write_access=True).writable()) == ["e2", "e3"]
    assert ids(session(user="ann").experiments({"PROJECT_NAME": "PROJ a"}).df) == ["e1", "e3"]
    assert ids(session(user="ann").with_sequences()) == ["e1", "e3"]


def test_sequences(session):
    s = session(user="ann")
    assert sorted(r._id for r in s.sequences().rows()) == ["a1", "a2"]
    assert [r._id for r in s.sequences({"DATA.CDR3.AA": "cak"}, fields=["DATA.CDR3.AA"]).rows()] == ["a2"]
    assert s.sequences({"DATA.CDR3.AA_LENGTH": "3.0"}, analysis="IMGT").count() == 1
    assert s.sequences({"ANALYSIS_NAME": "@SEQ"}).count() == 1
    row = next(s.sequences(analysis="IMGT", with_raw=True).rows())
    assert row.RAW_DATA.SEQUENCE == "ACGT"
    assert s.reads().count() == 2
    assert sorted(s.reads(same_document=True).first().ANALYSES) == ["IMGT.VDJ", "MIXCR.VDJ"]
    assert s.aggregate([{"$match": {"ANALYSIS_NAME": {"$ne": "@SEQ"}}}, {"$group": {"_id": "$RECOMBINATION_TYPE", "n": {"$sum": 1}}}]).first().n == 2
    assert s.distinct_metadata(["SPECIES"], open_fields=["SPECIES"]).first().SPECIES == ["Homo sapiens", "Mus musculus"]
    assert SEQS_RULES.path("DATA.VREGION.VGENES.1") == "QUERY_DATA.VREGION.VGENES.PARSED_ALLELES"
    assert EXPS_RULES.literal("SEQ_COUNT", "1,000") == 1000


def test_dispatcher(session):
    d = Dispatcher(session(user="ann"))
    assert d.run([{"command": "sequences"}, {"command": "where", "args": [{"ANALYSIS_NAME": "IMGT"}]}, {"command": "count"}]) == 1
    for chain in ([{"command": "__class__"}], [{"command": "sequences"}, {"command": "df"}]):
        with pytest.raises(FilterError):
            d.run(chain)


def test_filters_reach_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    q = Query(df).where({"l_quantity": {"$gt": 45}, "l_returnflag": "R"}).project(["l_orderkey"])
    plan = q.explain()
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan and "l_tax" not in plan.split("ReadSchema")[1].split("\n")[0]


