"""Literal cases of normalising, blocking, features and scoring."""

import hashlib

import pytest
from pyspark.sql import functions as F

from kindred.functions import similarity as S
from kindred.functions import text as X
from kindred.operators import blocking as B
from kindred.operators import evaluate as E
from kindred.operators import score
from kindred.operators.representation import represent
from kindred.sources import tsv

ENTITY = "entity_id string, business_name string, business_address string, country string"


def reps(spark, queries, targets):
    return represent(spark.createDataFrame(queries, ENTITY)), represent(spark.createDataFrame(targets, ENTITY))


def test_normalising(spark):
    rows = spark.createDataFrame([("हिंदी",), ("Société Marine",), ("  Acme-Corp.  (Pvt)  Ltd. ",), ("Société",), (None,)], "t string")
    from kindred.session import ship

    ship(spark)
    got = rows.select(X.normalized(F.col("t")).alias("n")).withColumn("f", X.without_latin_marks("n")).collect()
    assert [tuple(r) for r in got] == [("हिंदी", "हिंदी"), ("société marine", "societe marine"), ("acme corp pvt ltd", "acme corp pvt ltd"), ("société", "societe"), ("", "")]


def test_numbers_and_buckets(spark):
    row = represent(spark.createDataFrame([("S1-1", "x", "9 99 100 1000 20 300 560001", "US")], ENTITY)).first()
    assert row["addr_nums"] == ["100", "1000", "20", "300", "560001"] and row["pins"] == ["560001"]
    ids = [f"S1-{i:010d}" for i in range(50)]
    got = spark.createDataFrame([(i,) for i in ids], "i string").select("i", X.bucket(F.col("i")).alias("b")).collect()
    assert all(r["b"] == int(hashlib.sha256(r["i"].encode()).hexdigest(), 16) % 100 for r in got)


def found(spark, queries, targets, **gates):
    q, t = reps(spark, queries, targets)
    return {(r["s1_id"], r["eid"], r["strategy"]): r["s"] for r in B.hits(q, t, **gates).groupBy("s1_id", "eid", "strategy").agg(F.sum("score").alias("s")).collect()}


def test_strategies(spark):
    queries = [("S1-1", "Société Marine", "12 Road 560001", "US"), ("S1-2", "Dès", "", "FR"), ("S1-3", "Foo Foo", "", "DE"), ("S1-4", "Foo", "560001", "DE"), ("S1-5", "Sl Marine", "", "US")]
    targets = [("S2-1", "Société Marine", "12 Road 560001", "US"), ("S2-2", "Dès Ltd", "", "FR"), ("S3-2", "Aüx", "", "FR"), ("S2-3", "Foo Bar", "560001", "DE"), ("S3-5", "slmarine.com", "", "IN"), ("S3-6", "Société Marine", "", "IN")]
    got = found(spark, queries, targets)
    assert got["S1-1", "S2-1", "S1"] == 128 and got["S1-1", "S2-1", "S2"] == 64
    assert got["S1-1", "S2-1", "S4"] == 16 and got["S1-1", "S2-1", "S7"] == 12 and got["S1-1", "S3-6", "S5"] == 2
    assert got["S1-2", "S2-2", "S2"] == 64 and got["S1-2", "S3-2", "S2"] == 32
    assert ("S1-3", "S2-3", "S3") not in got and got["S1-4", "S2-3", "S3"] == 4
    assert got["S1-5", "S3-5", "S6"] == 8 and ("S1-4", "S2-3", "S7") not in got


def test_gates_and_cap(spark):
    queries = [("S1-1", "Foo Bar Baz", "12 Road 560001", "US")]
    targets = [(f"S2-{i:03d}", "Foo Bar" if i % 2 else "Foo Bar Baz", "12 Road 560001", "US") for i in range(8)]
    got = found(spark, queries, targets, most=4, most_address=7)
    assert {k[2] for k in got} == {"S1", "S2", "S3"}  # the address lists are too long, and so is the list of two shared tokens
    assert sum(k[2] == "S3" for k in got) == 4
    q, t = reps(spark, queries, targets)
    capped = B.capped(B.ranked(B.strategy("S4", q, t)), 3)
    assert sorted(r["eid"] for r in capped.collect()) == ["S2-000", "S2-001", "S2-002"]


def test_edit_ratio(spark):
    pairs = spark.createDataFrame([("abcde", "cdexy"), ("abcde", "vwxyz"), ("kitten", "sitting"), ("", "a"), ("a", "a")], "a string, b string")
    from kindred.session import ship

    ship(spark)
    got = {(r["a"], r["b"]): r["e"] for r in S.with_exact_edits(pairs, "a", "b", "e").collect()}
    assert got == pytest.approx({("abcde", "cdexy"): 0.2, ("abcde", "vwxyz"): 0.0, ("kitten", "sitting"): 1 - 3 / 7, ("", "a"): 0.0, ("a", "a"): 1.0})
    assert pairs.select(S.edit_ratio(F.col("a"), F.col("b"))).first()[0] == 0.0


@pytest.mark.parametrize(
    ("truth", "predicted", "f05"),
    [("", "", 1.0), ("", "a", 0.0), ("a", "", 0.0), ("a", "a", 1.0), ("a,b,c", "a,b,c", 1.0), ("a,b", "a,x,b", 5 / 7), ("a,b", "a", 5 / 6), ("a", "x", 0.0), ("a", "a,x,y", 5 / 13)],
)
def test_scores(spark, truth, predicted, f05):
    lists = lambda s: spark.createDataFrame([("i", [x for x in s.split(",") if x])], "id string, members array<string>")
    assert score.per_entity(lists(truth), lists(predicted)).first()["f05"] == pytest.approx(f05)


def test_macro(spark):
    lists = lambda d: spark.createDataFrame(list(d.items()), "id string, members array<string>")
    assert score.macro(score.per_entity(lists({"a": [], "b": [], "c": [], "d": ["x"]}), lists({"a": []}))).first()[0] == 0.75
    assert score.macro(score.per_entity(lists({}), lists({}))).first()[0] == 0.0


def test_tsv(spark, tmp_path):
    path = tmp_path / "e.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tAc"me\t"a\tb ""c"""\t US \nS2-2\tx\n\nS2-3\t"two\nlines"\ty\tIN\n', encoding="utf-8")
    got = sorted(tuple(r) for r in tsv.entities(spark, str(path)).collect())
    assert got == [("S2-1", 'Ac"me', 'a\tb "c"', "US"), ("S2-2", "x", "", ""), ("S2-3", "two\nlines", "y", "IN")]


def test_positional_sizes_and_fallback(spark):
    ids = spark.createDataFrame([(f"q{i:02d}", i) for i in range(1, 11)], "s1_id string, at long")
    pairs = spark.createDataFrame([(f"q{i:02d}", f"t{j}") for i in range(1, 11) for j in range(i)], "s1_id string, eid string")
    row = E.sizes(ids, pairs).first()
    assert (row["median"], row["p95"], row["max"], row["total"]) == (6, 10, 10, 55)
    lists = lambda n: spark.createDataFrame([(f"q{i:02d}", ["t"]) for i in n], "id string, members array<string>")
    got = {r["at"]: r["members"] for r in E.fallback(ids, lists([1, 2, 3, 5]), lists(range(1, 11))).collect()}
    assert [k for k, v in got.items() if v] == [1, 2, 3] and len(got) == 10
