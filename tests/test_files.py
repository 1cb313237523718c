"""Files in order, lists restricted to ids, last records, models kept, runs taken up again, and profiles."""

import pytest
from pyspark.sql import functions as F

from kindred.operators import evaluate as E
from kindred.operators import features, matcher, profile
from kindred.operators.representation import represent
from kindred.sources import tsv
from kindred.streaming import incremental

ENTITY = "entity_id string, business_name string, business_address string, country string"


def test_file_order(spark, tmp_path):
    rows = [(f"S1-{i:03d}", f"name {i * 7 % 50}", "", " US ") for i in range(50)]
    tsv.write_in_order(spark.createDataFrame(rows, ENTITY).repartition(5), f"{tmp_path}/o", "business_name", {c: c for c in tsv.ENTITY.names})
    want = [r[0] for r in sorted(rows, key=lambda r: r[1])]
    got = tsv.in_file_order(spark, f"{tmp_path}/o").orderBy("place").collect()
    assert [r["entity_id"] for r in got] == want and [r["place"] for r in got] == list(range(1, 51))
    assert [r["entity_id"] for r in tsv.in_file_order(spark, f"{tmp_path}/o", 7).orderBy("place").collect()] == want[:7]
    named = tsv.records_of(spark, f"{tmp_path}/o", spark.createDataFrame([("S1-003",), ("S1-099",)], "eid string")).collect()
    assert [tuple(r) for r in named] == [rows[3]]
    assert tsv.entities(spark, f"{tmp_path}/o", multi_line=False).count() == 50


def test_lists_of_ids(spark, tmp_path):
    lists = spark.createDataFrame([("a", ["x", "y", "x"]), ("b", []), ("c", ["z", "x"])], "id string, members array<string>")
    tsv.write_id_lists(lists, f"{tmp_path}/l", "candidate_entity_ids")
    every, needed = tsv.candidates(spark, f"{tmp_path}/l")
    assert {r["id"]: r["members"] for r in every.collect()} == {"a": ["x", "y"], "b": [], "c": ["x", "z"]}
    assert sorted(r["eid"] for r in needed.collect()) == ["x", "y", "z"]
    tsv.write_id_lists(lists, f"{tmp_path}/m")
    wanted = spark.createDataFrame([("c",), ("d",)], "id string")
    assert [(r["id"], r["members"]) for r in tsv.id_sets_of(spark, f"{tmp_path}/m", wanted).collect()] == [("c", ["x", "z"])]
    tsv.write_split(lists, f"{tmp_path}/s", F.when(F.col("id") == "a", "one").otherwise("two"))
    assert sorted(r["id"] for r in tsv.id_sets(spark, f"{tmp_path}/s/split=two").collect()) == ["b", "c"]


def test_ids_summaries_and_torn_files(spark, tmp_path):
    tsv.write_ids(spark.createDataFrame([("b",), ("a",)], "id string"), f"{tmp_path}/i")
    (tmp_path / "j").write_text(" b \n\na\n")
    assert [r["id"] for r in tsv.ids(spark, f"{tmp_path}/j").collect()] == [r["id"] for r in tsv.ids(spark, f"{tmp_path}/i").collect()] == ["a", "b"]
    tsv.write_summary(spark.createDataFrame([(3,)], "n int"), f"{tmp_path}/k")
    assert spark.read.json(f"{tmp_path}/k").first()["n"] == 3
    (tmp_path / "t").write_text("a\tx,y\nb\t\nc\tto")
    assert [(r["id"], r["rest"]) for r in tsv.complete_lines(spark, f"{tmp_path}/t").orderBy("at").collect()] == [("a", "x,y"), ("b", "")]


def test_last_record_wins(spark):
    rows = spark.createDataFrame([("a", "one", "", "", 1), ("a", "two", "", "", 3), ("b", "x", "", "", 2), ("a", "three", "", "", 2)], f"{ENTITY}, at int")
    assert {r["entity_id"]: r["business_name"] for r in tsv.last_records(rows, "at").collect()} == {"a": "two", "b": "x"}


def test_missed_examples(spark):
    reps = represent(spark.createDataFrame([(f"S1-{i}", f"red steel {i}", "", "US") for i in range(9)], ENTITY))
    lost = spark.createDataFrame([(f"S1-{i}", f"S1-{j}") for i in range(9) for j in range(9)], "s1_id string, eid string")
    got = E.examples(lost, reps, reps, 3).orderBy("eid").collect()
    assert [(r["s1_id"], r["eid"], r["shared"]) for r in got] == [("S1-0", "S1-0", "red,steel"), ("S1-0", "S1-1", "red,steel"), ("S1-0", "S1-2", "red,steel")]


def test_model_is_kept(spark, tmp_path):
    rows = [tuple([f"q{i}", f"t{i}"] + [float((i * k) % 5 == 0) if k != 2 else float(i % 2) for k in range(15)] + [i % 2]) for i in range(60)]
    table = spark.createDataFrame(rows, ", ".join(["s1_id string", "eid string", *(f"{n} double" for n in features.NAMES), "label int"]))
    model = matcher.fit(table, rounds=3)
    matcher.save(model, f"{tmp_path}/m", spark, optimal_threshold=0.35, train_pairs_count=60)
    again, threshold = matcher.load(f"{tmp_path}/m", spark)
    scores = lambda m: sorted((r["s1_id"], r["p"]) for r in matcher.predict(m, table).collect())
    assert threshold == 0.35 and scores(model) == scores(again)
    top = matcher.importance(model, spark, top=2).collect()
    assert top[0]["feature"] == features.NAMES[2] and len(top) == 2


def test_a_run_takes_up_where_the_last_ended(spark, tmp_path):
    targets = represent(spark.createDataFrame([("S2-1", "red steel", "12 Road 560001", "US"), ("S2-2", "blue linen", "", "US")], ENTITY))
    run = lambda: incremental.run(spark, f"{tmp_path}/in", targets, f"{tmp_path}/out", f"{tmp_path}/check", threshold=0.5, exact_edits=False)
    done = lambda: {r["id"]: (r["members"], r["candidates"]) for r in incremental.done(spark, f"{tmp_path}/out").collect()}
    tsv.write_entities(spark.createDataFrame([("S1-1", "Red Steel", "12 Road 560001", "US")], ENTITY), f"{tmp_path}/in", mode="append")
    first = run()
    assert [b["rows"] for b in first] == [1] and first[0]["rate"] > 0 and done() == {"S1-1": (["S2-1"], ["S2-1"])}
    assert incremental.seconds_left(first, 0) == 0 and incremental.seconds_left([], 5) == float("inf")
    assert run() == [] and len(done()) == 1  # nothing new
    tsv.write_entities(spark.createDataFrame([("S1-2", "green", "", "US"), ("S1-3", "blue linen", "", "US")], ENTITY).coalesce(1), f"{tmp_path}/in", mode="append")
    assert [b["rows"] for b in run()] == [2]
    assert done() == {"S1-1": (["S2-1"], ["S2-1"]), "S1-2": ([], []), "S1-3": (["S2-2"], ["S2-2"])}


def test_profile(spark):
    steps = [("one", lambda t: spark.range(100)), ("two", lambda t: t["one"].where("id > 50"))]
    rows = {r["stage"]: r for r in profile.stages(spark, steps, 100, 1000).collect()}
    assert set(rows) == {"one", "two", "all"} and rows["all"]["share"] == 1.0
    assert rows["one"]["share"] + rows["two"]["share"] == pytest.approx(1.0) and rows["all"]["memory_mb"] > 0
    assert rows["all"]["projected_hours"] == pytest.approx(rows["all"]["seconds"] * 10 / 3600)


def test_folders_are_deleted(spark, tmp_path):
    from kindred import session

    path = session.folder(spark, "some")
    spark.range(3).write.parquet(path)
    assert session.clean(spark) >= 1 and session.clean(spark) == 0
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def test_missed_pairs_are_written_in_order(spark, tmp_path):
    lost = E.missed(spark.createDataFrame([("b", "y"), ("a", "x"), ("c", "z")], "s1_id string, eid string"), spark.createDataFrame([("c", "z")], "s1_id string, eid string"))
    tsv.write_in_order(lost, f"{tmp_path}/m", "s1_id", {"s1_id": "source1_entity_id", "eid": "missed_entity_id"})
    rows = spark.read.options(sep="\t", header=True).csv(f"{tmp_path}/m")
    assert rows.columns == ["source1_entity_id", "missed_entity_id"] and sorted(tuple(r) for r in rows.collect()) == [("a", "x"), ("b", "y")]
