"""What finished steps leave behind, and what is represented: alike entities once, of whole texts only what is read."""

import collections
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from kindred import session
from kindred.operators import representation
from kindred.plans import catalog, oracle
from kindred.sources.tsv import ENTITY
from kindred.streaming import incremental


def shuffles(spark):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    names = [blocks.apply(i).name() for i in range(blocks.size())]
    return {name.split("_")[1] for name in names if name.startswith("shuffle_")}


def test_shuffles_of_kept_tables_are_deleted(spark):
    before = shuffles(spark)
    for i in range(6):
        session.kept(spark.range(1000).groupBy((F.col("id") % 10 + i).alias("k")).count())
    ends = time.time() + 20
    while len(shuffles(spark) - before) > 1 and time.time() < ends:  # the last step's go with the next one
        time.sleep(0.2)
    assert len(shuffles(spark) - before) <= 1


def test_alike_entities_are_represented_once(spark):
    rows = [(f"S2-{i}", "Red Steel", "12 Road 560001", "US") for i in range(5)] + [("S3-7", "Blue", None, "US")]
    alike, members = representation.alike(spark.createDataFrame(rows, ENTITY))
    assert {(r["eid"], r["copies"], r["norm_name"]) for r in alike.collect()} == {("S2-0", 5, "red steel"), ("S3-7", 1, "blue")}
    assert {tuple(r) for r in members.collect()} == {("S2-0", f"S2-{i}") for i in range(5)} | {("S3-7", "S3-7")}


def test_targets_may_come_unrepresented(spark):
    targets = spark.createDataFrame([("S2-1", "red steel", "12 Road 560001", "US"), ("S2-2", "RED steel", "12 Road 560001", "US"), ("S3-1", "blue linen", "", " US")], ENTITY)
    asked = spark.createDataFrame([("S1-1", "Red Steel", "12 Road 560001", "US"), ("S1-2", "Red Steel", "12 Road 560001", "US"), ("S1-3", "blue linen", None, "US")], ENTITY)
    of = lambda t: sorted(tuple(r) for r in incremental.linked(asked, incremental.grouped(t), threshold=0.5, exact_edits=False).collect())
    assert of(targets) == of(representation.represent(targets)) == [("S1-1", ["S2-1", "S2-2"], ["S2-1", "S2-2"]), ("S1-2", ["S2-1", "S2-2"], ["S2-1", "S2-2"]), ("S1-3", ["S3-1"], ["S3-1"])]


@pytest.mark.parametrize("name", ["strategy_s3_documents", "candidates_ranked_documents"])
def test_whole_representations_of_texts_are_not_held(spark, tmp_path, monkeypatch, name):
    def refused(*_, **__):
        raise AssertionError("whole representations in memory")

    monkeypatch.setattr(catalog, "_reps", refused)
    texts = ["red steel of brass", "Red Stéel of brass", "linen", "", None, "brass red", "redsteel linen", "steel red"] * 6
    rows = [(i, t, "en" if i % 5 else "fr", "web", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = catalog.queries()[name](spark, str(tmp_path))
    want = con.sql(oracle.sql(200)[name])
    order = [want.columns.index(c) for c in got.columns]
    assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(tuple(r[i] for i in order) for r in want.fetchall()) and want.fetchall()
