"""Strategies under gates low enough to take effect, against the SQL under the same gates."""

import random

import duckdb
import pytest

from kindred.operators import blocking as B
from kindred.operators.representation import represent
from kindred.plans import entities as V
from kindred.plans import oracle


@pytest.fixture(scope="module")
def parts(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["red", "steel", "brass", "linen", "forest", "the", "peach"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))), f"Brand#{k % 2}", f"TIN{k % 2}", rng.randint(1, 3), 1.0) for k in range(1, 160)]
    folder = tmp_path_factory.mktemp("gates")
    spark.createDataFrame(rows, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").coalesce(1).write.parquet(f"{folder}/part.parquet")
    return str(folder)


@pytest.mark.parametrize("gates", [{}, {"most": 12}, {"most": 6, "most_tokens": 15}, {"most": 40, "most_tokens": 30, "most_address": 5}])
def test_hits_are_the_sqls(spark, parts, gates):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{parts}/part.parquet/*.parquet'")
    queries, targets = (represent(x) for x in V.sides(V.entities(spark, parts)))
    got = sorted(tuple(r) for r in B.ranked(B.hits(queries, targets, **gates)).collect())
    want = sorted(con.sql(f"WITH {oracle.hits(**gates)} SELECT * FROM pairs").fetchall())
    assert got == want and got
    if gates:
        assert got != sorted(con.sql(f"WITH {oracle.hits()} SELECT * FROM pairs").fetchall())
