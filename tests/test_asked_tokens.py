"""The token index holds whole lists of what is asked for, and no others."""

import collections

from kindred.operators import blocking as B


def rows(spark, *given):
    return spark.createDataFrame([(eid, country, toks, "".join(toks)) for eid, country, *toks in given], "eid string, country string, toks array<string>, squash string")


def test_only_asked_tokens_are_listed(spark):
    queries = rows(spark, ("q1", "x", "red", "steel"), ("q2", "x", "iron"), ("q3", "y", "a long name of", "many words"))
    targets = rows(spark, ("t1", "x", "redsteel", "iron"), ("t2", "y", "redsteel", "redsteel"), ("t3", "x", "redsteel", "red"), ("t4", "x", "steel"), ("t5", "x"))
    got = collections.Counter((r["key"][0], r["country"], r["eid"], r["n"]) for r in B.asked_tokens(queries, targets).collect())
    assert got == collections.Counter([("redsteel", "x", "t1", 2), ("redsteel", "x", "t3", 2), ("redsteel", "y", "t2", 1)])
    assert B.asked_tokens(queries, targets.limit(0)).count() == 0


def test_pairs_ask_for_few_tokens(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(B, "asked_tokens", lambda q, t, was=B.asked_tokens: asked.append(was(q, t)) or asked[-1])
    columns = ("norm_name", "norm_name_af", "core_name", "core_name_af")
    sides = [df.selectExpr("*", *[f"concat_ws(' ', toks) AS {c}" for c in columns], "array() AS addr_nums") for df in (rows(spark, ("q1", "x", "red", "steel")), rows(spark, ("t1", "x", "redsteel", "iron"), ("t2", "z", "iron")))]
    sides = [df.withColumn("addr_nums", df["addr_nums"].cast("array<string>")) for df in sides]
    assert [(r["s1_id"], r["eid"], r["mask"]) for r in B.pairs(*sides).collect()] == [("q1", "t1", B.BITS["S6"])]
    assert asked[0].count() == 1


def test_tokens_are_listed_once(spark):
    queries, targets = rows(spark, ("q1", "x", "red", "steel")), rows(spark, ("t1", "x", "redsteel", "iron"))
    found = B.asked_tokens(queries, targets)
    assert "Generate " not in found._jdf.queryExecution().optimizedPlan().toString()  # else each reader lists all tokens again
    assert found.count() == 1
