"""Scores of predicted links: per entity, macro, breakdown, thresholds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.functions.similarity import f_beta

#: Thresholds that are tried, in twentieths.
GRID = [i / 20 for i in range(1, 20)]


def per_entity(truth: DataFrame, predicted: DataFrame) -> DataFrame:
    """(id, n_true, n_predicted, n_right, f05) of every id in truth; both sides are (id, members). An id without a prediction predicts nothing."""
    both = truth.select("id", F.array_distinct("members").alias("t")).join(predicted.select("id", F.array_distinct("members").alias("p")), "id", "left")
    both = both.withColumn("p", F.coalesce("p", F.array().cast("array<string>")))
    both = both.select("id", F.size("t").alias("n_true"), F.size("p").alias("n_predicted"), F.size(F.array_intersect("t", "p")).alias("n_right"))
    return both.withColumn("f05", graded())


def graded():
    """The F0.5 of an id by n_true, n_predicted and n_right."""
    shares = f_beta(F.col("n_right") / F.col("n_predicted"), F.col("n_right") / F.col("n_true"))
    return F.when(F.col("n_true") == 0, (F.col("n_predicted") == 0).cast("double")).when(F.col("n_predicted") == 0, 0.0).otherwise(shares)


def macro(scored: DataFrame) -> DataFrame:
    return scored.agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def breakdown(scored: DataFrame) -> DataFrame:
    single = F.col("n_true") == 0
    return scored.agg(
        F.count("*").alias("entities"), F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"),
        F.count_if(single & (F.col("f05") == 1)).alias("singletons_right"), F.count_if(single & (F.col("f05") == 0)).alias("singletons_wrong"),
        F.count_if(~single & (F.col("f05") == 1)).alias("perfect"), F.count_if(~single & (F.col("f05") == 0)).alias("missed"),
    )


def labelled(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairs with label 1 where truth (s1_id, eid) has them, else 0."""
    return pairs.join(truth.select("s1_id", "eid", F.lit(1).alias("label")).distinct(), ["s1_id", "eid"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def sweep(ids: DataFrame, scored: DataFrame, grid: list[float] = GRID) -> DataFrame:
    """(tau, macro_f05, singleton_f05): ids (s1_id, n_true, copies), and scored pairs (s1_id, p, label, n), of which a row stands for ``copies`` ids and ``n`` targets, in one pass over the pairs."""
    taus = F.explode(F.array(*[F.lit(t) for t in grid])).alias("tau")
    chosen = scored.select("s1_id", "label", "p", "n", taus).where("p >= tau").groupBy("s1_id", "tau").agg(F.sum("n").alias("n_predicted"), F.sum(F.col("label") * F.col("n")).alias("n_right"))
    every = ids.select("s1_id", "n_true", "copies", taus)
    every = every.join(chosen, ["s1_id", "tau"], "left").fillna(0, ["n_predicted", "n_right"]).withColumn("f05", graded())
    mean = lambda f05, of: F.sum(f05 * F.col("copies")) / F.sum(of)
    single = F.col("n_true") == 0
    singles = F.when(single, F.col("copies"))
    return every.groupBy("tau").agg(mean(F.col("f05"), F.col("copies")).alias("macro_f05"), F.coalesce(mean(F.when(single, F.col("f05")), singles), F.lit(0.0)).alias("singleton_f05"))


def best(swept: DataFrame) -> DataFrame:
    return swept.orderBy(F.desc("macro_f05"), "tau").limit(1)
