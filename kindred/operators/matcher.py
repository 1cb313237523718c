"""The pair classifier: gradient-boosted trees over the features, and what is kept of it."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .features import NAMES

#: Declared weights of a fixed linear score, for plans that should not depend on a fitted model.
LINEAR = {"exact_name_match": 0.25, "core_name_match": 0.2, "token_jaccard": 0.2, "char_trigram_jaccard": 0.15, "addr_digit_jaccard": 0.15, "same_country": 0.05}


def fit(labelled: DataFrame, rounds: int = 150) -> PipelineModel:
    """Trees of depth 5 (32 leaves), every split over four fifths of the features, all rows in every round."""
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, stepSize=0.08, maxDepth=5, subsamplingRate=1.0, featureSubsetStrategy="0.8", maxBins=255, seed=42)
    return Pipeline(stages=[VectorAssembler(inputCols=NAMES, outputCol="features"), trees]).fit(labelled.select(*NAMES, F.col("label").cast("double").alias("label")))


def predict(model: PipelineModel, featured: DataFrame) -> DataFrame:
    scored = model.transform(featured)
    return scored.select(*featured.columns, vector_to_array("probability")[1].alias("p"))


def linear(featured: DataFrame) -> DataFrame:
    """A score in [0, 1] by the declared weights."""
    return featured.withColumn("p", F.round(sum((F.col(c) * w for c, w in LINEAR.items()), F.lit(0.0)), 9))


def importance(model: PipelineModel, spark: SparkSession, top: int = 10) -> DataFrame:
    values = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(NAMES, values, strict=True)), "feature string, importance double").orderBy(F.desc("importance"), "feature").limit(top)


def save(model: PipelineModel, path: str, spark: SparkSession, **config) -> None:
    """The model, and its threshold and figures as JSON beside it."""
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([{"optimal_threshold": 0.5, "feature_names": NAMES} | config]).coalesce(1).write.mode("overwrite").json(f"{path}/config")


def load(path: str, spark: SparkSession) -> tuple[PipelineModel, float]:
    row = spark.read.json(f"{path}/config").first()
    return PipelineModel.load(f"{path}/model"), float(row["optimal_threshold"]) if row and "optimal_threshold" in row else 0.5
