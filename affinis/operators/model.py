"""Scoring of pairs by gradient-boosted trees."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinis.operators.features import FEATURES


def train_model(pairs: DataFrame, features: Sequence[str] = FEATURES, rounds: int = 100, rate: float = 0.05, leaves: int = 63, min_rows: int = 20, seed: int = 42, positive_weight: float = 1.0) -> PipelineModel:
    """A model of pairs (features, label, validation); rounds stop once validation pairs no longer gain.

    The tolerance is 0: any other value measures a single round's gain and stops boosting far too early; Spark has no patience of
    several rounds. Trees grow level by level, to the least depth that has room for ``leaves``; pairs with label 1 weigh positive_weight.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep")
    boosting = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_prediction",
        maxIter=rounds, stepSize=rate, maxDepth=max(1, math.ceil(math.log2(leaves))), weightCol="_weight", minInstancesPerNode=min_rows, seed=seed, validationIndicatorCol="validation", validationTol=0.0,
    )
    rows = pairs.withColumn("label", F.col("label").cast("double")).withColumn("_weight", F.when(F.col("label") == 1, positive_weight).otherwise(1.0))
    return PipelineModel([assembler, boosting.fit(assembler.transform(rows))])


def score_pairs(pairs: DataFrame, model: PipelineModel) -> DataFrame:
    """pairs with proba, the probability of a match."""
    scored = model.transform(pairs).withColumn("proba", vector_to_array("probability")[1])
    return scored.drop("_features", "_prediction", "rawPrediction", "probability")


def feature_importance(model: PipelineModel, features: Sequence[str] = FEATURES) -> list[tuple[str, float]]:
    """Features by their gain, largest first."""
    gains = model.stages[-1].featureImportances.toArray()
    return sorted(zip(features, map(float, gains)), key=lambda x: (-x[1], x[0]))


def save_model(model: PipelineModel, path: str, tau: float, cap: int | None = None) -> None:
    """Writes the model, and its threshold beside it."""
    spark = SparkSession.active()
    model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(tau, cap)], "tau double, cap int").coalesce(1).write.mode("overwrite").json(f"{path}/meta")


def load_model(path: str) -> tuple[PipelineModel, float, int | None]:
    """(model, tau, cap) that save_model wrote."""
    meta = SparkSession.active().read.schema("tau double, cap int").json(f"{path}/meta").first()
    return PipelineModel.load(f"{path}/model"), meta.tau, meta.cap
