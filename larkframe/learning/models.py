"""Learners on DataFrames: MLlib where it has the learner, closed forms from aggregates elsewhere."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import regression as R
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 7


def assembled(xs: list[str], stage) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=xs, outputCol="features"), stage])


def linear(df: DataFrame, y: str, xs: list[str], penalty: float = 0.0, mixture: float = 0.0, **kw) -> PipelineModel:
    """Minimises 1/(2n) RSS + penalty * (mixture * L1 + (1 - mixture)/2 * L2); predictors are standardised inside."""
    return assembled(xs, R.LinearRegression(labelCol=y, regParam=penalty, elasticNetParam=mixture, **kw)).fit(df)


def logistic(df: DataFrame, y: str, xs: list[str], penalty: float = 0.0, mixture: float = 0.0, weight: str | None = None) -> PipelineModel:
    est = C.LogisticRegression(labelCol=y, regParam=penalty, elasticNetParam=mixture, maxIter=50)
    if weight:
        est = est.setWeightCol(weight)
    return assembled(xs, est).fit(df)


def multinom(df: DataFrame, y: str, xs: list[str], penalty: float = 0.0) -> PipelineModel:
    return assembled(xs, C.LogisticRegression(labelCol=y, family="multinomial", regParam=penalty, maxIter=50)).fit(df)


def tree_class(df: DataFrame, y: str, xs: list[str], depth: int = 5, min_n: int = 2) -> PipelineModel:
    return assembled(xs, C.DecisionTreeClassifier(labelCol=y, maxDepth=depth, minInstancesPerNode=min_n, seed=SEED)).fit(df)


def tree_reg(df: DataFrame, y: str, xs: list[str], depth: int = 5, min_n: int = 2) -> PipelineModel:
    return assembled(xs, R.DecisionTreeRegressor(labelCol=y, maxDepth=depth, minInstancesPerNode=min_n, seed=SEED)).fit(df)


def forest_class(df: DataFrame, y: str, xs: list[str], trees: int = 20, depth: int = 5, mtry: str = "auto", min_n: int = 1) -> PipelineModel:
    est = C.RandomForestClassifier(labelCol=y, numTrees=trees, maxDepth=depth, featureSubsetStrategy=mtry, minInstancesPerNode=min_n, seed=SEED)
    return assembled(xs, est).fit(df)


def forest_reg(
    df: DataFrame, y: str, xs: list[str], trees: int = 20, depth: int = 5, mtry: str = "auto", min_n: int = 1, share: float = 1.0
) -> PipelineModel:
    est = R.RandomForestRegressor(labelCol=y, numTrees=trees, maxDepth=depth, featureSubsetStrategy=mtry, minInstancesPerNode=min_n,
                                  subsamplingRate=share, seed=SEED)
    return assembled(xs, est).fit(df)


def boosted(df: DataFrame, y: str, xs: list[str], rounds: int = 10, depth: int = 3, rate: float = 0.1, min_n: int = 1, share: float = 1.0, gain: float = 0.0) -> PipelineModel:
    est = R.GBTRegressor(labelCol=y, maxIter=rounds, maxDepth=depth, stepSize=rate, minInstancesPerNode=min_n, subsamplingRate=share, minInfoGain=gain, seed=SEED)
    return assembled(xs, est).fit(df)


def predict(model: PipelineModel, df: DataFrame, name: str = "pred") -> DataFrame:
    """Predictions as a column under the given name, without the model's helper columns."""
    keep = df.columns
    return model.transform(df).select(*keep, F.col("prediction").alias(name))


def predict_prob(model: PipelineModel, df: DataFrame, name: str = "p_event") -> DataFrame:
    """Probability of label 1 (the event) as a column."""
    keep = df.columns
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(name), F.col("prediction").cast("int").alias("pred_class"))
