"""Saved models with a table of versions next to them."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "name string, version string, path string, metric string, value double, n_train long"


class ModelStore:
    """Models under ``folder/models`` and one metadata row per version under ``folder/index`` (Parquet, append only)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def register(self, model: PipelineModel, name: str, version: str, metric: str, value: float, n_train: int) -> str:
        path = f"{self.folder}/models/{name}/{version}"
        model.write().save(path)
        row = [(name, version, path, metric, float(value), n_train)]
        self.spark.createDataFrame(row, SCHEMA).write.mode("append").parquet(f"{self.folder}/index")
        return path

    def versions(self, name: str) -> DataFrame:
        """Versions with their order by number (1.10.0 after 1.9.0), latest last."""
        parts = F.transform(F.split("version", r"\."), lambda p: p.cast("int"))
        d = self.spark.read.schema(SCHEMA).parquet(f"{self.folder}/index").where(F.col("name") == name)
        return d.withColumn("number", parts).orderBy("number")

    def latest(self, name: str):
        return self.versions(name).orderBy(F.col("number").desc()).first()

    def load(self, name: str, version: str | None = None) -> PipelineModel:
        d = self.versions(name)
        row = self.latest(name) if version is None else d.where(F.col("version") == version).first()
        if row is None:
            raise KeyError(f"{name} {version or ''} is not registered")
        return PipelineModel.load(row["path"])
