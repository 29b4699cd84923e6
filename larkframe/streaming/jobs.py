"""Incremental jobs: file streams that run until the present files are read, with results in Parquet.

Every job writes each micro-batch to its own folder by batch number, so a batch that runs again after a failure
replaces its output. State lives in the checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkframe.session import new_folder


def landed(df: DataFrame, name: str, *partition: str) -> str:
    """Rows as files in a fresh folder, as if they had arrived."""
    path = new_folder(df.sparkSession, name)
    w = df.write
    (w.partitionBy(*partition) if partition else w).parquet(path)
    return path


def landed_in_order(df: DataFrame, time: str, unit: str, name: str) -> str:
    """Rows as files that arrive one ``unit`` of time (day, week, ...) after the other; inside a unit they are in any order.

    So no row is later than one unit, which is the bound a watermark needs. Rows without a time come first.
    """
    path = new_folder(df.sparkSession, name)
    slices = df.withColumn("_unit", F.date_trunc(unit, time))
    for (begin,) in slices.select("_unit").distinct().orderBy(F.col("_unit").asc_nulls_first()).collect():  # one row per unit
        slices.where(F.col("_unit").eqNullSafe(F.lit(begin))).drop("_unit").write.mode("append").parquet(path)
    if not slices.take(1):
        df.write.mode("append").parquet(path)
    return path


def stream(spark: SparkSession, path: str, schema, files: int = 4) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def run(df: DataFrame, mode: str, name: str, state: str | None = None) -> DataFrame:
    """Run the stream over all present files; the result is every emitted row with its batch number."""
    spark = df.sparkSession
    out, state = new_folder(spark, name), state or new_folder(spark, f"{name}-state")

    written = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")
        written.append(number)

    q = df.writeStream.outputMode(mode).option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    if not written:  # no file came
        return spark.createDataFrame([], df.schema.add("batch", "long"))
    return spark.read.schema(df.schema.add("batch", "long")).option("basePath", out).parquet(out)


def latest(emitted: DataFrame, keys: list[str]) -> DataFrame:
    """Last state of every key of an update-mode stream."""
    rest = [c for c in emitted.columns if c not in keys and c != "batch"]
    g = emitted.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_s"))
    return g.select(*keys, "_s.*")


def windowed(events: DataFrame, time: str, late: str, length: str, keys: list[str], **aggs: Column) -> DataFrame:
    """Tumbling-window aggregates per key with a bound on late rows."""
    w = F.window(F.col(time), length)
    g = events.withWatermark(time, late).groupBy(w, *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return g.select(F.col("window.start").alias("start"), *keys, *aggs)


def deduplicated(events: DataFrame, time: str, late: str, keys: list[str]) -> DataFrame:
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def partials(df: DataFrame, make: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """Partial aggregates per micro-batch, for the caller to merge."""
    spark = df.sparkSession
    out, state = new_folder(spark, name), new_folder(spark, f"{name}-state")

    def write(batch: DataFrame, number: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    df.writeStream.option("checkpointLocation", state).trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    return spark.read.option("basePath", out).parquet(out)
