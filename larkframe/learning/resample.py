"""Splits and resamples as columns or long tables; the rows themselves are never copied into sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkframe.operators.grouping import match_join
from larkframe.operators.hashing import hash_positions, hash_ranges, uniform


def ntile(pos: Column, n: Column, k: int) -> Column:
    """Bucket 1..k of a 1-based position among n rows; sizes differ by at most one, larger buckets first."""
    size, extra = F.floor(n / k), n % k
    edge = extra * (size + 1)
    return F.when(pos <= edge, F.ceil(pos / (size + 1))).otherwise(extra + F.ceil(F.try_divide(pos - edge, size))).cast("int")


def ntile_edges(k: int):
    """Last places of buckets 1..k - 1 among n rows; sizes differ by at most one, larger buckets first."""
    return lambda n: [F.floor(n / k) * i + F.least(n % k, F.lit(i)) for i in range(1, k)]


def initial_split(df: DataFrame, keys: list[str], prop: float = 0.75, seed: str = "split", strata: list[str] | None = None) -> DataFrame:
    """``role`` train or test; exact share, in each stratum when given."""
    d = hash_ranges(df, keys, seed, lambda n: [F.floor(n * F.lit(prop))], strata, "_range")
    return d.withColumn("role", F.when(F.col("_range") == 1, "train").otherwise("test")).drop("_range")


def three_way(df: DataFrame, keys: list[str], train: float, valid: float, seed: str = "three") -> DataFrame:
    d = hash_ranges(df, keys, seed, lambda n: [F.floor(n * F.lit(train)), F.floor(n * F.lit(train + valid))], None, "_range")
    role = F.when(F.col("_range") == 1, "train").when(F.col("_range") == 2, "validation").otherwise("test")
    return d.withColumn("role", role).drop("_range")


def vfold(df: DataFrame, keys: list[str], v: int, seed: str = "fold", strata: list[str] | None = None, name: str = "fold") -> DataFrame:
    """Fold number of the assessment set that holds the row; analysis rows of fold i are all rows with another number."""
    return hash_ranges(df, keys, seed, ntile_edges(v), strata, name)


def repeated(df: DataFrame, times: int) -> DataFrame:
    """Each row once per repeat number."""
    return df.withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(times))))


def vfold_repeated(df: DataFrame, keys: list[str], v: int, times: int, seed: str = "fold") -> DataFrame:
    return hash_ranges(repeated(df, times), keys + ["rep"], seed, ntile_edges(v), ["rep"], "fold")


def mc_split(df: DataFrame, keys: list[str], prop: float, times: int, seed: str = "mc") -> DataFrame:
    d = hash_ranges(repeated(df, times), keys + ["rep"], seed, lambda n: [F.floor(n * F.lit(prop))], ["rep"], "_range")
    return d.withColumn("role", F.when(F.col("_range") == 1, "analysis").otherwise("assessment")).drop("_range")


def drawn(spark: SparkSession, n: int, times: int, seed: str = "boot") -> DataFrame:
    """(_pos, draws): for each place among n rows that any replicate draws, how often each of the replicates draws it.

    A draw depends on replicate and number only, so no row is read for it. Draws are dealt by place before they are counted.
    """
    draws = repeated(spark.range(1, n + 1).select(F.col("id").alias("_pos")), times).withColumn("_n", F.lit(n))
    draws = draws.select((F.floor(uniform(["rep", "_pos"], seed) * F.col("_n")) + 1).alias("_pos"), F.col("rep").cast("short").alias("rep"))
    counts = [F.count(F.when(F.col("rep") == i, 1)) for i in range(1, times + 1)]
    return draws.repartition("_pos").groupBy("_pos").agg(F.array(*counts).alias("draws"))


def bootstraps(df: DataFrame, keys: list[str], times: int, seed: str = "boot") -> DataFrame:
    """Rows drawn with replacement, n draws per replicate: (rep, keys, times drawn); rows not drawn are out of bag."""
    placed = hash_positions(df.select(*keys), keys, seed, None, "_pos", "_n").drop("_n")
    found = drawn(df.sparkSession, df.count(), times, seed).join(placed, "_pos")
    return found.select(F.posexplode("draws").alias("rep", "times"), *keys).where("times > 0").select((F.col("rep") + 1).alias("rep"), *keys, "times")


def group_vfold(df: DataFrame, group: str, v: int, seed: str = "group") -> DataFrame:
    """Whole groups per fold."""
    folds = vfold(df.select(group).distinct(), [group], v, seed)
    return match_join(df, folds, [group])


def rolling_origin(n: int, initial: int, assess: int, skip: int = 0, cumulative: bool = True) -> list[tuple[int, int, int, int, int]]:
    """(split, first and last analysis index, first and last assessment index), 1-based; ``skip`` thins the list."""
    out = []
    for s, end in enumerate(range(initial, n - assess + 1, skip + 1), 1):
        out.append((s, 1 if cumulative else end - initial + 1, end, end + 1, end + assess))
    return out
