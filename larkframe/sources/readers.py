"""Readers for delimited, fixed-width and JSON text with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def na_to_null(df: DataFrame, tokens: list[str]) -> DataFrame:
    """String columns with the listed tokens (or only blanks) read as null."""
    names = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(*[
        F.when(~F.trim(F.col(c)).isin(*tokens, ""), F.trim(F.col(c))).alias(c) if c in names else F.col(c) for c in df.columns
    ])


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Tolerant casts; ``number`` drops currency signs and group separators first."""
    def one(name: str) -> Column:
        kind = types.get(name)
        if kind is None:
            return F.col(name)
        if kind == "number":
            return parse_number(F.col(name)).alias(name)
        return F.col(name).try_cast(kind).alias(name)

    return df.select(*[one(c) for c in df.columns])


def parse_number(x: Column) -> Column:
    """First number in a text, without group separators; null when there is none."""
    return F.regexp_replace(F.regexp_substr(x, F.lit(r"-?[0-9][0-9,]*\.?[0-9]*")), ",", "").try_cast("double")


def read_delim(
    spark: SparkSession, path: str, sep: str = ",", schema: str | None = None, types: dict | None = None,
    na: list[str] | None = None, encoding: str = "UTF-8", select: list[str] | None = None, comment: str | None = None,
) -> DataFrame:
    """Delimited text with a header. Without a schema, columns are inferred; with ``types``, read as text and cast."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
    if comment:
        reader = reader.option("comment", comment)
    if schema:
        df = reader.schema(schema).csv(path)
    elif types is not None:
        df = reader.csv(path)
    else:
        df = reader.option("inferSchema", True).csv(path)
    if na:
        df = na_to_null(df, na)
    if types:
        df = cast_columns(df, types)
    return df.select(*select) if select else df


def read_lines(spark: SparkSession, path: str, skip: int = 0, comment: str | None = None) -> DataFrame:
    """Lines of text files without the first ``skip`` lines of each file and without comment lines.

    Only the first split of a file has to be numbered, so a window holds at most one input split.
    """
    d = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_b"))
    if skip:
        d = d.withColumn("_i", F.monotonically_increasing_id())
        head = d.where(F.col("_b") == 0)
        head = head.withColumn("_k", F.row_number().over(Window.partitionBy("_f").orderBy("_i"))).where(F.col("_k") > skip)
        d = head.select("value").unionAll(d.where(F.col("_b") > 0).select("value"))
    d = d.select("value")
    return d.where(~F.col("value").startswith(comment)) if comment else d


def split_lines(lines: DataFrame, names: list[str], sep: str = ",") -> DataFrame:
    """Delimited lines to text columns with the given names."""
    schema = ", ".join(f"`{n}` string" for n in names)
    return lines.select(F.from_csv("value", F.lit(schema), {"sep": sep}).alias("_r")).select("_r.*")


def read_fwf(spark: SparkSession, path: str, fields: dict[str, tuple[int, str]]) -> DataFrame:
    """Fixed-width text: ``fields[name] = (width, type)`` in order."""
    out, start = [], 1
    for name, (width, kind) in fields.items():
        out.append(F.trim(F.substring("value", start, width)).try_cast(kind).alias(name))
        start += width
    return spark.read.text(path).select(*out)


FORMATS = {
    "csv": lambda spark, path: read_delim(spark, path),
    "tsv": lambda spark, path: read_delim(spark, path, sep="\t"),
    "json": lambda spark, path: spark.read.json(path),
    "parquet": lambda spark, path: spark.read.parquet(path),
}


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """Reader chosen by the extension of the path; an unknown extension is an error."""
    ext = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if ext not in FORMATS:
        raise ValueError(f"no reader for files ending in .{ext}")
    return FORMATS[ext](spark, path)
