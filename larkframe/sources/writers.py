"""Delimited and JSON writers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_delim(df: DataFrame, path: str, sep: str = ",", decimal: str = ".", encoding: str = "UTF-8") -> str:
    if decimal != ".":
        floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
        df = df.withColumns({c: F.regexp_replace(F.col(c).cast("string"), r"\.", decimal) for c in floats})
    df.write.option("header", True).option("sep", sep).option("encoding", encoding).csv(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    df.write.json(path)
    return path


def write_json_arrays(df: DataFrame, path: str) -> str:
    """One JSON array of objects per file."""

    def framed(batches):
        first = True
        for batch in batches:
            if len(batch):
                objects = ",\n" + batch["value"]
                if first:
                    objects.iloc[0] = "[\n" + batch["value"].iloc[0]
                first = False
                yield pd.DataFrame({"value": objects})
        yield pd.DataFrame({"value": ["[]" if first else "]"]})

    df.select(F.to_json(F.struct("*")).alias("value")).mapInPandas(framed, "value string").write.option("lineSep", "\n").text(path)
    return path
