"""Corpus cleaning in five stages over the documents table. Each stage works on all that the one before kept.

1. language: documents without a letter, or whose words are of no learned language, go.
2. lines: later occurrences of three-line windows are removed.
3. near copies: one document of each class stays, the one with the smallest doc_id.
4. passages: later occurrences of passages of 50 words or more are cut out.
5. packing: the ids of what is left, in sequences of at most 2048.

All stages but the last return the columns of documents. Null texts have no letter and go in stage 1; documents that lose all
their lines or words go with them; rows that repeat doc_id and text are one from stage 3 on; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from larkframe.llm.bag_minhash import keep_one_of_each
from larkframe.llm.common import written
from larkframe.llm.language_crf import keep_identified
from larkframe.llm.line_dedup import keep_new_lines
from larkframe.llm.packing import pack
from larkframe.llm.suffix_dedup import keep_new_passages


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_new_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_new_passages(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    # smaller caches than by itself: the Python workers stay for the stages of a following run, and so does part of their memory
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), cache=1 << 17)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("passages", passages), ("packing", packing)]

#: SQL states neither the learned model of the first stage nor the tokenizer of the last; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
