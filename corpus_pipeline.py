"""A corpus pipeline over ``documents``: every stage works on what the one before has kept.

``STAGES`` lists name and function of each stage. A function takes the session, the documents
so far and the folder of the tables; its result is written as Parquet and read again as the
next one's documents. All stages but the last return the columns of ``documents``; the last
returns the packed pieces.

Every stage takes an empty table (no rows come out), other columns of any name, which it hands on,
texts of any length, which it reads whole, and repeated rows. What it does with nulls, empty texts
and ties stands with the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillwise.llm.bag_minhash import drop_near_duplicates
from tillwise.llm.fertility import keep_good
from tillwise.llm.fm_index import benchmark_blocks, decontaminate
from tillwise.llm.packing import pack
from tillwise.llm.recompression import remove_repeats
from tillwise.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the base rules or the fertility bands reject.

    Null and empty texts have fewer than 10 words and go; equal rows are judged alike, whatever their ids.
    """
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each class of near-duplicates.

    Rows without doc_id all stay, and so do texts without a word; of rows with one id and equal words one stays,
    unlike texts of one id are judged apart.
    """
    return drop_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove the words of passages that start in an earlier document, too.

    A null id is later than all others; rows of one id do not shorten each other. Texts without words stay.
    """
    return remove_repeats(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out what occurs of the benchmark's items.

    Items without id are cut like others, items without text have no words; texts without words stay.
    """
    return decontaminate(docs, benchmark_blocks(spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences; a row per piece.

    Null and empty texts are the closing id alone; a null id is handed on.
    """
    return pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", packing),
]

#: Tokenisers, signatures and packing are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``; the result of each but the last is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
