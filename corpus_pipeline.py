"""The corpus pipeline: raw documents to packed training sequences.

Each stage reads what the one before wrote; ``run`` applies all of them to ``documents``.

1. quality classifier: documents that it rejects go;
2. line dedup: later copies of repeated line runs are deleted from the texts, and documents of which nothing but blanks is left go;
3. n-gram Jaccard join (five words, similarity 0.8): one document of each group stays;
4. benchmark decontamination: documents that hold a test item go;
5. packing: the kept documents become token sequences.

SQL can't express the stages (trained classifier, tokenizer), so there is no ORACLE_SQL; tests/llm compares with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from casebook.llm.frames import stored, table
from casebook.llm.queries import tokenizer_path
from casebook.session import ship_package

ORACLE_SQL = None


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return quality.split(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = line_dedup.dedup_lines(docs)
    emptied = (F.col("n_removed") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    text = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return out.where(~emptied).select(*text)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return jaccard_join.one_of_each(docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", accept_quality),
    ("line_dedup", delete_repeated_lines),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaked),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
