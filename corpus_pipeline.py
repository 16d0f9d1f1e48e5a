"""A training corpus from raw documents, stage by stage.

Each stage works on all that the one before kept.  Stages return the columns of
``documents``; the last returns the packed windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored
from flowlake.llm.lines import dedup_lines
from flowlake.llm.packing import pack_documents
from flowlake.llm.quality import select_documents, train_quality
from flowlake.llm.queries import SURROGATE_KEY, graded_labels, tokenizer_file
from flowlake.llm.simhash import keep_first
from flowlake.llm.surrogates import replace_entities


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rated ones, does not reject."""
    model = train_quality(docs, graded_labels(spark, sf_dir))
    return select_documents(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that resemble an earlier one; no document goes."""
    return dedup_lines(docs, keep_columns=True)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_first(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced; null texts stay null."""
    # Under a name that no column of the documents has.
    count = max(docs.columns, key=len) + "_replaced"
    replaced = replace_entities(docs, SURROGATE_KEY, count)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of tokens."""
    return pack_documents(docs, tokenizer_file("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("surrogates", surrogates),
    ("packing", packing),
]

# A trained model, XXH64 fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
