"""A training-data pipeline over ``documents``: each stage applies one operator.

Stages take and return documents (``doc_id, text, lang, source, n_chars``); the last
returns what it measures of each. What a stage returns is written as Parquet and read
again before the next one, so that a lost executor costs one stage at most.

A text that a stage changes has its ``n_chars`` counted anew; a document of whose text
nothing is left is dropped. Null and blank texts are documents like others. Documents may
have further columns of any name; they stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, decontaminate, jaccard_join, quality, suffix_dedup
from millrace.llm.queries import GOOD, quality_machine
from millrace.sources.shared import new_run_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    own = _own(docs)
    machine = quality_machine(spark, docs, sf_dir)
    good = quality.score(own, _own_name(docs, "text"), machine).filter(F.col("score") >= GOOD)
    return good.select(*own.columns).toDF(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the least id."""
    return jaccard_join.keep_one(docs, "doc_id", "text")


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without byte strings that repeat anywhere in the corpus."""
    names = (_own_name(docs, "doc_id"), _own_name(docs, "text"))
    found = suffix_dedup.remove_repeats(_own(docs), *names)
    return _with_text(found, F.col("kept_text"), F.col("n_removed") > 0, docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the words that occur in the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    text = _own_name(docs, "text")
    found = decontaminate.find_contamination(_own(docs), text, items, "item_id", "text")
    return _with_text(found, F.col("clean_text"), F.col("n_hit") > 0, docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens and digests of what is left."""
    return bpe.encode_texts(docs, "doc_id", "text", keep_ids=False)


def _own(docs: DataFrame) -> DataFrame:
    """``docs`` under names that no operator gives to what it adds, so that documents may
    have columns of any name."""
    return docs.toDF(*(f"own_{i}" for i in range(len(docs.columns))))


def _own_name(docs: DataFrame, name: str) -> str:
    return f"own_{[column.lower() for column in docs.columns].index(name)}"


def _with_text(found: DataFrame, text: Column, changed: Column, docs: DataFrame) -> DataFrame:
    found = found.filter(~changed | (F.length(F.trim(text)) > 0))
    columns = []
    for name in docs.columns:
        column = F.col(_own_name(docs, name.lower()))
        if name.lower() == "text":
            column = text
        elif name.lower() == "n_chars":
            column = F.when(changed, F.length(text).cast("bigint")).otherwise(column)
        columns.append(column.alias(name))
    return found.select(*columns)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_documents),
    ("n-gram Jaccard join", one_of_each_group),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", encode),
]

# Learned scores, components and byte spans are beyond SQL; tests compare the stages
# with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_run_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
