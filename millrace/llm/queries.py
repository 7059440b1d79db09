"""The registered queries of this subpackage: each applies one operator to its whole
table and returns its result in the columns agreed on."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    embedding_dedup,
    jaccard_join,
    language,
    quality,
    substring_dedup,
    suffix_dedup,
    token_files,
    vector_codes,
    warc,
)
from millrace.llm.frames import sha256_of
from millrace.llm.sql import SQL

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without byte strings that repeat."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    done = suffix_dedup.remove_repeats(docs, "doc_id", "text", with_kept=False)
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC files and read back from them."""
    folder = warc.archive_folder(spark)
    pages = _read(spark, sf_dir, "pages")
    manifest = warc.write_archive(pages, "page_id", "url", "html", folder)
    return warc.read_archive(manifest, folder).select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that an earlier one has."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring_dedup.remove_earlier(docs, "doc_id", "text", with_kept=False)
    return done.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that occur in the benchmark, in windows of ten."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    items = _read(spark, sf_dir, "benchmark")
    found = decontaminate.find_contamination(
        docs, "text", items, "item_id", "text", with_text=False
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        sha256_of(F.concat_ws(",", "items")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all vectors."""
    found = embedding_dedup.near_duplicates(
        _read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label"
    )
    kept = F.col("vec_id").eqNullSafe(F.col("component_id"))
    return found.select("vec_id", "n_links", "component_id", kept.alias("kept"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of 0.8 or more."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_join.near_duplicates(docs, "doc_id", "text")
    return found.select("doc_id", "n_shingles", "component_id")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document."""
    docs = _read(spark, sf_dir, "documents")
    return bpe.encode_texts(docs, "doc_id", "text", keep_ids=False)


def op5_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's point of view."""
    turns = _read(spark, sf_dir, "conversations")
    found = chat.render_views(turns, "conv_id", "turn", "role", "text")
    spans = F.transform("masks", lambda m: F.concat_ws("-", m["start"], m["end"]))
    return found.select(
        F.col("conv").alias("conv_id"),
        "view",
        "part",
        "n_turns",
        "start",
        "text",
        F.concat_ws(",", spans).alias("masks"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from four fifths of them."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = F.crc32(F.col("id").cast("string")) % 5
    model = language.fit(docs, "doc_id", "text", "lang", use=remainder != 0)
    found = language.identify(docs.select("doc_id", "text"), "text", model)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def quality_machine(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """The classifier of ``op10`` and of the pipeline, learnt from ``labels``."""
    labels = _read(spark, sf_dir, "labels")
    remainder = F.crc32(F.col("id").cast("string")) % 4
    return quality.fit(
        docs, "doc_id", "text", labels, "doc_id", "quality", use=remainder != 2
    )


GOOD = 0.7  # the least score of a text that is kept


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely every document is good, learnt from three quarters of the labels."""
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality_machine(spark, docs, sf_dir)
    scored = quality.score(docs, "text", machine)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids written to files and read back from them."""
    folder = token_files.token_folder(spark)
    docs = _read(spark, sf_dir, "documents")
    manifest = token_files.write_tokens(docs, "doc_id", "text", folder)
    found = token_files.read_tokens(manifest, folder)
    return found.withColumnRenamed("id", "doc_id")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The phrases of every language whose words belong together."""
    docs = _read(spark, sf_dir, "documents")
    found = collocations.collocations(docs, "text", "lang")
    return found.withColumnRenamed("grp", "lang")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector as four codebook entries, with the errors."""
    vectors = _read(spark, sf_dir, "embeddings")
    coded, books = vector_codes.compress(vectors, "vec_id", "embedding", "label")
    return vector_codes.hex_codes(coded, books)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_suffix_dedup,
        op2_warc,
        op3_substring_dedup,
        op4_benchmark_decontamination,
        op5_chat_views,
        op6_language_id,
        op7_embedding_dedup,
        op8_jaccard_join,
        op9_bpe,
        op10_quality_classifier,
        op11_token_files,
        op12_collocations,
        op13_vector_codes,
    )
}
ORACLE_SQL: dict[str, str] = SQL
