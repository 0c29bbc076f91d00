"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.bitsliced_topk import top_k
from riskloom.llm.collocations import collocations
from riskloom.llm.common import table
from riskloom.llm.conversation_repair import damaged, repair
from riskloom.llm.decontamination import find_leaks
from riskloom.llm.license_scan import document_files, scan_licences
from riskloom.llm.license_scan import sql as licence_sql
from riskloom.llm.line_dedup import SQL as LINE_DEDUP_SQL
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.multi_index import nearest
from riskloom.llm.packing import pack
from riskloom.llm.quality import score_quality, train
from riskloom.llm.simhash_dedup import near_duplicates
from riskloom.llm.substring_dedup import dedup_substrings
from riskloom.llm.token_output import read_back, write_shards
from riskloom.llm.warc import read_records, write_archives


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file; every executor has the same ones installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents"), with_text=False)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_quality(documents, train(documents, table(spark, sf_dir, "labels")))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(document_files(table(spark, sf_dir, "documents")))
    doc_id = F.element_at(F.split("path", "/"), -1).cast("long")
    return found.select(doc_id.alias("doc_id"), "path", "licence", "score", "origin", "licence_path")


def op4_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, folder = write_archives(table(spark, sf_dir, "pages"))
    return read_records(index, folder, with_payload=False)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards, folder = write_shards(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return read_back(shards, folder)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(conversations, damaged(conversations))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def sql_texts() -> dict[str, str]:
    return {"op3_license_scan": licence_sql(), "op7_line_dedup": LINE_DEDUP_SQL}
