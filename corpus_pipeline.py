"""A corpus pipeline: good documents, without boilerplate, copies and leaks, packed for training.

What every stage does with odd input:

- null and empty texts: the classifier scores them like any other text; they have no lines and
  hold no benchmark item; they share fingerprint zero, so near-dedup keeps one of them; packing
  gives them a piece of the end id alone.
- very long texts are read whole, each by one task.
- rows repeated in full and ties on doc_id: the classifier and line dedup treat each row by
  itself, a repeated row counting once for its site; near-dedup keeps one row of a group;
  packing packs every row that it gets.
- an empty table gives an empty table with the same columns, and packing its own.
- further columns, whatever their names, pass through all stages but the last unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm.common import settle, table
from riskloom.llm.decontamination import without_leaks
from riskloom.llm.line_dedup import dedup_lines
from riskloom.llm.packing import pack
from riskloom.llm.quality import keep_good, train
from riskloom.llm.queries import tokenizer_path
from riskloom.llm.simhash_dedup import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier keeps; it learns from these documents' labels."""
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without cross-site lines; n_chars counts what is left of a changed text.

    A caller's own columns named as the operator's results pass unchanged, and a table without
    n_chars gets none.
    """
    own = {c: f"_own_{c}" for c in docs.columns if c in ("n_lines", "n_removed")}
    clean = dedup_lines(docs.withColumnsRenamed(own))
    if "n_chars" in docs.columns:
        left = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.col("n_removed") > 0, left).otherwise(F.col("n_chars")))
    return clean.select([F.col(own.get(c, c)).alias(c) for c in docs.columns])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in the training sequences."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: Neither the classifier nor the tokenizer can be stated in SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``; each one's rows are settled before the next reads them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
