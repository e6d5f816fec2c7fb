"""From documents to packed training sequences.

Each stage takes all that the one before it kept and gives whole rows of
``documents`` on, the last one pieces of token sequences. Stages are written as
tables in between, in the folder that all executors share.

* ``language_id`` drops documents in which no language is found.
* ``near_dedup`` keeps one document of each group of near duplicates.
* ``decontaminate`` drops documents that hold a benchmark item.
* ``secret_scan`` masks secrets where they stand; no document goes for them.
* ``pack`` tokenises what is left and packs it into windows.

Null texts are dropped as without a language. Further columns are kept up to
the last stage. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm.decontaminate import drop_contaminated
from orderflow.llm.language import keep_identified, sample_texts
from orderflow.llm.packing import pack_documents
from orderflow.llm.queries import table, vocabulary_file
from orderflow.llm.secrets import redact_secrets
from orderflow.llm.simhash import keep_representatives
from orderflow.session import staged


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, learned from those that have a label."""
    return keep_identified(docs, "text", sample_texts(docs, "doc_id", "text", "lang"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one of the smallest id."""
    return keep_representatives(docs, "doc_id", "text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, "text", table(spark, sf_dir, "benchmark"), "item_id", "text")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their secrets masked and their lengths kept right."""
    return redact_secrets(docs, "text", "doc_id", "source", length_col="n_chars")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids and their places in sequences."""
    return pack_documents(docs, "doc_id", "text", vocabulary_file())


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

# Cross parsing, XXH64, alignment and tokenisation can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
