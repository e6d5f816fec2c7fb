"""One query per operator, over the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import secrets, warc
from orderflow.llm.clustering import cluster_vectors, with_inertia
from orderflow.llm.decontaminate import find_items
from orderflow.llm.fim import fill_in_middle, restored
from orderflow.llm.language import held_out, identify_languages, sample_texts
from orderflow.llm.licenses import scan_licenses
from orderflow.llm.packing import pack_documents
from orderflow.llm.quality import judge_quality
from orderflow.llm.sharding import shard_rows
from orderflow.llm.simhash import near_duplicates
from orderflow.llm.token_counts import PieceAutomaton, byte_pieces, count_tokens
from orderflow.llm.winnowing import compare_edited, mark_digest

SHARDS = 16


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary_file(name: str = "byte_bpe_50k.json") -> str:
    """Where the installed vocabulary lies; operators take it as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Words and greedy word pieces of every document, by the byte-level vocabulary."""
    automaton = PieceAutomaton(byte_pieces(vocabulary_file()))
    return count_tokens(table(spark, folder, "documents"), automaton, "doc_id", "text", lead=b" ")


def op2_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses of every document: how many, the best coverage, and each one's span and words."""
    found = scan_licenses(table(spark, folder, "documents"), "doc_id", "text")
    entry = lambda m: F.concat_ws(":", m["license"], *[m[c].cast("string") for c in ("start", "end", "matched")])
    return found.select(
        "doc_id",
        F.size("licenses").cast("long").alias("n_licenses"),
        F.round(F.array_max(F.transform("licenses", lambda m: m["coverage"])), 6).alias("coverage"),
        F.array_join(F.transform("licenses", entry), ",").alias("spans"),
    )


def op3_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of every document; a document is a repository, its source the owner."""
    documents = table(spark, folder, "documents")
    found = secrets.scan_secrets(documents, "doc_id", "text", "doc_id", "source")
    base = F.filter("spans", lambda s: s["base"])
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    verdict = lambda v: F.size(F.filter("spans", lambda s: s["verdict"] == v)).cast("long")
    return found.select(
        "doc_id",
        *[of(kind.name).alias(f"n_{kind.name}") for kind in secrets.KINDS if kind.base],
        F.sha2(secrets.span_digest(base), 256).alias("base_sha256"),
        secrets.span_digest(F.col("spans")).alias("spans"),
        verdict("live").alias("n_live"),
        verdict("example").alias("n_example"),
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, folder, "documents"), "doc_id", "text")
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where every piece of every document lies in its sequence."""
    pieces = pack_documents(table(spark, folder, "documents"), "doc_id", "text", vocabulary_file())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Benchmark items in documents: which, where, and how many edits away."""
    return find_items(
        table(spark, folder, "documents"),
        "doc_id",
        "text",
        table(spark, folder, "benchmark"),
        "item_id",
        "text",
    )


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document, against its language and source."""
    return judge_quality(table(spark, folder, "documents"), "doc_id", "text", "lang", "source")


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from labelled documents that are not held out."""
    documents = table(spark, folder, "documents")
    samples = sample_texts(documents, "doc_id", "text", "lang")
    found = identify_languages(documents, "doc_id", "text", samples)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The derived records of every page, with what links them to their response."""
    pages = warc.responses(table(spark, folder, "pages"), "page_id", "url", "html")
    records = warc.derivatives(pages, "page_id")
    return records.select(
        "page_id",
        "type",
        warc.header_value("WARC-Record-ID").alias("record_id"),
        warc.header_value("WARC-Refers-To").alias("refers_to"),
        warc.header_value("WARC-Target-URI").alias("target_uri"),
        warc.header_value("WARC-Refers-To-Payload-Digest").alias("source_digest"),
        warc.header_value("WARC-Block-Digest").alias("block_digest"),
        F.length("block").cast("long").alias("block_chars"),
        F.sha2(warc.record_text(), 256).alias("record_sha256"),
    )


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Shard, place and shard after growth of every document."""
    return shard_rows(table(spark, folder, "documents"), "doc_id", "text", SHARDS)


def op11_document_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and what they share."""
    found = compare_edited(table(spark, folder, "documents"), "doc_id", "text")
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        mark_digest(F.col("marks")).alias("fingerprint"),
        mark_digest(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut at two line ends: form, lengths, and checksums of output and restored text."""
    cut = fill_in_middle(table(spark, folder, "documents"), "doc_id", "text")
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster and distance of every vector after ten rounds, with inertia and centroid."""
    placed, centroids = cluster_vectors(table(spark, folder, "embeddings"), "vec_id", "embedding")
    return with_inertia(placed, centroids).select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256"),
    )


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_license_scans": op2_license_scans,
    "op3_secret_scans": op3_secret_scans,
    "op4_simhash": op4_simhash,
    "op5_packing": op5_packing,
    "op6_decontamination": op6_decontamination,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_warc": op9_warc,
    "op10_sharding": op10_sharding,
    "op11_document_fingerprints": op11_document_fingerprints,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_centroid_clustering": op13_centroid_clustering,
}
