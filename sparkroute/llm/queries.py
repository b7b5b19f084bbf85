"""The registered queries of the subpackage, each over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.llm import (
    chat_repair,
    fingerprints,
    hard_negatives,
    html_extraction,
    jaccard_join,
    license_scan,
    mixing,
    quality_classifier,
    quality_rules,
    sentencepiece_sampling,
    sharding,
    structure_repair,
    warc_archive,
)

PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, name = quality_rules.quality_rules(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", f"{name}.*")


ORACLES["op1_quality_rules"] = quality_rules.ORACLE


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op9_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, name = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", *[f"{name}.{c}" for c in ("size", "source_size", "target", "taken")])


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, name = sharding.shard_documents(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return placed.select(
        "doc_id", f"{name}.size", f"{name}.text_crc32", F.lit("bytes").alias("law"), f"{name}.shard", f"{name}.slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    scored, name = quality_classifier.score(docs, model, keep=["doc_id"])
    return scored.select(
        "doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % quality_classifier.FOLDS == 0).alias("held_out"),
        F.col(name).alias("score"), (F.col(name) >= quality_classifier.KEEP_FROM).cast("int").alias("predicted"))


@query
def op4_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepiece_sampling.encode(table(spark, sf_dir, "documents"), PIECE_MODEL)
    return encoded.select("doc_id", F.size("samples").alias("n_samples"), "samples", "decoded")


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc_archive.write_archives(table(spark, sf_dir, "pages"))
    records = warc_archive.read_archives(spark, archives)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "error")


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extraction.extract(pages, html_extraction.fit(pages))


@query
def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_repair.repaired(table(spark, sf_dir, "conversations"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op13_hard_negatives"] = hard_negatives.ORACLE


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.damage_report(table(spark, sf_dir, "conversations"))


@query
def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.labelled(license_scan.scan(table(spark, sf_dir, "documents")))
