"""From raw documents to sampled token sequences: five stages, each on what the one before kept.

Every stage reads the rows its predecessor wrote and, but for the last, returns the columns of
``documents``. Each handles nulls in any column, empty and very long texts, repeated rows, empty
tables and extra columns as the operator behind it states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkroute.llm import jaccard_join, mixing, quality_classifier, quality_rules, sentencepiece_sampling
from sparkroute.llm.common import fresh, write_once
from sparkroute.llm.queries import PIECE_MODEL

#: Near copies share this percentage of their distinct shingles of so many words.
NEAR_PERCENT = 80
NEAR_WORDS = 5


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, and whose host does."""
    judged, name = quality_rules.quality_rules(docs)
    return judged.where(F.col(f"{name}.kept")).drop(name)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good; it learns from the labelled ones among them."""
    model = quality_classifier.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored, name = quality_classifier.score(docs, model)
    return scored.where(F.col(name) >= quality_classifier.KEEP_FROM).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group that is linked by the n-gram Jaccard join: the first by id and text, null ids last.

    Links are of five-word shingles and a similarity of 0.8 or more, between rows whatever their
    ids: several texts of one id are documents of their own. Texts without words link with
    nothing; of those, repeated rows of one id and text are one, and those without an id all stay.
    """
    found = docs.agg(F.count("*").alias("n"), F.countDistinct("doc_id").alias("ids")).first()
    if found["n"] == found["ids"]:
        groups = jaccard_join.jaccard_components(docs, percent=NEAR_PERCENT, shingle=NEAR_WORDS)
        gone = write_once(groups.where("component_id <> doc_id").select(F.col("doc_id").alias("gone")), "gone")
        return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")
    row = fresh(docs, "row")
    numbered = write_once(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = write_once(jaccard_join.jaccard_components(numbered, id_col=row, percent=NEAR_PERCENT, shingle=NEAR_WORDS), "groups")
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    rows = numbered.select(F.col(row).alias("at"), "doc_id", "text", whole.alias("whole"))
    rows = rows.join(groups.select(F.col(row).alias("at"), "n_shingles", "component_id"), "at")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text", "whole", "at")).alias("first")
    linked = rows.where("n_shingles > 0").groupBy("component_id").agg(first).select("first.at")
    wordless = rows.where("n_shingles = 0")
    named = wordless.where("doc_id is not null").groupBy("doc_id", "text").agg(first).select("first.at")
    stay = write_once(linked.unionByName(named).unionByName(wordless.where("doc_id is null").select("at")), "stay")
    return numbered.join(stay, F.col(row) == F.col("at"), "left_semi").drop(row)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them, the last copy cut where it ends."""
    return mixing.taken_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of each document."""
    encoded = sentencepiece_sampling.encode(docs, PIECE_MODEL)
    return encoded.select("doc_id", F.size("samples").alias("n_samples"), "samples", "decoded")


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode_pieces),
]

#: The classifier and the sampled segmentations cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), "stage-" + name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
