"""From raw documents to tokens: language, boilerplate lines, near-duplicates, mix, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queuelog.llm import boilerplate, language, mixing, shingles, transducer
from queuelog.llm.common import held_out, staged
from queuelog.model import scratch_path

#: Least posterior of the predicted language; words of a shingle and least similarity of near-duplicates.
SURE, SHINGLE, SIMILAR = 0.5, 5, 0.8


def _texts(df: DataFrame, names: list[str]) -> DataFrame:
    """The columns of documents, ``n_chars`` again that of the text."""
    return df.withColumn("n_chars", F.length("text").cast("bigint")).select(*names)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language is in doubt."""
    langs, logp = language.fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    found = language.identify(docs, langs, logp)
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= SURE)).select(*docs.columns)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that many pages of a source share; documents stay."""
    return _texts(boilerplate.drop_boilerplate(docs), docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near-duplicates: that with the smallest doc_id (of several
    texts under it, that with the smallest hash; one without doc_id only where none has one). Of rows
    equal in both, one stays."""
    groups = staged(shingles.grouped(docs, shingle=SHINGLE, similarity=SIMILAR), "groups")
    rank = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("source"))
    first = groups.groupBy("root").agg(F.min(rank).alias("_first")).select(
        F.col("_first.doc_id").alias("_id"), F.col("_first.source").alias("_hash")
    )
    first = staged(first, "first")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    rows = docs.withColumn("_text", shingles.text_hash(F.col("text"))).join(first, same, "left_semi")
    twice = groups.groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_hash")).count().where("count > 1")
    once = rows.join(twice, same, "left_anti")
    one = rows.join(twice, same, "left_semi").dropDuplicates(["doc_id", "_text"])  # texts move only here
    return once.unionByName(one).select(*docs.columns)


def to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether they give back the text."""
    rows = transducer.encode_and_check(docs.select("doc_id", "source", "text"))
    return rows.select("doc_id", "source", "ids", F.size("ids").cast("bigint").alias("n_ids"), "round_trip")


STAGES = [
    ("language", known_language), ("lines", without_boilerplate), ("near_duplicates", one_of_each),
    ("mix", to_weights), ("pieces", to_pieces),
]

#: Posteriors, XXH64 and pieces are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
