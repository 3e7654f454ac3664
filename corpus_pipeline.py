"""Documents to tokens: quality rules, line dedup, near duplicates, source mix, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor kept. Between stages the rows are
written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import jaccard_join, line_dedup, mixing, pieces, quality_rules
from tessera.llm.shared import stored

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a rule go."""
    return quality_rules.kept(docs).select(*_COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that recur across documents stay in one of them. Documents that keep no word go: all they held is elsewhere."""
    out = line_dedup.dedup_lines(docs.select(*_COLUMNS))
    out = out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*_COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return jaccard_join.one_of_each(docs.select(*_COLUMNS)).select(*_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a row a time, none where it isn't taken."""
    return mixing.repeated(docs.select(*_COLUMNS)).select(*_COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the pieces of each document's text."""
    out = pieces.encode(docs)
    return out.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "round_trip")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("encode", encode)]

#: Which copies the mix takes follows a seeded hash that DuckDB doesn't have, and encoding isn't in SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
