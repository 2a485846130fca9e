"""The corpus pipeline: language ID, line dedup, SimHash near-dedup, benchmark
decontamination, best-fit packing. Each stage is written as Parquet and reread
as the next one's documents; all but the last return the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trip_star.llm import decontaminate, langid, line_dedup, packing, simhash
from trip_star.llm.common import materialise


# A text in which no language reaches this mean probability is rejected, as is one without letters.
MIN_LANGUAGE_SCORE = 0.3


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a determinable language go; the model is fitted on labelled rows of ``docs``."""
    judged = langid.predict(docs, langid.train_on_folds(docs))
    return judged.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated long lines go; ``n_chars`` follows the text that is left."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontaminate.find_contamination(docs, items).filter(~F.col("contaminated")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document that is left, with its place in a sequence."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"stage-{name}")
    return docs


# Model scores, learned packings and tokenizer ids have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None
