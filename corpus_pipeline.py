"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, mixture.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it
kept. All but the last return the columns of docs. Nulls, empty texts, repeated
rows, empty tables and further columns are handled as the operators say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.common import column, held_out, remove, shared_folder, table, unused
from geoloom.llm.decontam import decontaminate, is_contaminated
from geoloom.llm.language import UNKNOWN, fit, identify
from geoloom.llm.mixing import mix
from geoloom.llm.neardup import keep_one
from geoloom.llm.pii import pseudonymize, session_key

#: Under this probability no language stands out.
LEAST_LANGUAGE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in no known language: null texts, texts without a letter, and those where none stands out."""
    net = fit(docs.where(~held_out(F.col("doc_id"))))
    pred, score = unused(docs, "language"), unused(docs, "probability")
    found = identify(docs, net, pred=pred, score=score)
    return found.where((F.col(pred) != UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE)).select(*map(column, docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, that of the least doc_id."""
    return keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents: those with a twentieth or more of their words in benchmark windows."""
    out = unused(docs, "found")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"), out=out)
    return found.where(~is_contaminated(out)).select(*map(column, docs.columns))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal values by pseudonyms; n_chars follows where a text changes."""
    count = unused(docs, "pseudonyms")
    found = pseudonymize(docs, session_key(spark), count=count)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.when(F.col(count) > 0, F.length("text")).otherwise(F.col("n_chars")))
    return found.select(*map(column, docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the place in the mixture of sources; mix deals the rows out by about their place, and each part is sorted. Rows without a place come last."""
    return mix(docs).sortWithinPartitions(F.col("mix_position").asc_nulls_last())


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("mixture", mixture),
]

#: Trained networks, hashes and similarities are beyond SQL; tests hold the pipeline against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each but the last returns is written to the shared folder and read again.

    A stage's folder goes once the next one is written; the last stays, as the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            remove(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
