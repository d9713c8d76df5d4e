"""Corpus pipeline: language, exact copies, near copies, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.llm.common import drop_rows, table
from parcelspark.llm.exact import drop_exact_duplicates
from parcelspark.llm.langid import UNKNOWN, identify
from parcelspark.llm.ngram import drop_near_duplicates
from parcelspark.llm.packing import pack
from parcelspark.session import setting, stage

#: A document goes when its language is unknown or no language reaches this mean probability.
LEAST_SCORE = 0.4
#: Id behind each document.
END_ID = 2
#: Rows of an Arrow batch. Whole texts lie in it twice, in the executor and in its Python worker, for each
#: core, beside the workers' memory from the step before.
BATCH_ROWS = 500

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch meanwhile; a smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    with setting(spark, name, before if 0 < before <= rows else rows):
        yield


def in_small_batches(step: Step) -> Step:
    """The step with small batches in what it runs itself; no step leaves Python to its result."""
    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with small_batches(spark):
            return step(spark, docs, sf_dir)

    return run_step


@in_small_batches
def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter in a language that the network recognizes.

    Rows with a null doc_id are judged together: one that is recognized keeps all of them.
    """
    found = identify(docs).select("doc_id", (
        (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)).alias("known"))
    return drop_rows(docs, found.groupBy("doc_id").agg(F.bool_or("known").alias("known"))
                     .filter(~F.col("known")).select("doc_id"))


@in_small_batches
def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact_duplicates(docs)


@in_small_batches
def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


@in_small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)


STAGES = [("language", known_language), ("exact_dedup", without_copies),
          ("near_dedup", without_near_copies), ("packing", packed)]

#: A trained network decides the first stage, so SQL can't give the rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, step in STAGES[:-1]:
            docs = stage(step(spark, docs, sf_dir), name)
        return STAGES[-1][1](spark, docs, sf_dir)
