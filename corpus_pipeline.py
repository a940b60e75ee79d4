"""Cleaning a corpus for training, in stages; counted as part of the subpackage ``llm``.

Each stage takes what the one before kept: toxic documents go, lines that many documents share go, one document of each
group of near duplicates stays, documents with benchmark passages go, and the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tertulia.llm import decontaminate, line_dedup, near_duplicates, registered, toxicity
from tertulia.llm.tables import read
from tertulia.session import ship_package, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier of operator 1 does not call toxic, learnt from the given documents."""
    ship_package(spark)
    model = registered.toxicity_model(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, into="_toxicity").filter("_toxicity < 0.5").drop("_toxicity")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share (operator 8); ``n_chars`` follows the text."""
    ship_package(spark)
    kept = line_dedup.drop_common_lines(docs).drop("n_lines", "n_dropped")
    return kept.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else kept


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near duplicates (operator 9)."""
    ship_package(spark)
    return near_duplicates.keep_first(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item (operator 10)."""
    ship_package(spark)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 ids and the sequence each lies in (operator 7)."""
    ship_package(spark)
    return registered.packed(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
# A fitted classifier, token ids and first-fit packing are beyond SQL; tests/llm compare every stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; what each keeps is stored before the next one reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
