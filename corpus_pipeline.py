"""Training-corpus pipeline: documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents.

Cases: null and empty texts are rejected by the first stage; null ids pass and are never near duplicates; rows that repeat an id are documents
of their own; columns beyond those of documents pass through under any name; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineweave.llm import jaccard_join, line_dedup, mixing, packing, quality
from lineweave.llm.shared import publish, table


#: Columns that stages read; all others are kept aside, so that their names clash with nothing.
KNOWN = ("doc_id", "text", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def aside(stage: Stage) -> Stage:
    """The stage, with the columns that it does not read renamed while it runs."""

    @functools.wraps(stage)
    def run_(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        names = {c: f"_aside{i}" for i, c in enumerate(docs.columns) if c not in KNOWN}
        return stage(spark, docs.withColumnsRenamed(names), sf_dir).withColumnsRenamed({new: c for c, new in names.items()})

    return run_


@aside
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    model = quality.train(docs)
    if model is None:
        return docs
    others = tuple(c for c in docs.columns if c not in ("doc_id", "text"))
    scored = quality.classify(docs, model, others=others).where("kept").withColumnRenamed("id", "doc_id")
    return scored.select(*docs.columns)


@aside
def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs).select(*docs.columns)
    return out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else out


@aside
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; documents without shingles are in no group."""
    gone = publish(jaccard_join.shingle_classes(docs).where("component_id <> id").select(F.col("id").alias("gone")).distinct(), "pipeline-gone")
    return docs.join(gone, docs.doc_id == gone.gone, "left_anti")


@aside
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in the order of the mix: files are sorted by slot, and their numbers follow it."""
    return mixing.mixed(docs)


@aside
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces and their places in sequences of 2048 ids."""
    return packing.packed_rows(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("source mixing", mixing_stage),
    ("best-fit packing", packing_stage),
]

#: Trained scorers and tokenizers are beyond SQL; tests/llm compares run() with a version in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied to all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = publish(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
