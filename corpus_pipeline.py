"""A corpus pipeline over ``documents``: quality, boilerplate lines, near
duplicates, source mixture, packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before it kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tickerlens.llm import line_templates, minmax_dedup, packing, quality_rules, temperature_mixing
from tickerlens.llm.common import freed, load, shared_folder

#: The mixture repeats no source more often than this.
MAX_REPEATS = 2.0


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the robust outlier test pass."""
    return quality_rules.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines of recurring templates, but for their first.
    Long lines that a few documents share are left: most of them stand in
    copies, which the next stage takes as a whole.  Nulls, empty and long texts,
    ties, repeated rows, clashing names and an empty table: see there."""
    return line_templates.without_recurring_lines(docs, long_docs=line_templates.MIN_DOCS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group at a similarity of 0.8 on five-word shingles."""
    return minmax_dedup.keep_first(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once, and those of small sources again up to their weight."""
    return temperature_mixing.mixed(docs, max_repeats=MAX_REPEATS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", line_dedup),
    ("near-duplicate documents", near_dedup),
    ("source mixture", mixing),
    ("sequence packing", packed),
]

#: Hashed signatures, fitted estimates and a tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written to the
    shared folder and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-pipeline-{uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES[:-1]):
        made = stage(spark, docs, sf_dir)
        with freed(spark):
            made.write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return STAGES[-1][1](spark, docs, sf_dir)
