"""The corpus pipeline: toxicity, line dedup, near-dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one
before has kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm.common import checkpointed, free_name, table
from waymark.llm.decontaminate import with_matches
from waymark.llm.lines import dedup_lines
from waymark.llm.near import near_duplicates
from waymark.llm.packing import pack
from waymark.llm.toxicity import fit_toxicity, with_toxicity

TOXIC = 0.7


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents whose probability of being toxic reaches ``TOXIC``."""
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    (told,) = free_name(docs, "_toxicity")
    return with_toxicity(docs, model, told).where(F.col(f"{told}.score") < TOXIC).drop(told)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out repeated lines; a document that has nothing left goes. ``n_chars`` follows the text."""
    (had,) = free_name(docs, "_had")
    kept = dedup_lines(docs.withColumn(had, F.trim("text") != "")).where((F.trim("text") != "") | ~F.coalesce(had, F.lit(False)))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each near-duplicate class."""
    found = near_duplicates(docs)
    return found.where(F.col(found.columns[-1])).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    (matches,) = free_name(docs, "_matches")
    found = with_matches(docs, table(spark, sf_dir, "benchmark"), column=matches)
    return found.where(F.size(matches) == 0).drop(matches)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Toxicity, signatures and packing have no SQL form; tests/llm compares each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = checkpointed(docs)
    return docs
