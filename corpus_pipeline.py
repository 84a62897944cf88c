"""A training corpus from documents: quality rules, line dedup, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import line_dedup, mixing, near_copies, packing, quality
from lexmill.llm.common import materialise, table

STAGES = [
    ("quality_rules", quality.stage),
    ("line_dedup", line_dedup.stage),
    ("simhash_near_dedup", near_copies.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

#: Tokenizers and XXH64 have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
