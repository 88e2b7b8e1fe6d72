"""The corpus pipeline: quality rules, toxicity, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before it kept; its
result is written as Parquet and read again as the next stage's documents. All but the last return the
columns of the documents they were given, whatever these are; the last returns the packed pieces.

Documents with NULL or empty text have no words and go with the quality rules. Repeated rows are judged
alike by the first two stages, and one of them stays after the third. An empty table gives no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costmart.llm import packing, quality, simhash, toxicity
from costmart.llm.frames import ship_package, table
from costmart.session import stage_table



def _stage(function):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, docs, sf_dir)

    return run


STAGES = [
    ("quality_rules", _stage(quality.stage)),
    ("toxicity", _stage(toxicity.stage)),
    ("near_duplicates", _stage(simhash.stage)),
    ("packing", _stage(packing.stage)),
]

# Trained models, components and packing can't be said in SQL; tests/llm holds the run against
# a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
