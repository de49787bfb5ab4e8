"""Corpus pipeline over ``documents``: quality rules, SimHash near-dedup,
benchmark decontamination, source mixing, sharding.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)``
and returns a DataFrame that is written as Parquet and read again as the next
stage's input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from parallex.llm import decontaminate, mixing, quality_rules, sharding, simhash
from parallex.session import ensure_checkpoint_dir

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("simhash_near_dedup", simhash.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("source_mixing", mixing.stage),
    ("sharding", sharding.stage),
]

#: the SimHash, hypergeometric and mixing stages are not SQL-expressible;
#: tests/llm/test_pipeline.py holds the rows against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage returns is written to the
    shared folder, so a lost executor never repeats a finished stage."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
