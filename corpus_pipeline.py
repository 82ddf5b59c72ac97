"""From documents to training shards: five stages, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.storage import shared_dir

STAGES = [
    ("quality", stages.quality),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("mix", stages.mix),
    ("shard", stages.shard),
]

#: A learned classifier and Unicode-aware templates have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{at}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
