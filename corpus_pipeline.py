"""The corpus pipeline: language, near duplicates, repeated passages, benchmark passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quayside.llm.decontaminate import drop_contaminated
from quayside.llm.language import keep_known
from quayside.llm.minhash import keep_one
from quayside.llm.packing import pack_stage
from quayside.llm.suffix import cut_repeats
from quayside.settings import materialize

STAGES = [
    ("language", keep_known),
    ("near_duplicates", keep_one),
    ("repeated_passages", cut_repeats),
    ("benchmark_passages", drop_contaminated),
    ("packing", pack_stage),
]

#: tokens, hashes of bytes and learned models are not for SQL: tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
