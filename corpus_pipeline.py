"""The corpus pipeline: operators of ``tessera.llm`` applied to ``documents`` one after another."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.llm.common import materialize
from tessera.tables import table

#: (name, function): each takes (spark, docs, sf_dir) and keeps the columns of documents, but for the last.
STAGES = [
    ("quality rules", stages.quality),
    ("n-gram Jaccard join", stages.near_duplicates),
    ("suffix-array dedup", stages.suffix_dedup),
    ("benchmark decontamination", stages.decontaminate),
    ("bpe", stages.bpe),
]

#: The fitted quality model has no SQL; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; between stages the documents are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
