"""A training corpus from ``documents``: language identification, near-copy
removal, repeated-passage removal, mixing to source targets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``, so a lost executor
costs its stage's tasks only. All stages but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import new_dir, table
from ledgerloom.llm.op4_retrieval_packing import pack_stage
from ledgerloom.llm.op6_language_id import keep_identified
from ledgerloom.llm.op7_simhash_dedup import keep_one_of_each
from ledgerloom.llm.op8_source_mixing import take_mixture
from ledgerloom.llm.op9_suffix_dedup import cut_repeats

STAGES = [
    ("language_id", keep_identified),
    ("simhash_dedup", keep_one_of_each),
    ("suffix_dedup", cut_repeats),
    ("source_mixing", take_mixture),
    ("packing", pack_stage),
]

#: No SQL: the stages learn profiles, hash, tokenize and pack; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the corpus in ``sf_dir``."""
    folder, docs = new_dir(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
