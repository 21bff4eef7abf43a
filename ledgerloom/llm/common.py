"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import shared_dir

#: Rows of an Arrow batch handed to Python: whole texts, so a batch stays small.
ARROW_ROWS = "512"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table, read by Spark (any file system it knows)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Python side's memory: few whole texts in an Arrow batch."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)


def held_out(doc_id: str = "doc_id") -> Column:
    """True where crc32(doc_id as text) mod 5 is 0 (and for a null id, which
    is therefore never learned from)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def share_of(key: Column, fraction: Column) -> Column:
    """Deterministic sample: true for ``fraction`` of the distinct keys."""
    u = F.pmod(F.xxhash64(key, F.lit(77)), F.lit(1 << 30)) / float(1 << 30)
    return u < fraction


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared folder for one run."""
    return os.path.join(shared_dir(spark), f"llm-{name}-{uuid.uuid4().hex[:12]}")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so a lost
    executor never recomputes what came before."""
    spark = df.sparkSession
    path = new_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Stored tables of one computation, removed together when it is done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def store(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(new_dir(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def drop(self) -> None:
        for path in self.paths:
            drop_dir(self.spark, path)
        self.paths = []


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder made by ``new_dir`` (any file system Spark knows)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def blocks_for(n: int, size: int, least: int = 1) -> int:
    return max(least, math.ceil(n / size))
