"""Registered queries: name → callable(spark, sf_dir) → DataFrame.

Every query derives its inputs from the driver tables under ``sf_dir`` and
runs over them whole. ``comparable`` is the last projection of each query:
exact decimals become DOUBLE so both engines hand back the same Python values.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.plans.models import MODELS, ModelSet
from ledgerloom.session import apply_core_conf
from ledgerloom.sources import driver_tables as DT

Query = Callable[[SparkSession, str], DataFrame]


def comparable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = F.round(c, 6) if f.dataType.scale > 6 else c      # averages, for the comparison only
            c = c.cast("double").alias(f.name)
        cols.append(c)
    return df.select(*cols)


def model_set(spark: SparkSession, sf_dir: str) -> ModelSet:
    """Models over the driver tables in ``sf_dir``."""
    apply_core_conf(spark)
    return ModelSet(DT.raw_tables(spark, sf_dir), as_of=DT.FIXTURE_AS_OF)


def _model_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(model_set(spark, sf_dir)[name])
    run.__name__ = name
    return run


def _with_conf(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {name: _model_query(name) for name in MODELS}
    from ledgerloom import extra_queries
    out.update(extra_queries.queries())
    return {name: _with_conf(fn) for name, fn in out.items()}
