"""Measured hot keys of the salted join."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import joins as J


def skewed(spark, n, hot):
    """n rows; a third of them on one key, a tenth without a key if ``hot``."""
    k = F.concat(F.lit("k"), (F.xxhash64("id") % 997).cast("string"))
    if hot:
        k = F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(k)
    return spark.range(n).select("id", k.alias("k"))


@pytest.mark.parametrize("n", [3_000, 30_000, 300_000])
def test_hot_keys_are_spread_in_proportion(spark, n):
    base, parts = skewed(spark, n, True), 24
    hot = J.hot_keys(base, "k", parts)
    assert set(hot) == {"hot", None} and 8 <= hot["hot"] <= 9 and 2 <= hot[None] <= 3
    salted = base.withColumn("s", F.pmod(F.xxhash64("id"), J._salts("k", hot, base.schema["k"].dataType)))
    sizes = sorted(r.n for r in salted.groupBy("k", "s").agg(F.count(F.lit(1)).alias("n")).collect())
    assert sizes[-1] <= 1.25 * n / parts            # no task need get more than about a fair share of one key
    side = base.where("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    got, want = J.salted_left_join(base, side, "k", "id"), base.join(side, "k", "left")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == n


def test_no_copies_without_skew(spark):
    base = skewed(spark, 30_000, False)
    assert J.hot_keys(base, "k", 24) == {}
    side = base.groupBy("k").agg(F.count(F.lit(1)).alias("c"))
    plan = J.salted_left_join(base, side, "k", "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and J._SALT not in plan
    assert J.salted_left_join(base.limit(0), side, "k", "id").count() == 0
