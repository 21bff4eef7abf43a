"""N:1 left join that stays spread when a few keys hold much of the base.

``base LEFT JOIN per_key USING (key)``, ``per_key`` an aggregate with one row
per key. AQE's skew split does not apply when ``per_key`` comes straight out of
its aggregate (it is already partitioned by the key, so it is not a shuffle
stage of the join), and one task would get all rows of a hot key.

Hot keys are measured: one aggregate over the base's key column, a mergeable
frequent-items sketch (``approx_top_k``; a count is off by less than
3.5 / ``ITEMS`` of all rows), names every key that holds more than a
partition's fair share of the rows. Only these are salted, with as many salts as
fair shares they fill: their base rows by a hash of a column that spreads them,
and the aggregate's row of such a key is repeated once for each salt. Without
skew nothing is copied and the join is a plain one. Rows with a null key match
nothing and are spread in the same way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST = 512          # keys that are looked for; a key beyond them holds under 1/512 of the rows
ITEMS = 16_384      # counters of the sketch
_SALT = "__salt"


def hot_keys(base: DataFrame, key: str, partitions: int) -> dict:
    """key -> salts of every key (None included) with more rows than a
    partition's fair share; at most ``MOST`` keys."""
    found = base.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"),
                     F.expr(f"approx_top_k(`{key}`, {MOST}, {ITEMS})").alias("top")).first()
    share = max(1.0, found["n"] / min(partitions, MOST))
    counts = {r["item"]: r["count"] for r in found["top"] or [] if r["item"] is not None} | {None: found["nulls"]}
    return {k: math.ceil(n / share) for k, n in counts.items() if n > share}


def _salts(key: str, hot: dict, kind) -> Column:
    """Salts of a row's key: 1 unless it is hot."""
    named = [x for k, n in hot.items() if k is not None for x in (F.lit(k).cast(kind), F.lit(n))]
    out = F.coalesce(F.try_element_at(F.create_map(*named), F.col(key)), F.lit(1)) if named else F.lit(1)
    return F.when(F.col(key).isNull(), F.lit(hot.get(None, 1))).otherwise(out)


def salted_left_join(base: DataFrame, per_key: DataFrame, key: str, spread_by: str, salts: int | None = None) -> DataFrame:
    """``base.join(per_key, key, "left")``. ``spread_by``: a base column of many
    values. ``salts`` salts every key so often, without measuring."""
    kind = base.schema[key].dataType
    if salts is None:
        hot = hot_keys(base, key, int(base.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        if not hot:
            return base.join(per_key, key, "left")
        left_salts, right_salts = _salts(key, hot, kind), _salts(key, hot, per_key.schema[key].dataType)
    else:
        left_salts = right_salts = F.lit(salts)
    left = base.withColumn(_SALT, F.pmod(F.xxhash64(spread_by), left_salts).cast("int"))
    right = per_key.withColumn(_SALT, F.explode(F.sequence(F.lit(0), right_salts - 1)))
    return left.join(right, [key, _SALT], "left").drop(_SALT)
