"""Property tests for the hand-built column helpers and the salted join."""

import decimal
import json

from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.functions.variant import exact_ratio, v_int
from ledgerloom.operators.joins import salted_left_join

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _half_up(x: decimal.Decimal, digits: int) -> decimal.Decimal:
    return x.quantize(decimal.Decimal(1).scaleb(-digits), rounding=decimal.ROUND_HALF_UP)


@SETTINGS
@given(st.lists(st.decimals(min_value=-10**9, max_value=10**9, places=3, allow_nan=False,
                            allow_infinity=False), min_size=1, max_size=40),
       st.booleans())
def test_variant_integer_cast_rounds_half_away_from_zero(spark, values, as_text):
    lines = [json.dumps({"i": idx, "x": str(v) if as_text else float(v)}) for idx, v in enumerate(values)]
    df = spark.createDataFrame([(l,) for l in lines], "j string").select(F.parse_json("j").alias("v"))
    got = {r.i: r.x for r in df.select(v_int(F.col("v"), "i").alias("i"), v_int(F.col("v"), "x").alias("x")).collect()}
    for idx, v in enumerate(values):
        src = decimal.Decimal(str(v)) if as_text else decimal.Decimal(repr(float(v)))
        assert got[idx] == int(_half_up(src, 0)), (v, got[idx])


@SETTINGS
@given(st.lists(st.tuples(st.integers(min_value=0, max_value=10**12),
                          st.one_of(st.none(), st.integers(min_value=0, max_value=10**6))),
                min_size=1, max_size=40))
def test_exact_ratio_is_half_up_at_six_digits(spark, pairs):
    df = spark.createDataFrame([(i, n, d) for i, (n, d) in enumerate(pairs)], "i long, n long, d long")
    got = {r.i: r.q for r in df.select("i", exact_ratio(F.col("n"), F.col("d")).alias("q")).collect()}
    for i, (n, d) in enumerate(pairs):
        want = None if not d else _half_up(decimal.Decimal(n) / decimal.Decimal(d), 6)
        assert got[i] == want, (n, d, got[i], want)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["hot"] * 6 + list("abcdefgh"))), min_size=1, max_size=80),
       st.lists(st.sampled_from(list("abcdefgxyz") + ["hot"]), unique=True, max_size=11),
       st.sampled_from([1, 3, 8]))
def test_salted_join_equals_left_join(spark, base_keys, side_keys, salts):
    base = spark.createDataFrame([(k, i) for i, k in enumerate(base_keys)], "k string, v int")
    side = spark.createDataFrame([(k, j) for j, k in enumerate(side_keys)], "k string, w int")
    got = salted_left_join(base, side, "k", spread_by="v", salts=salts)
    want = base.join(side, "k", "left")
    assert sorted(map(tuple, got.select("k", "v", "w").collect()), key=lambda t: t[1]) == \
        sorted(map(tuple, want.select("k", "v", "w").collect()), key=lambda t: t[1])
