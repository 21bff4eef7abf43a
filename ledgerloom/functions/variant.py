"""Column helpers for semi-structured and decimal values (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _path(key: str) -> str:
    return f"$.{key}"


def v_str(v: Column, key: str) -> Column:
    """``v:key::VARCHAR`` — missing key or JSON null → NULL."""
    return F.variant_get(v, _path(key), "string")


def v_ts(v: Column, key: str) -> Column:
    """``v:key::TIMESTAMP`` (NTZ; both ``T`` and space separators parse)."""
    return F.variant_get(v, _path(key), "timestamp_ntz")


def v_int(v: Column, key: str) -> Column:
    """``v:key::INTEGER``: numbers and numeric strings round half away from zero.

    A direct ``bigint`` target truncates (1.6 → 1); going through a wide decimal
    and ``round`` gives 2. Non-numeric text raises, like a failing cast.
    """
    return F.round(F.variant_get(v, _path(key), "decimal(38,9)"), 0).cast("bigint")


def v_dec(v: Column, key: str, precision: int, scale: int) -> Column:
    """``v:key::NUMBER(p,s)``."""
    return F.variant_get(v, _path(key), f"decimal({precision},{scale})")


def exact_ratio(num: Column, den: Column, scale: int = 6) -> Column:
    """Integer ÷ integer as an exact decimal rounded half-up to ``scale`` digits.

    ``bigint / bigint`` would be a double; casting both sides to
    ``decimal(38,0)`` gives Spark's exact decimal division (scale 6). NULL when
    ``den`` is NULL or 0.
    """
    q = num.cast("decimal(38,0)") / F.nullif(den, F.lit(0)).cast("decimal(38,0)")
    return q if scale == 6 else F.round(q, scale)


def month_start(ts: Column) -> Column:
    """``DATE_TRUNC('month', ts)`` kept as TIMESTAMP_NTZ (time-zone free)."""
    return F.trunc(ts.cast("date"), "month").cast("timestamp_ntz")


def utc_now() -> Column:
    """The current instant as TIMESTAMP_NTZ in UTC, whatever the session's time zone."""
    return F.expr("convert_timezone(current_timezone(), 'UTC', cast(current_timestamp() AS timestamp_ntz))")


def avg_exact(c: Column) -> Column:
    """Average with every digit of a wide decimal, not rounded to a display
    scale: ``avg(decimal(3,1))`` alone would carry 5 fractional digits. The
    type leaves 20 integer digits, enough for any bigint or declared column."""
    return F.avg(c.cast("decimal(28,8)"))
