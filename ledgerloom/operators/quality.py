"""Data-quality operators: each check counts its failing rows (0 = pass).

Semantics of the declared test types:

* ``not_null``            rows where the column is NULL
* ``unique``              non-NULL values occurring more than once (one failure per value)
* ``accepted_values``     distinct non-NULL values outside the list (one failure per value)
* ``relationships``       non-NULL child rows whose key is missing in the parent
* ``expression_is_true``  rows where ``column <expr>`` is false (NULL passes)

Plan shape. Checks are numbered; only the numbers travel. A relation is read
once for the counts of its ``not_null`` and ``expression_is_true`` checks, once
for its keys in relationships and its values outside accepted lists, and a
column of it for each other ``unique`` check. The keys of all relationships
share one shuffle, in which a key has one row a map task with its count in each
column: partial (map-side) aggregation first, so a hot key stays one row. Other
unique keys are shuffled as hashes, once for each stored column; only keys of
repeated hashes follow as text.
Every check starts from a zero row, so no catalog table is joined; names are put
on the one row a check at the end.
"""

from __future__ import annotations

from dataclasses import replace
from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.checks import Check, all_checks
from ledgerloom.session import run_dir

RESULT_COLUMNS = ("check_id", "layer", "model", "column_name", "test", "failures")


class DataQualityError(RuntimeError):
    def __init__(self, failed: list[dict]):
        self.failed = failed
        names = ", ".join(f"{r['check_id']}={r['failures']}" for r in failed)
        super().__init__(f"{len(failed)} data test(s) failed: {names}")


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _accepted(col: Column, dtype: T.DataType, values) -> Column:
    if isinstance(dtype, T.BooleanType):
        named = {str(v).lower() for v in values}
        return F.when(col, F.lit("true" in named)).otherwise(F.lit("false" in named))
    return col.isin(*values)


def row_failures(df: DataFrame, checks: list[tuple[int, Check]]) -> DataFrame:
    """(no, failures) of the ``not_null`` and ``expression_is_true`` checks of
    one relation: one aggregate."""
    aggs = []
    for no, c in checks:
        bad = _col(c.column).isNull() if c.test == "not_null" else ~F.expr(f"`{c.column}` {c.arg}")
        aggs.append(F.count_if(bad).alias(f"c{no}"))
    stack = ", ".join(f"{no}, c{no}" for no, _ in checks)
    return df.agg(*aggs).select(F.expr(f"stack({len(checks)}, {stack}) AS (no, failures)"))


PARENTS = 10_000    # key spaces from here on are parents'; below, a list check's own


def _union(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _entry(space: int, slot: int, key: Column) -> Column:
    return F.struct(F.lit(space).alias("space"), F.lit(slot).alias("slot"), key.alias("k"))


def key_rows(df: DataFrame, keys: list[tuple[int, int, str]], listed: list[tuple[int, Check]]) -> DataFrame:
    """(space, slot, k) of one relation, from one read: its key columns, and its
    values outside accepted lists, for which only rows that have one make
    entries. Keys are text, which is injective for string, date and integer keys."""
    entries = F.array(*[_entry(space, slot, _col(c).cast("string")) for space, slot, c in keys]) if keys else None
    if listed:
        bad = [(no, _col(c.column).isNotNull() & ~_accepted(_col(c.column), df.schema[c.column].dataType, c.arg), c.column)
               for no, c in listed]
        some = reduce(lambda x, y: x | y, [b for _, b, _ in bad])
        values = F.array(*[_entry(no, 0, F.when(b, _col(c).cast("string"))) for no, b, c in bad])
        if entries is None:
            df, entries = df.where(some), values
        else:
            entries = F.when(some, F.concat(entries, values)).otherwise(entries)
    return df.select(F.explode(entries).alias("e")).select("e.*").where(F.col("k").isNotNull())


def key_slots(numbered: list[tuple[int, Check]]) -> dict[int, dict[tuple[str, str], int]]:
    """Key space → (model, column) → slot: a space for each parent column, which
    has slot 0 in it; its children have the others."""
    parents = sorted({c.arg for _, c in numbered if c.test == "relationships"})
    slots = {PARENTS + i: {p: 0} for i, p in enumerate(parents)}
    for _, c in numbered:
        if c.test == "relationships":
            own = slots[PARENTS + parents.index(c.arg)]
            own.setdefault((c.model, c.column), len(own))
    return slots


def key_failures(resolve: Callable[[str], DataFrame], numbered: list[tuple[int, Check]],
                 slots: dict[int, dict[tuple[str, str], int]]) -> DataFrame:
    """(no, failures) of all ``accepted_values`` and ``relationships`` checks, and
    of the ``unique`` checks whose column is a parent's or a child's.

    One aggregate counts a key's rows in each column of its space, and every
    check of the space is read off these counts; a value outside a list is a
    failure by itself."""
    keys: dict[str, list[tuple[int, int, str]]] = {}
    for space, columns in slots.items():
        for (model, column), slot in columns.items():
            keys.setdefault(model, []).append((space, slot, column))
    listed: dict[str, list[tuple[int, Check]]] = {}
    failed: dict[int, list[Column]] = {}
    twice = []
    for no, c in numbered:
        if c.test == "accepted_values":
            listed.setdefault(c.model, []).append((no, c))
            continue
        at = (c.model, c.column)
        if c.test == "relationships":
            space = next(s for s, columns in slots.items() if columns.get(c.arg) == 0)
            amount = F.when(F.col("n0") == 0, F.col(f"n{slots[space][at]}"))
        else:
            space = next(s for s, columns in slots.items() if at in columns)
            repeated = F.col(f"n{slots[space][at]}") > 1
            twice.append((F.col("space") == space) & repeated)
            amount = F.when(repeated, F.lit(1).cast("bigint"))
        failed.setdefault(space, []).append(F.struct(F.lit(no).alias("no"), amount.alias("failures")))
    rows = _union([key_rows(resolve(m), keys.get(m, []), listed.get(m, [])) for m in sorted({*keys, *listed})])
    width = max([len(columns) for columns in slots.values()], default=1)
    met = rows.groupBy("space", "k").agg(*[F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width)])
    bad = reduce(lambda x, y: x | y, twice, (F.col("space") < PARENTS) | (F.col("n0") == 0))
    found = F.when(F.col("space") < PARENTS, F.array(F.struct(F.col("space").alias("no"), F.lit(1).cast("bigint").alias("failures"))))
    for space, checks in failed.items():
        found = found.when(F.col("space") == space, F.array(*checks))
    return (met.where(bad).select(F.explode(found).alias("f")).select("f.*").where(F.col("failures").isNotNull())
            .groupBy("no").agg(F.sum("failures").alias("failures")))


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _hashed(resolve: Callable[[str], DataFrame], c: Check) -> DataFrame:
    k = _col(c.column).cast("string")
    return resolve(c.model).select(k.alias("k")).where(F.col("k").isNotNull()).withColumn("h", _hash(F.col("k")))


def repeated_hashes(resolve: Callable[[str], DataFrame], checks: list[tuple[int, Check]]) -> DataFrame:
    """(no, h) of the keys' hashes that are met more than once. A check's number
    is put on after its shuffle, so checks of one stored column under several
    names share one (Spark reuses equal exchanges)."""
    return _union([_hashed(resolve, c).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
                   .select(F.lit(no).alias("no"), "h") for no, c in checks])


def unique_failures(resolve: Callable[[str], DataFrame], checks: list[tuple[int, Check]]) -> DataFrame | None:
    """(no, failures) of ``unique`` checks, None if none fails. Only hashes of the
    keys are shuffled first: a hash met once is of a sound key. The hashes met
    more often are stored, and their keys alone are counted as text, so keys that
    share a hash are told apart."""
    hashes = repeated_hashes(resolve, checks)
    path = run_dir(hashes.sparkSession, "dq")
    hashes.write.parquet(path)
    suspects = hashes.sparkSession.read.schema("no int, h bigint").parquet(path)
    nos = {r.no for r in suspects.select("no").distinct().collect()}       # at most a row a check
    if not nos:
        return None
    keys = _union([_hashed(resolve, c).withColumn("no", F.lit(no)) for no, c in checks if no in nos])
    counted = keys.join(suspects, ["no", "h"], "left_semi").groupBy("no", "k").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1).groupBy("no").agg(F.count(F.lit(1)).alias("failures"))


def at_origin(check: Check, origin: Callable[[str, str], tuple[str, str]]) -> Check:
    """The check with its columns where they are stored."""
    model, column = origin(check.model, check.column)
    return replace(check, model=model, column=column, arg=origin(*check.arg) if check.test == "relationships" else check.arg)


def run_checks(resolve: Callable[[str], DataFrame], checks: Iterable[Check] | None = None,
               origin: Callable[[str, str], tuple[str, str]] | None = None) -> DataFrame:
    """One DataFrame with a row per check (``RESULT_COLUMNS``).

    ``resolve(name)`` returns the relation a check reads (raw table, view or
    materialised mart); ``origin(model, column)`` the stored column that a
    view's column is a copy of, so that checks of its keys count it once.
    """
    numbered = list(enumerate(all_checks() if checks is None else checks))
    by_model: dict[str, list[tuple[int, Check]]] = {}
    for no, c in numbered:
        if c.test in ("not_null", "expression_is_true"):
            by_model.setdefault(c.model, []).append((no, c))
    spark, parts = resolve(numbered[0][1].model).sparkSession, []
    if by_model:        # stored, a row a check: the joins of views stay out of the report's plan
        path = run_dir(spark, "dq")
        _union([row_failures(resolve(model), cs) for model, cs in by_model.items()]).write.parquet(path)
        parts.append(spark.read.schema("no int, failures bigint").parquet(path))
    stored = numbered if origin is None else [(no, at_origin(c, origin)) for no, c in numbered]
    slots = key_slots(stored)
    linked = {at for columns in slots.values() for at in columns}
    alone = [(no, c) for no, c in stored if c.test == "unique" and (c.model, c.column) not in linked]
    keyed = [(no, c) for no, c in stored if c.test in ("unique", "accepted_values", "relationships") and (no, c) not in alone]
    if keyed:
        parts.append(key_failures(resolve, keyed, slots))
    if alone and (repeated := unique_failures(resolve, alone)) is not None:
        parts.append(repeated)
    zeros = spark.range(len(numbered)).select(F.col("id").cast("int").alias("no"), F.lit(0).cast("bigint").alias("failures"))
    total = _union([*parts, zeros]).groupBy("no").agg(F.sum("failures").alias("failures"))

    def name(of) -> Column:
        return F.element_at(F.array(*[F.lit(of(c)) for _, c in numbered]), F.col("no") + 1)

    return total.select(
        name(lambda c: c.check_id).alias("check_id"), name(lambda c: c.layer).alias("layer"),
        name(lambda c: c.model).alias("model"), name(lambda c: c.column).alias("column_name"),
        name(lambda c: c.test).alias("test"), "failures",
        F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail")).alias("status"))


def enforce(report: DataFrame) -> list[dict]:
    """Fail closed: collect the (bounded, one row per check) report and raise
    ``DataQualityError`` if any check failed."""
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["failures"]]
    if failed:
        raise DataQualityError(sorted(failed, key=lambda r: r["check_id"]))
    return rows
