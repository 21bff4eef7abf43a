"""Facts stored along a space-filling curve: statistics of the files."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.clustering import CELLS, boundaries, cell, clustered, interleave

COLUMNS = ("day", "customer")


def _facts(spark, n=60_000, hot=0.0):
    customer = F.when(F.rand(3) < hot, F.lit("C-000")).otherwise(F.format_string("C-%03d", (F.rand(5) * 500).cast("int")))
    return spark.range(n).select(F.format_string("F-%06d", "id").alias("id"), customer.alias("customer"),
                                 F.date_add(F.lit("2026-01-01").cast("date"), (F.rand(9) * 365).cast("int")).alias("day"))


def _file_ranges(path, column):
    out = []
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        out.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    return out


@pytest.mark.parametrize("hot", [0.0, 0.34])
def test_queries_by_either_column_skip_most_files(spark, scratch, hot):
    facts = _facts(spark, hot=hot)
    path = f"{scratch}/facts"
    clustered(facts, COLUMNS, "id", 64).write.parquet(path)
    stored = spark.read.parquet(path)
    assert stored.columns == facts.columns and stored.exceptAll(facts).count() == 0 and stored.count() == 60_000
    for column, values in (("customer", [f"C-{i:03d}" for i in range(1, 500, 50)]),
                           ("day", [r.day for r in facts.select("day").distinct().orderBy("day").collect()[::40]])):
        ranges = _file_ranges(path, column)
        assert len(ranges) >= 48
        read = [sum(low <= v <= high for low, high, _ in ranges) for v in values]
        assert sum(read) / len(read) <= len(ranges) / 3, (column, read, len(ranges))
    sizes = sorted(n for _, _, n in _file_ranges(path, "id"))
    assert sizes[-1] < 3 * 60_000 / len(sizes)         # a hot customer fills many files


def test_boundaries_and_cells(spark):
    facts = _facts(spark, 5000, hot=0.34)
    bounds = boundaries(facts, COLUMNS, sample_rows=1000)
    assert all(len(b) < CELLS and b == sorted(set(b)) for b in bounds.values())
    got = facts.select(cell(F.col("customer"), bounds["customer"]).alias("c"), "customer").collect()
    assert all(r.c == sum(b < r.customer for b in bounds["customer"]) for r in got)
    pairs = [(a, b) for a in (0, 1, 5, 63) for b in (0, 2, 62, 63)]
    want = [int("".join(x + y for x, y in zip(f"{a:06b}", f"{b:06b}")), 2) for a, b in pairs]
    assert [r[0] for r in spark.createDataFrame(pairs, "a int, b int").coalesce(1)
            .select(interleave(F.col("a"), F.col("b"))).collect()] == want


def test_null_values_and_an_empty_table(spark):
    rows = [("a", None, None), ("b", "x", None), ("b", "x", None), ("c", None, None)]
    df = spark.createDataFrame(rows, "id string, customer string, day date")
    assert sorted(map(tuple, clustered(df, COLUMNS, "id", 4).collect()), key=str) == sorted(rows, key=str)
    assert clustered(df.where("false"), COLUMNS, "id").count() == 0
