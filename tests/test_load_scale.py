"""What loads and stored facts compute a record."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import clustering as C
from ledgerloom.sources import ledger


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 16, 63])
def test_a_cell_is_found_in_two_steps(spark, n):
    assert C.GROUP ** 2 >= C.CELLS
    bounds = [3 * i for i in range(n)]
    values = spark.createDataFrame([(v,) for v in [None, *range(-2, 3 * n + 3)]], "v int")
    for r in values.select("v", C.cell(F.col("v"), bounds).alias("c")).collect():
        assert r.c == (0 if r.v is None else sum(b < r.v for b in bounds)), r


def test_digest_is_worked_out_a_file(spark):
    records = [("file:/l/external/payments/d=1/a%20b+c.csv", v) for v in (5, -7, 2**63 - 1, -2**63, -1)] + \
              [("file:/l/external/payments/d=1/two.csv", v) for v in (2**63 - 1, 2**63 - 1, 12)]
    got = {r["_file"]: (r["rows"], r.digest) for r in ledger._seen(spark.createDataFrame(records, "_file string, _record long")).collect()}
    want = {}
    for path, name in ((records[0][0], "external/payments/d=1/a b+c.csv"), (records[-1][0], "external/payments/d=1/two.csv")):
        own = [v for p, v in records if p == path]
        xor = 0
        for v in own:
            xor ^= v % 2**64
        want[name] = (len(own), f"{xor:X}-{sum(own)}")
    assert got == want


def test_a_record_keeps_its_path_as_it_is(spark, scratch):
    path = os.path.join(scratch, "external/payments/a b.csv")
    os.makedirs(os.path.dirname(path))
    with open(path, "w") as f:
        f.write("payment_id\nP,A,S,2026-01-02,1.00,USD,Failed,ACH\n")
    records = ledger.Loader(spark, None)._records("payments", [path], False)
    assert records.select("_file").first()[0].endswith("external/payments/a%20b.csv")
    assert "regexp_extract" not in records._jdf.queryExecution().toString()
