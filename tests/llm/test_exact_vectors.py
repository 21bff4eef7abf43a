"""Exact top-k, vector codes and hard negatives against plain versions."""

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op11_va_file as O11
from ledgerloom.llm import op12_gnat_codes as O12
from ledgerloom.llm import op13_segment_negatives as O13
from ledgerloom.llm import vectors as V
from tests.conftest import SF0001

SCHEMA = "vec_id long, embedding array<double>, label int, known string, shard string, copies string, ints string, cells string, slot string"


def vec(*x):
    return [float(v) if v is not None else None for v in x]


def row(i, x, label=0):
    return (i, x, label, "k", "s", "c", "i", "ce", "sl")


def random_rows(n, dim, seed, labels=3, scale=1.0, grid=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) * scale
    if grid:
        x = np.round(x * grid) / grid          # few values: many ties
    return [row(i, vec(*r), int(rng.integers(labels)) if rng.random() > 0.05 else None) for i, r in enumerate(x)]


ODD = [row(900, None), row(901, vec(1, None, 0, 0)), row(902, vec(float("nan"), 0, 0, 0)), row(903, vec(0, float("inf"), 0, 0)),
       row(904, vec(1, 2)), row(905, []), row(920, None, 1)]


def whole(rows, scale, dim):
    """(id, ints, label) of the rows that take part, by plain Python."""
    fine = [r for r in rows if r[1] is not None and len(r[1]) == dim and all(v is not None and math.isfinite(v) for v in r[1])]
    return [(r[0], [max(-2 ** 53, min(2 ** 53, math.floor(scale * v))) for v in r[1]], r[2]) for r in fine]


def dot(a, b):
    return max(-V.LONG, min(V.LONG, sum(x * y for x, y in zip(a, b))))


def plain_top(rows, dim, step, k=O11.K):
    own = [r for r in whole(rows, 64, dim) if r[0] is not None]
    out = []
    for q in sorted({r[0] for r in own if r[0] % step == 0}):
        x = min((r[1] for r in own if r[0] == q))
        best = sorted(((-dot(x, r[1]), r[0]) for r in own if r[0] != q))[:k]
        out += [(q, i + 1, v, -s) for i, (s, v) in enumerate(best)]
    return out


def tuples(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- op11 --------------------------------------------------------------------

@pytest.mark.parametrize("case", ["random", "ties", "wide", "few"])
def test_top_k_equals_a_full_search(spark, case):
    rows = {"random": random_rows(400, 7, 1), "ties": random_rows(300, 4, 2, grid=1), "wide": random_rows(60, 4, 3, scale=1e13),
            "few": random_rows(9, 4, 4)}[case]
    dim = len(rows[0][1])
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert tuples(O11.top_k(df, F.col("vec_id") % 20 == 0), "query_id", "rank") == plain_top(rows, dim, 20)


def test_top_k_edges(spark):
    rows = random_rows(30, 4, 5) + ODD + [row(None, vec(9, 9, 9, 9)), row(40, vec(0, 0, 0, 0)), *[row(41, vec(3, 3, 3, 3))] * 25,
                                          row(60, vec(1, 1, 1, 1)), row(60, vec(1, 1, 1, 1))]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = tuples(O11.top_k(df, F.col("vec_id") % 20 == 0), "query_id", "rank")
    assert got == plain_top(rows, 4, 20)
    assert {r[0] for r in got} == {0, 20, 40, 60}
    assert O11.top_k(df.limit(0), F.col("vec_id") % 20 == 0).columns == ["query_id", "rank", "vec_id", "score"]
    assert O11.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert O11.top_k(df.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_cells_bound_every_score_and_few_vectors_are_read():
    rng = np.random.default_rng(6)
    x = np.floor(64 * rng.standard_normal((8000, 32)) / np.sqrt(32))
    x[:50] *= 40                                        # far outside the sample
    cells = O11.Cells(x[1000:3000], x.min(0), x.max(0))
    assert (cells.numbers(cells.of(x)) < O11.CELLS).all()
    shard = O11.Shard(np.arange(8000), np.ones(8000, np.int64), cells.of(x), x.astype("<i4"), cells)
    q = x[60:90]
    lower, upper = shard.bounds(q)
    score = V.dots(x, q).T
    assert (lower <= score).all() and (score <= upper).all()
    for i in range(len(q)):
        found, s = shard.nearest(60 + i, q[i:i + 1], lower[i], upper[i], -np.inf, 20)
        order = np.lexsort((np.arange(8000), -score[i]))
        order = order[order != 60 + i][:20]
        assert found.tolist() == order.tolist() and s.tolist() == score[i][order].tolist()
    assert shard.read < 0.2 * 8000 * len(q)


# --- op12 --------------------------------------------------------------------

def plain_codes(rows, dim):
    own = sorted(whole(rows, 256, dim), key=lambda r: (r[0] is None, r[0] or 0, np.array(r[1], "<i8").tobytes()))
    w = -(-dim // 16)
    parts = [[(r[1] + [0] * (16 * w - dim))[p * w:(p + 1) * w] for p in range(16)] for r in own]
    books = [[list(x[p]) for x in parts[:64]] for p in range(16)]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p])) for p, v in enumerate(x)] for x in parts]
    for _ in range(2):
        near = assign()
        for p in range(16):
            for i in range(len(books[p])):
                got = [x[p] for x, n in zip(parts, near) if n[p][1] == i]
                if got:
                    books[p][i] = [sum(c) // len(got) for c in zip(*got)]
    near, by = assign(), defaultdict(int)
    error = [min(V.LONG, sum(d for d, _ in n)) for n in near]
    for r, e in zip(own, error):
        by[r[2]] += e
    sha = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{i:02x}" for _, i in n), e, min(V.LONG, by[r[2]]), sha) for r, n, e in zip(own, near, error)]
    return sorted(out, key=lambda t: (t[0] is None, t))


@pytest.mark.parametrize("case", ["random", "ties", "wide", "odd", "few"])
def test_codes_equal_a_full_search(spark, case):
    rows = {"random": random_rows(150, 32, 11), "ties": random_rows(200, 16, 12, grid=1), "wide": random_rows(70, 16, 13, scale=1e13),
            "odd": random_rows(90, 18, 14) + ODD + [row(None, vec(*range(18)), None), *[row(5, vec(*[1] * 18), None)] * 3],
            "few": random_rows(5, 16, 15)}[case]
    dim = len(rows[0][1])
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in O12.compress(df).collect()), key=lambda t: (t[0] is None, t))
    assert got == plain_codes(rows, dim)


def test_codes_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert O12.compress(df).count() == 0 and O12.compress(spark.createDataFrame(ODD[:4], SCHEMA)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_tree_finds_the_lowest_nearest_entry(seed):
    rng = np.random.default_rng(seed)
    reach = [2, 5, 40, 300, 3, 10 ** 9][seed]
    points = rng.integers(-reach, reach + 1, (64, 4)).astype(float)
    points[40:44] = points[3]                           # equal entries: the lowest wins
    x = rng.integers(-reach, reach + 1, (500, 4)).astype(float)
    x[:64] = points
    tree = O12.Gnat(points)
    best, square = tree.nearest(x)
    exact = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, p)) for p in points] for v in x]
    assert best.tolist() == [e.index(min(e)) for e in exact] and [int(s) for s in square] == [min(e) for e in exact]
    if reach >= 40:
        assert tree.compared < 0.8 * 64 * len(x)        # whole children were left out


# --- op13 --------------------------------------------------------------------

def plain_negatives(rows, dim, step):
    own = [r for r in whole(rows, 256, dim) if r[0] is not None and r[2] is not None]
    out = []
    for a in sorted({r[0] for r in own if r[0] % step == 0}):
        label, x = min((r[2], np.array(r[1], "<i8").tobytes(), r[1]) for r in own if r[0] == a)[::2]
        scored = sorted((-dot(x, r[1]), r[0], r[2]) for r in own if r[0] != a)
        for p, pid, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(a, pid, i + 1, s[1], -p, -s[0]) for i, s in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("case", ["random", "ties", "one label", "edges"])
def test_negatives_equal_a_full_search(spark, case):
    rows = {"random": random_rows(300, 12, 21), "ties": random_rows(300, 4, 22, grid=1), "one label": random_rows(60, 8, 23, labels=1),
            "edges": random_rows(120, 4, 24) + ODD + [row(None, vec(9, 9, 9, 9)), *[row(121, vec(1, 1, 1, 1), 1)] * 9,
                                                      *[row(122, vec(.8, .9, 1, 1), 2)] * 5, row(130, vec(2, 2, 2, 2), 1), row(140, vec(0, 0, 0, 0), 1)]}[case]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in O13.mine(df, F.col("vec_id") % 10 == 0).collect())
    assert got == plain_negatives(rows, len(rows[0][1]), 10)
    assert (got == []) == (case == "one label")


def test_negatives_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert O13.mine(df, F.col("vec_id") % 10 == 0).count() == 0
    assert O13.mine(spark.createDataFrame([row(0, vec(1, 2), 1)], SCHEMA), F.col("vec_id") % 10 == 0).count() == 0


def test_segment_summaries_bound_scores_at_every_level():
    rng = np.random.default_rng(31)
    x = np.floor(256 * (rng.standard_normal((600, 37)) + 2))      # a mean, and a last segment that is short
    q = x[:20]
    score = q @ x.T
    last = np.inf
    for width in O13.LEVELS:
        (qm, qd), (xm, xd) = O13.summary(q, width), O13.summary(x, width)
        mid, span = qm @ xm.T, qd @ xd.T + 1e-6
        assert (mid - span <= score + 1e-3).all() and (score <= mid + span + 1e-3).all()
        assert span.mean() < last
        last = span.mean()
    # smooth vectors: the summaries leave few rows to score
    base = np.repeat(rng.standard_normal((4000, 8)), 8, axis=1) + 0.05 * rng.standard_normal((4000, 64))
    y = np.floor(256 * base)
    shard = O13.Segments(np.arange(4000), np.arange(4000) % 2, np.ones(4000, np.int64), y.astype("<i4"))
    list(shard.positives(y[:32:2], np.arange(0, 32, 2), 0, np.full(16, -np.inf), 5))
    assert shard.scored < 0.1 * shard.asked and shard.bounded[-1] <= shard.bounded[0]


def test_score_range():
    for p in range(-7, 200):
        least, most = O13.score_range(p)
        assert [s for s in range(-20, 220) if 50 * p <= 100 * s <= 95 * p] == list(range(least, most + 1))


# --- shared ------------------------------------------------------------------

def test_dots_are_exact_at_every_size():
    rng = np.random.default_rng(41)
    for reach in (100, 2 ** 30, 2 ** 53):
        x, q = rng.integers(-reach, reach + 1, (9, 5)), rng.integers(-reach, reach + 1, (4, 5))
        want = [[dot(map(int, a), list(map(int, b))) for b in q] for a in x]
        assert V.dots(x.astype(float), q.astype(float)).tolist() == want


@pytest.mark.parametrize("name, query", [("op11_va_file", O11.op11_va_file), ("op12_gnat_codes", O12.op12_gnat_codes),
                                         ("op13_segment_negatives", O13.op13_segment_negatives)])
def test_queries_equal_their_sql(spark, name, query):
    from ledgerloom.llm.registry import oracle_sql

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF0001}/embeddings.parquet')")
    want = con.execute(oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, query(spark, SF0001).select(columns).collect())) == sorted(want.fetchall())
