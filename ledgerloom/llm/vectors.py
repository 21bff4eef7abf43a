"""Integer vectors for the exact vector operators: which rows take part, their
packed form, exact inner products, and shards of rows that meet a stream of
queries.

A component becomes floor(scale * component), a whole number held as a double;
beyond a double's exact whole numbers (2 ** 53) it is held to that limit. Rows
take part if the vector is neither null nor holds a null or non-finite
component and has the table's most frequent number of components (of equally
frequent ones the smallest).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HELD = 2.0 ** 53
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Shape:
    """What the rows that take part have in common."""
    rows: int
    dim: int
    kind: str           # numpy type that holds every whole component


def finite(vectors: DataFrame, *others: str) -> DataFrame:
    """vec_id (long), ``others`` and embedding (doubles) of rows whose vector is whole."""
    e = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), *others, e.alias("embedding")) \
        .where(F.col("embedding").isNotNull()) \
        .where(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def shape_of(rows: DataFrame, scale: int) -> Shape:
    """One aggregate over the table; a row for each number of components."""
    most = F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x))))
    found = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("rows"), most.alias("most")) \
        .orderBy(F.desc("rows"), "dim").first()
    if found is None:
        return Shape(0, 0, "<i1")
    top = (found["most"] or 0.0) * scale + 1
    kind = next((k for k, limit in (("<i1", 127), ("<i2", 32767), ("<i4", 2 ** 31 - 1)) if top <= limit), "<f8")
    return Shape(found["rows"], found["dim"], kind)


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column of equally long lists, a row each."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * x), -HELD, HELD)


def binary(x: np.ndarray) -> pa.Array:
    """A binary column: the bytes of each row of ``x``."""
    raw = np.ascontiguousarray(x)
    width = raw.dtype.itemsize * raw.shape[1]
    offsets = np.arange(len(raw) + 1, dtype=np.int64) * width
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(raw), [None, pa.py_buffer(offsets), pa.py_buffer(raw)]).cast(pa.binary())


def unpacked(column: pa.Array | pa.ChunkedArray, kind: str, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dim)


def packed(rows: DataFrame, shape: Shape, scale: int) -> DataFrame:
    """``rows`` with the bytes of the whole components in place of the vector."""
    names = [c for c in rows.columns if c != "embedding"]
    kind, dim = shape.kind, shape.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = matrix(b.column("embedding")).reshape(b.num_rows, dim)
                columns = [b.column(c) for c in names] + [binary(whole(x, scale).astype(kind))]
                yield pa.RecordBatch.from_arrays(columns, [*names, "ints"])

    kept = rows.where(F.size("embedding") == dim)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "embedding")
    return kept.mapInArrow(run, f"{schema}, ints binary")


def collapsed(rows: DataFrame) -> DataFrame:
    """Equal rows as one with its number of ``copies`` (pre-aggregated, so a
    row repeated any number of times is one row for each map task)."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def dots(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``x`` with the rows of ``q``: by
    doubles where no sum passes 2 ** 53, else by whole numbers of any size, then
    held to a long."""
    if not x.size or not q.size:
        return np.zeros((len(x), len(q)), np.int64)
    top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1]
    if top < HELD:
        return (x.astype(np.float64) @ q.astype(np.float64).T).astype(np.int64)
    big = np.vectorize(int, otypes=[object])
    return np.clip(big(x) @ big(q).T, -LONG, LONG).astype(np.int64)


def shard_of(shards: int, *columns: str) -> Column:
    """A shard by content: rows of a frequent id spread if their vectors differ."""
    return F.pmod(F.xxhash64(*columns), F.lit(shards)).cast("int")


def meet(rows: DataFrame, queries: DataFrame, shards: int, load: Callable[[pa.Table], object],
         answer: Callable[[object, pa.Table], Iterable[pa.Table]], schema: str, block: int,
         order: tuple[str, ...] = ()) -> DataFrame:
    """Each shard of ``rows`` (column ``shard``) meets all ``queries``.

    ``rows`` and ``queries`` have the same columns but for ``shard``. Rows are
    shuffled once, queries once a shard. A task holds one shard, loaded by
    ``load``, and streams the queries past it in
    the order of the columns ``order``, ``block`` at a time, so its memory is
    bounded by a shard, whatever the number of queries.
    """
    columns = [c for c in rows.columns if c != "shard"]
    left = rows.select("shard", F.lit(False).alias("is_query"), *columns)
    right = queries.select(F.explode(F.expr(f"sequence(0, {shards - 1})")).alias("shard"), F.lit(True).alias("is_query"), *columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, index = None, [], None
        for b in batches:
            if not b.num_rows:
                continue
            shard = b.column("shard").to_numpy()
            query = b.column("is_query").to_numpy(zero_copy_only=False)
            turn = np.flatnonzero((np.diff(shard) != 0) | (np.diff(query.astype(np.int8)) != 0)) + 1
            for a, z in zip([0, *turn.tolist()], [*turn.tolist(), len(shard)]):
                if shard[a] != now:
                    now, waiting, index = shard[a], [], None
                part = pa.Table.from_batches([b.slice(a, z - a)])
                if not query[a]:
                    waiting.append(part)
                    continue
                if index is None:
                    if not waiting:
                        continue                        # a shard without rows
                    index, waiting = load(pa.concat_tables(waiting)), waiting[:1]
                for at in range(0, part.num_rows, block):
                    found = list(answer(index, part.slice(at, block)))
                    if found:
                        yield from pa.concat_tables(found).combine_chunks().to_batches()

    return left.unionByName(right).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "is_query", *order).mapInArrow(run, schema)
