"""Quality classification by nearest-neighbour voting in a latent-semantic space.

Terms of a text are its byte bigrams and a few shape terms (binned shares of
repeated words, symbols, capitals and so on). Term weights (1 + log tf) * idf
are projected on the leading singular vectors of the labelled sample's
term-document matrix. The labelled vectors are broadcast; every document's
cosine with all of them is computed exactly, a block of documents at a time,
and its ``NEIGHBOURS`` nearest labelled texts vote for label 1 with weight
cosine ** ``POWER``.

Classifier bound: at most about ``PER_CLASS`` labelled rows of each class,
taken by a hash of doc_id from the rows that are not held out, so neither the
fit nor the broadcast grows with the input. Both classes get the same number
of votes to cast wherever both have that many rows.

Defined results
  null or empty text      no terms but the shape terms of an empty text; scored like any other
  very long text          read whole
  tied cosines            the labelled row with the smaller doc_id votes first
  repeated rows           each row is scored on its own
  repeated labels         a doc_id with several label rows counts once, with the larger label
  null quality            not learned from
  no labelled rows        score 0.5
  one class only          score 0 or 1, that class
  empty table             no rows
  extra columns           ignored
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, share_of, small_batches, table

PER_CLASS = 2048
DIMENSIONS = 48
NEIGHBOURS = 15
POWER = 8
THRESHOLD = 0.3
SHAPE_WEIGHT = 6.0
BIGRAMS = 1 << 16
# Upper bin edges of each shape term's share.
SHAPES = {
    "adjacent_repeats": (0.005, 0.02, 0.1, 0.3), "distinct_words": (0.05, 0.2, 0.4, 0.6, 0.8),
    "symbols": (0.002, 0.01, 0.05, 0.1), "capitals": (0.02, 0.06, 0.2, 0.5), "digits": (0.01, 0.05, 0.2),
    "marks": (0.005, 0.02, 0.05, 0.1), "bars": (0.002, 0.01, 0.05), "repeated_lines": (0.001, 0.1, 0.3, 0.6),
    "word_bytes": (2.5, 4.0, 6.0, 9.0, 14.0), "words_log2": (3.0, 5.0, 7.0, 9.0, 11.0),
}
_START = np.cumsum([0, *(len(v) + 1 for v in SHAPES.values())])
TERMS = BIGRAMS + int(_START[-1])
_CLASSES = {"symbols": "#*$%&<>~^=@\\{}[]_+", "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": "0123456789",
            "marks": "!?", "bars": "|"}
_CLASS = np.array([[chr(c) in chars for chars in _CLASSES.values()] for c in range(256)], np.int64)


def terms(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Term numbers, ascending, and their weights before idf."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    pairs = (raw[:-1].astype(np.uint16) << 8) | raw[1:]
    pairs.sort()
    first = np.flatnonzero(np.concatenate(([len(pairs) > 0], pairs[1:] != pairs[:-1])))
    at, count = pairs[first], np.diff(np.append(first, len(pairs)))
    n = max(1, len(raw))
    by_class = np.bincount(raw, minlength=256) @ _CLASS
    words = (text or "").split()
    lines = [x for x in (text or "").split("\n") if x]
    w = max(1, len(words))
    share = {name: float(x) / n for name, x in zip(_CLASSES, by_class)} | {
        "adjacent_repeats": sum(map(eq, words, words[1:])) / w, "distinct_words": len(set(words)) / w,
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)), "word_bytes": n / w,
        "words_log2": float(np.log2(w))}
    shape = [BIGRAMS + int(_START[j]) + int(np.searchsorted(edges, share[name]))
             for j, (name, edges) in enumerate(SHAPES.items())]
    return (np.concatenate((at, shape)).astype(np.int32),
            np.concatenate((1 + np.log(count), np.full(len(shape), SHAPE_WEIGHT))).astype(np.float32))


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


class Model:
    """Projection (terms x dimensions), labelled unit vectors and labels."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, dimensions: int = DIMENSIONS):
        self.labels = labels.astype(np.float64)
        df = np.zeros(TERMS, np.int64)
        for at, _ in rows:
            df[at] += 1
        used = np.flatnonzero(df)
        place = np.zeros(TERMS, np.int64)
        place[used] = np.arange(len(used))
        idf = np.log((1 + len(rows)) / (1 + df)).astype(np.float32) + 1
        x = np.zeros((len(rows), max(1, len(used))), np.float32)
        for i, (at, w) in enumerate(rows):
            x[i, place[at]] = w * idf[at]
        x = unit(x)
        k = min(dimensions, *x.shape) if rows else 1
        # leading right singular vectors by subspace iteration
        q = np.random.default_rng(1).standard_normal((x.shape[1], min(k + 16, x.shape[1]))).astype(np.float32)
        for _ in range(6):
            q, _ = np.linalg.qr(x.T @ (x @ q))
        _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
        v = q @ vt[:k].T
        self.used, self.weights = used, (v * idf[used][:, None] if len(used) else v).astype(np.float32)
        self.vectors = unit(x @ v).astype(np.float32)

    def projection(self) -> np.ndarray:
        p = np.zeros((TERMS, self.weights.shape[1]), np.float32)
        p[self.used] = self.weights[: len(self.used)]
        return p

    def score(self, vectors: np.ndarray) -> np.ndarray:
        """Vote of the nearest labelled vectors, a block of documents at once."""
        if not len(self.labels):
            return np.full(len(vectors), 0.5)
        cos = unit(vectors) @ self.vectors.T
        k = min(NEIGHBOURS, cos.shape[1])
        kth = np.partition(cos, cos.shape[1] - k, axis=1)[:, cos.shape[1] - k]
        out = np.empty(len(vectors))
        for i, row in enumerate(cos):
            near = np.flatnonzero(row >= kth[i])        # all ties of the last place
            near = near[np.argsort(-row[near], kind="stable")[:k]]
            w = np.maximum(row[near], 0).astype(np.float64) ** POWER
            y = self.labels[near]
            out[i] = (w @ y) / w.sum() if w.sum() > 0 else y.mean()
        return np.clip(out, 0.0, 1.0)


def learn(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on the bounded labelled sample; its term vectors reach the driver."""
    small_batches(docs.sparkSession)
    known = labels.where(~held_out() & F.col("quality").isNotNull()) \
        .groupBy("doc_id").agg(F.max("quality").cast("int").alias("y__")).where("y__ in (0, 1)")
    sizes = {r["y__"]: r["n"] for r in known.groupBy("y__").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], np.empty(0))
    part = F.create_map(*[x for y, n in sorted(sizes.items()) for x in (F.lit(y), F.lit(min(1.0, per_class / n)))])
    sample = known.where(share_of(F.col("doc_id"), part[F.col("y__")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [terms(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y__"), pa.array([g[0] for g in got], pa.list_(pa.int32())),
                 pa.array([g[1] for g in got], pa.list_(pa.float32()))], ["doc_id", "y__", "at", "w"])

    # the sample is about 2 * per_class ids: broadcast
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "y__", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    got = chosen.mapInArrow(run, f"doc_id {kind}, y__ int, at array<int>, w array<float>").toArrow()
    rows = sorted(zip(got["doc_id"].to_pylist(), got["y__"].to_pylist(), got["at"], got["w"]), key=lambda r: r[:2])
    return Model([(r[2].values.to_numpy(), r[3].values.to_numpy()) for r in rows], np.array([r[1] for r in rows]))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(model)       # bounded by the sample, see learn()
    cache: list[np.ndarray] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        if not cache:
            cache.append(m.projection())
        p = cache[0]
        for b in batches:
            texts = b.column("text").to_pylist()
            v = np.zeros((len(texts), p.shape[1]), np.float32)
            for i, t in enumerate(texts):
                at, w = terms(t)
                v[i] = w @ p[at]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(m.score(v))],
                                             ["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text") \
        .mapInArrow(run, f"doc_id {kind}, held_out boolean, score double") \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classify(docs, learn(docs, table(spark, sf_dir, "labels")))
