"""Mixing sources to target weights by entropy balancing.

Each source has a word target. Document rates between 0 and ``cap`` are chosen
as close as possible, in relative entropy, to taking every document once,
under the constraint that a source's expected words equal its target. The dual
is convex with one multiplier ``lam`` a source, and its solution tilts a
document's odds exponentially in its relative size x = size / mean size:

    rate = cap / (1 + (cap - 1) * exp(-lam * x))

Newton steps solve it; gradient and curvature of all sources are one grouped
sum over the documents (pre-aggregated by source and size). Rates are then
rounded to whole copies, bucket by bucket, carrying the rounding error in
words from document to document; what is left at a bucket's end is settled by
single copies, so a source's copies come to its target.

Defined results
  null or wordless text     size 0, rate 1, taken 0
  null source               a source of its own, ordered last
  all sizes 0               every target 0, nothing taken
  target at the cap         every document of the source is taken ``cap`` times
  ties, repeated rows       each row is a document of its own; equal rows may
                            get different copies, the same on every run
  very long text            its size is one number; as a stage, a bucket's rows
                            travel with their texts
  empty table               no rows
  extra columns             kept
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)      # by the source's place in code point order, repeating
SHARE = 1.5                    # of all words
CAP = 2.0                      # most copies of a document, and of a source's words
STEPS = 40                     # Newton steps before halving the bracket
BUCKET_DOCS = 4096
MAX_SOURCES = 100_000          # a row a source reaches the driver; more is an error


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_level(words: list[float], weights: list[float], total: float, cap: float) -> list[float]:
    """Targets in proportion to weights that stop at cap * words, the excess
    reshared among the others by weight."""
    left, open_, out = total, list(range(len(words))), [0.0] * len(words)
    open_.sort(key=lambda i: cap * words[i] / weights[i])
    weight = sum(weights)
    for k, i in enumerate(open_):
        if cap * words[i] <= left * weights[i] / weight:
            out[i] = cap * words[i]
            left, weight = left - out[i], weight - weights[i]
        else:
            for j in open_[k:]:
                out[j] = left * weights[j] / weight
            break
    return out


def source_targets(spark: SparkSession, sized: DataFrame, weights: tuple[float, ...] = WEIGHTS,
                   share: float = SHARE, cap: float = CAP) -> list[dict]:
    """One record a source: no, source, words, docs, target."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")) \
        .limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows = sorted(rows, key=lambda r: (r["source"] is None, r["source"] or ""))
    words = [float(r["words"]) for r in rows]
    w = [float(weights[i % len(weights)]) for i in range(len(rows))]
    targets = water_level(words, w, share * sum(words), cap) if sum(words) else [0.0] * len(rows)
    return [{"no": i, "source": r["source"], "words": r["words"], "docs": r["docs"], "target": t}
            for i, (r, t) in enumerate(zip(rows, targets))]


def rate(lam: Column, size: Column, mean: Column, cap: float) -> Column:
    return cap / (1 + (cap - 1) * F.exp(-lam * size / mean))


def solve_dual(hist: DataFrame, sources: list[dict], cap: float = CAP, steps: int = STEPS) -> dict[int, float]:
    """The multiplier of each source's token constraint.

    ``hist`` has no (the source's number), size and n, the documents of that
    size. Newton steps are kept inside the bracket found so far; a source whose
    constraint is not met after ``steps`` of them has its bracket opened and
    halved until it is, or until no double lies between its ends. A target at
    the cap is the limit of an infinite multiplier, a target of 0 of a
    negative one."""
    spark = hist.sparkSession
    by = {s["no"]: s for s in sources}
    lam = {s["no"]: 0.0 if 0 < s["target"] < cap * s["words"] * (1 - 1e-9) else math.inf if s["target"] else -math.inf
           for s in sources}
    low, high = dict.fromkeys(lam, -math.inf), dict.fromkeys(lam, math.inf)
    active = {k for k, v in lam.items() if v == 0.0}
    done = 0
    while active:
        done += 1
        now = spark.createDataFrame([(k, lam[k], by[k]["words"] / by[k]["docs"]) for k in sorted(active)],
                                    "no int, lam double, mean double")
        w, x = rate(F.col("lam"), F.col("size"), F.col("mean"), cap), F.col("size") / F.col("mean")
        sums = hist.join(F.broadcast(now), "no").groupBy("no").agg(      # at most MAX_SOURCES rows
            F.sum(w * F.col("size") * F.col("n")).alias("got"),
            F.sum(w * (1 - w / cap) * x * F.col("size") * F.col("n")).alias("slope")).collect()
        for r in sums:
            k, gap = r["no"], by[r["no"]]["target"] - r["got"]
            if abs(gap) <= 1e-7 * by[k]["target"]:
                active.discard(k)
                continue
            (low if gap > 0 else high)[k] = lam[k]
            step = max(-4.0, min(4.0, gap / r["slope"])) if r["slope"] > 0 else math.copysign(4.0, gap)
            if done > steps:        # twice as far each time while the bracket is open, else to its middle
                step = math.copysign(2.0 ** min(done - steps + 2, 1000), gap) if math.inf in (high[k], -low[k]) else math.inf
            to = lam[k] + step
            to = to if low[k] < to < high[k] else (low[k] + high[k]) / 2
            if to in (low[k], high[k]) or not math.isfinite(to):
                active.discard(k)       # as near as doubles come
            else:
                lam[k] = to
    return lam


def copies_of(sizes: np.ndarray, rates: np.ndarray, order: list[int], cap: float) -> np.ndarray:
    """Whole copies: each rate rounded down or up, documents in ``order`` (the
    largest first) carrying the words over or short to the next one. What is
    left at the end is settled by single copies, again the largest first."""
    out, carry = np.zeros(len(sizes), np.int32), 0.0
    for i in order:
        s, w = float(sizes[i]), float(rates[i])
        down, want = math.floor(w), carry + w * s
        n = down if want - down * s < s / 2 or w == down else down + 1
        out[i], carry = n, want - n * s
    for i in order:
        s = float(sizes[i])
        if s and abs(carry) >= s / 2:
            step = 1 if carry > 0 else -1
            if 0 <= out[i] + step <= cap:
                out[i] += step
                carry -= step * s
    return out


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """``docs`` (with doc_id, source and size, and any other columns) with
    source_size, target, rate and copies."""
    spark = docs.sparkSession
    sized = stored(docs.select("doc_id", "source", "size"), "mix-sizes")
    sources = source_targets(spark, sized, weights, share, cap)
    numbers = spark.createDataFrame([(s["no"], s["source"]) for s in sources], "no int, src string")
    hist = stored(sized.join(F.broadcast(numbers), sized["source"].eqNullSafe(numbers["src"]))
                  .groupBy("no", "size").agg(F.count("*").alias("n")), "mix-hist")
    lam = solve_dual(hist, sources, cap)
    far = 1e9       # stands for an infinite multiplier: the rate is the cap or 0 to the last bit
    facts = spark.createDataFrame(
        [(s["source"], s["no"], s["words"], s["target"], s["words"] / s["docs"] or 1.0,
          max(-far, min(far, lam[s["no"]])), max(1, math.ceil(s["docs"] / BUCKET_DOCS))) for s in sources],
        "src string, no__ int, source_size long, target double, mean__ double, lam__ double, buckets__ int")
    rated = docs.join(F.broadcast(facts), docs["source"].eqNullSafe(facts["src"])) \
        .withColumn("rate", F.when(docs["size"] == 0, F.least(F.lit(1.0), F.lit(cap)))
                    .otherwise(rate(F.col("lam__"), docs["size"], F.col("mean__"), cap))) \
        .withColumn("bucket__", F.pmod(F.xxhash64(docs["doc_id"], docs["size"], F.lit(8)), F.col("buckets__"))) \
        .drop("src", "mean__", "lam__", "buckets__")

    def round_bucket(t: pa.Table) -> pa.Table:
        size, w = t.column("size").to_numpy(), t.column("rate").to_numpy()
        ids = t.column("doc_id").to_pylist()
        order = sorted(range(len(ids)), key=lambda i: (-size[i], ids[i] is not None, 0 if ids[i] is None else ids[i]))
        n = copies_of(size, w, order, cap)
        return t.append_column("copies", pa.array(n, pa.int32()))

    schema = T.StructType([*rated.schema.fields, T.StructField("copies", T.IntegerType())])
    return rated.groupBy("no__", "bucket__").applyInArrow(round_bucket, schema).drop("no__", "bucket__")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("size"))
    return mix(docs).select("doc_id", "size", "source_size", "target",
                            (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")


def take_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as many times as the mix takes it."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner = docs.toDF(*names)
    at = {c: F.col(names[docs.columns.index(c)]) for c in ("doc_id", "source", "text")}
    mixed = mix(inner.select(at["doc_id"].alias("doc_id"), at["source"].alias("source"),
                             n_words(at["text"]).alias("size"), F.struct(*names).alias("row")))
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))) \
        .select("row.*").toDF(*docs.columns)
