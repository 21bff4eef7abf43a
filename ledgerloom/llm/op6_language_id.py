"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent character n-grams (1 to
3 code points, words padded with a space) in order of frequency. A document's
own profile is compared with each language's by the out-of-place distance:
the sum over its n-grams of the difference in rank, or ``profile_size`` for an
n-gram the language's profile lacks. The nearest language wins.

Defined results
  null or letterless text   lang_pred ``und``, score 0
  very long text            counted whole
  tied n-gram counts        smaller code points rank first
  tied distances            the language smaller by code point wins
  repeated rows             each row is predicted on its own
  no labelled rows          every row is ``und``, score 0
  extra columns             ignored by ``identify``; a caller joins nothing

Learning uses at most ``docs_per_lang`` (expected) documents of each language,
taken by a hash of doc_id; prediction reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import held_out, share_of, small_batches, table

PROFILE_SIZE = 300
DOCS_PER_LANG = 4000
MAX_LANGS = 1000      # more distinct labels than this are not languages: an error

_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters (built once in each Python process)."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, ascending, and how often each occurs.

    A gram is its code points in one integer, 21 bits each."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(_letters()[a], a, np.uint32(32))
    a = np.concatenate(([32], a, [32])).astype(np.uint64)
    space = a == 32
    keep = np.ones(len(a), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    a = a[keep]
    if len(a) < 3:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    two = (a[:-1] << np.uint64(21)) | a[1:]
    three = (two[:-1] << np.uint64(21)) | a[2:]
    grams = np.concatenate((a[a != 32], two, three))
    grams.sort()
    first = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1])))
    return grams[first], np.diff(np.append(first, len(grams)))


def ranked(grams: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent grams, most frequent first."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(docs: DataFrame, profile_size: int = PROFILE_SIZE,
                   docs_per_lang: int = DOCS_PER_LANG) -> dict[str, np.ndarray]:
    """Profiles by language from the documents that are not held out."""
    small_batches(docs.sparkSession)
    train = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()) \
        .select("doc_id", "lang", "text")
    sizes = {r["lang"]: r["n"] for r in
             train.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGS + 1).collect()}
    if len(sizes) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} distinct languages")
    if not sizes:
        return {}
    pairs = [x for lang, n in sorted(sizes.items()) for x in (F.lit(lang), F.lit(min(1.0, docs_per_lang / n)))]
    train = train.where(share_of(F.col("doc_id"), F.create_map(*pairs)[F.col("lang")]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:     # one row for each language and gram of a batch
            by: dict[str, list] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                by.setdefault(lang, []).append(gram_counts(text))
            for lang, found in by.items():
                g = np.concatenate([x[0] for x in found])
                u, at = np.unique(g, return_inverse=True)
                n = np.bincount(at, np.concatenate([x[1] for x in found]), len(u))
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(u), "gram": u.astype(np.int64),
                                                  "n": n.astype(np.int64)})

    totals = train.select("lang", "text").mapInArrow(count, "lang string, gram long, n long") \
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # at most profile_size rows a language reach the driver
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = totals.withColumn("place", F.row_number().over(order)).where(F.col("place") <= profile_size)
    out: dict[str, list[tuple[int, int]]] = {}
    for r in best.collect():
        out.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(x)], np.uint64) for lang, x in out.items()}


def predictor(profiles: dict[str, np.ndarray], profile_size: int = PROFILE_SIZE):
    """The function text -> (language, score)."""
    langs = sorted(profiles)
    vocab = np.unique(np.concatenate([profiles[x] for x in langs])) if langs else np.empty(0, np.uint64)
    place = np.full((len(vocab) + 1, len(langs)), -1, np.int64)     # the last row: a gram of no profile
    for j, lang in enumerate(langs):
        place[np.searchsorted(vocab, profiles[lang]), j] = np.arange(len(profiles[lang]))

    def predict(text: str | None) -> tuple[str, float]:
        grams, counts = gram_counts(text or "")
        if not len(grams) or not langs:
            return "und", 0.0
        top = ranked(grams, counts, profile_size)
        at = np.searchsorted(vocab, top)
        at[at == len(vocab)] = 0
        at = np.where(vocab[at] == top, at, len(vocab))
        p = place[at]
        d = np.where(p < 0, profile_size, np.abs(p - np.arange(len(top))[:, None])).sum(axis=0)
        j = int(np.argmin(d))
        return langs[j], 1.0 - float(d[j]) / (profile_size * len(top))

    return predict


def prediction(text: Column, profiles: dict[str, np.ndarray], profile_size: int = PROFILE_SIZE) -> Column:
    """struct(lang, score) of a text column; score is 1 - distance /
    (profile_size * grams compared)."""
    predict = predictor(profiles, profile_size)

    @F.pandas_udf("lang string, score double")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([predict(t) for t in texts], columns=["lang", "score"])

    return run(text)


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], profile_size: int = PROFILE_SIZE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", held_out().alias("held_out"), prediction(F.col("text"), profiles, profile_size).alias("p")) \
        .select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn_profiles(docs))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without an identifiable language go. One
    pass, no join (doc_id may repeat)."""
    small_batches(spark)
    lang = prediction(F.col("text"), learn_profiles(docs))["lang"]
    return docs.where(lang != "und")
