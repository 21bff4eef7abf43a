"""Repeated passages by sharded suffix arrays.

Every byte covered by a ``WINDOW``-byte string that also starts anywhere else
is removed. Equal strings must meet in one shard without bringing the corpus
together. So each window is filed under its minimizer: of the hashes of its
``GRAM``-byte strings the smallest one, the leftmost of equals, which depends
on the window's content alone. Neighbouring windows mostly share it; such a
run of windows, its text a segment, is the unit that moves:

  1. one pass over the texts counts minimizers, a second lists the segments
     (minimizer, digest of the text, document, place) of those that occur twice
  2. equal segments are counted and go on as one; only these fetch their text
  3. shards by minimizer sort their segments' suffixes by induction and compute
     permuted common prefixes (see ``suffix_array``); a window with a common
     prefix of WINDOW or more with its neighbour in the array, or in a segment
     that occurs twice, is repeated
  4. the repeated windows go back to all places of their segment, are joined
     into runs and cut from the documents

A minimizer with more than ``HOT_SEGMENTS`` distinct segments is dealt to as
many sub-shards as it needs, by digest; each finds its own repeats and returns
one digest for each distinct window, and a grouped count of those finds what
repeats across sub-shards. So no shard grows with the table.

Defined results
  null or empty text        no bytes, nothing removed
  text below WINDOW bytes   nothing removed
  very long text            read whole; matches never cross documents
  overlapping copies        count, also within a document
  repeated rows             each repeats the other, all of WINDOW bytes or more goes
  null doc_id               a document like any other
  empty table               no rows
  extra columns             ignored by the query, kept by the stage
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import blocks_for, small_batches, stored, table
from ledgerloom.llm.suffix_array import permuted_lcp, suffix_array

WINDOW = 200
GRAM = 32
SHARD_BYTES = 3 << 19           # segment text of a shard
HOT_SEGMENTS = 8192             # more distinct segments of one minimizer are split
CHUNK = 1 << 18                 # windows looked at in one go
_PLACE_BITS = 20
_BASE = 0x9E3779B97F4A7C15 | 1


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POW = _powers(CHUNK + 2 * WINDOW, _BASE)
_INV = _powers(CHUNK + 2 * WINDOW, pow(_BASE, -1, 1 << 64))


def gram_hashes(raw: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of every ``gram``-byte string of a chunk."""
    n = len(raw) - gram + 1
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _POW[:len(raw)], dtype=np.uint64)))
    h = (total[gram:] - total[:-gram]) * _INV[:n]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima of blocks from
    both ends, one value of each a window."""
    n = len(x) - width + 1
    pad = np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)
    blocks = np.concatenate((x, pad)).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def segments(raw: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimizer) of each run of windows
    that share their minimizer's place."""
    width, out = window - gram + 1, []
    for at in range(0, len(raw) - window + 1, CHUNK):
        part = raw[at:at + CHUNK + window - 1]
        h = gram_hashes(part, gram)
        key = (h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | np.arange(len(h), dtype=np.uint64)
        place = (sliding_min(key, width) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        out.append((first + at, np.diff(np.append(first, len(place))), h[place[first]].view(np.int64)))
    if not out:
        e = np.empty(0, np.int64)
        return e, e, e
    return tuple(np.concatenate(x) for x in zip(*out))


def keyed(docs: DataFrame) -> DataFrame:
    """``text`` (null: empty) and a key of two longs. Rows of equal key have
    equal id and text, so whatever holds for one holds for the other."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumns({"text": text, "k1": F.xxhash64(F.col("doc_id").cast("string"), F.col("doc_id").isNull(), F.lit(1)),
                             "k2": F.xxhash64(text, F.col("doc_id").cast("string"))})


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


def list_segments(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """k1, k2, at, n, h (minimizer), d (digest of the text) of every segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for b in batches:
            found, digests = [], []
            for text in b.column("text").to_pylist():
                raw = _bytes(text)
                at, n, h = segments(raw, window, gram)
                whole = raw.tobytes()
                digests += [digest(whole[a:e]) for a, e in zip(at.tolist(), (at + n + window - 1).tolist())]
                found.append((at, n, h))
            if not found:
                continue
            at, n, h = map(np.concatenate, zip(*found))
            sizes = [len(x[0]) for x in found]
            k1, k2 = (np.repeat(b.column(c).to_numpy(), sizes) for c in ("k1", "k2"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (k1, k2, at.astype(np.int32), n.astype(np.int32), h, np.array(digests, np.uint64).view(np.int64))],
                ["k1", "k2", "at", "n", "h", "d"])

    return docs.select("k1", "k2", "text").where(F.octet_length("text") >= window) \
        .mapInArrow(_merged(run), "k1 long, k2 long, at int, n int, h long, d long")


def list_minimizers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """h of every segment: what ``list_segments`` lists, without digests and places."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [segments(_bytes(text), window, gram)[2] for text in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *found]))], ["h"])

    return docs.select("text").where(F.octet_length("text") >= window).mapInArrow(run, "h long")


def _merged(run):
    """``run`` with its many small batches put together."""
    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, rows = [], 0
        for b in run(batches):
            waiting.append(b)
            rows += b.num_rows
            if rows >= 20_000:
                yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
                waiting, rows = [], 0
        if waiting:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
    return out


def fetch_text(distinct: DataFrame, docs: DataFrame, window: int) -> DataFrame:
    """h, d, n, copies, subs, piece (the text) of the distinct segments, each
    from one document that has it (from each of its rows, if they repeat)."""
    wanted = distinct.groupBy("k1", "k2").agg(F.collect_list(F.struct("at", "n", "h", "d", "copies", "subs")).alias("wanted"))
    once = docs.select("k1", "k2", "text").join(wanted, ["k1", "k2"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k1, text, wanted in zip(b.column("k1"), b.column("text").to_pylist(), b.column("wanted").to_pylist()):
                whole = text.encode("utf-8", "surrogatepass")
                yield pa.RecordBatch.from_pydict(
                    {**{c: [w[c] for w in wanted] for c in ("h", "d", "n", "copies", "subs")},
                     "piece": [whole[w["at"]:w["at"] + w["n"] + window - 1] for w in wanted]}, schema=schema)

    schema = pa.schema([("h", pa.int64()), ("d", pa.int64()), ("n", pa.int32()), ("copies", pa.int64()),
                        ("subs", pa.int64()), ("piece", pa.binary())])
    return once.mapInArrow(_merged(run), "h long, d long, n int, copies long, subs long, piece binary")


def repeats_in_shard(pieces: list[bytes], n_windows: np.ndarray, copies: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Of one shard's segments: for every window, in order of the segments,
    whether it is repeated, its segment, its place there, and whether it comes
    first among its equals."""
    sizes = np.array([len(p) + 1 for p in pieces])
    text = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8).astype(np.int16) + 1
    start = np.cumsum(sizes) - sizes
    text[start[1:] - 1] = 0         # between segments, below every byte
    text[-1] = 0
    order = suffix_array(text)
    before, lcp = permuted_lcp(text, order)
    long_ = lcp >= window
    again = long_.copy()
    again[before[long_]] = True
    segment = np.repeat(np.arange(len(pieces)), n_windows)
    place = np.arange(len(segment)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    at = start[segment] + place
    return again[at] | (copies[segment] > 1), segment, place, ~long_[at]


def _runs(marked: np.ndarray, segment: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, ...]:
    """(segment, first, last) of each run of marked windows of a segment."""
    i = np.flatnonzero(marked)
    if not len(i):
        return i, i, i
    new = np.concatenate(([True], (np.diff(i) != 1) | (segment[i[1:]] != segment[i[:-1]])))
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(i)) - 1
    return segment[i[first]], place[i[first]], place[i[last]]


def repeated_windows(texts: DataFrame, window: int, shards: int) -> DataFrame:
    """h, d, first, last: runs of repeated windows of each distinct segment."""
    sub = F.pmod(F.col("d"), F.col("subs"))
    dealt = texts.withColumn("shard", F.when(F.col("subs") > 1, -1 - F.pmod(F.xxhash64("h", sub), F.lit(1 << 40)))
                             .otherwise(F.pmod(F.xxhash64("h"), F.lit(shards))))
    schema = pa.schema([("h", pa.int64()), ("d", pa.int64()), ("first", pa.int32()), ("last", pa.int32()),
                        ("w1", pa.int64()), ("w2", pa.int64()), ("repeated", pa.bool_())])

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("h", "ascending"), ("d", "ascending")])
        h, d = t.column("h").to_numpy(), t.column("d").to_numpy()
        t = t.filter(pa.array(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))))
        pieces = t.column("piece").to_pylist()
        h, d, n, copies = (t.column(c).to_numpy() for c in ("h", "d", "n", "copies"))
        again, segment, place, leads = repeats_in_shard(pieces, n, copies, window)
        s, first, last = _runs(again, segment, place)
        empty = np.zeros(len(s), np.int64)
        out = [pa.table([h[s], d[s], first.astype(np.int32), last.astype(np.int32), empty, empty, np.ones(len(s), bool)], schema=schema)]
        if t.column("shard")[0].as_py() < 0:        # part of a hot minimizer: a digest for each distinct window
            i = np.flatnonzero(leads)
            digests = [xxhash.xxh3_128_intdigest(pieces[s][p:p + window]) for s, p in zip(segment[i].tolist(), place[i].tolist())]
            w1 = np.array([x >> 64 for x in digests], np.uint64).view(np.int64)
            w2 = np.array([x & (1 << 64) - 1 for x in digests], np.uint64).view(np.int64)
            p = place[i].astype(np.int32)
            out.append(pa.table([h[segment[i]], d[segment[i]], p, p, w1, w2, again[i]], schema=schema))
        return pa.concat_tables(out)

    spark = texts.sparkSession
    found = stored(dealt.groupBy("shard").applyInArrow(
        run, "h long, d long, first int, last int, w1 long, w2 long, repeated boolean"), "repeats")
    is_digest = (F.col("w1") != 0) | (F.col("w2") != 0)
    across = found.where(is_digest)
    twice = across.groupBy("h", "w1", "w2").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    more = across.where(~F.col("repeated")).join(twice, ["h", "w1", "w2"], "left_semi")
    cols = ["h", "d", "first", "last"]
    return found.where(~is_digest).select(cols).unionByName(more.select(cols))


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_bytes: int = SHARD_BYTES,
                    hot_segments: int = HOT_SEGMENTS) -> DataFrame:
    """k1, k2, ranges (array of begin, end in bytes) of the documents of
    ``keyed`` rows that hold a repeated window."""
    small_batches(docs.sparkSession)
    counted = list_minimizers(docs, window, gram).groupBy("h").agg(F.count("*").alias("places"))
    # stored, so that both sides of the join are shuffles AQE can split at a hot minimizer
    per_h = stored(counted.where("places > 1").select("h"), "minimizers")
    candidates = stored(list_segments(docs, window, gram).join(per_h, "h", "left_semi"), "segments")
    distinct = candidates.groupBy("h", "d").agg(F.min(F.struct("k1", "k2", "at", "n")).alias("one"), F.count("*").alias("copies"))
    subs = candidates.groupBy("h").agg(F.count_distinct("d").alias("m")) \
        .select("h", F.ceil(F.col("m") / hot_segments).cast("long").alias("subs"))
    distinct = distinct.join(subs, "h").select("h", "d", "one.*", "copies", "subs")
    texts = stored(fetch_text(distinct, docs, window), "pieces")
    size = texts.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    runs = repeated_windows(texts, window, blocks_for(size, shard_bytes))
    ranges = stored(runs.groupBy("h", "d").agg(F.collect_list(F.struct("first", "last")).alias("runs")), "runs")
    covered = candidates.join(ranges, ["h", "d"]).select("k1", "k2", "at", F.explode("runs").alias("r")) \
        .select("k1", "k2", F.struct((F.col("at") + F.col("r.first")).alias("begin"),
                                     (F.col("at") + F.col("r.last") + window).alias("end")).alias("range"))
    return covered.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("range")).alias("ranges"))


def joined(ranges: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the sorted ranges."""
    out: list[list[int]] = []
    for r in ranges or ():
        if out and r["begin"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["begin"], r["end"]])
    return [tuple(x) for x in out]


def kept_bytes(text: str, cut: list[tuple[int, int]]) -> bytes:
    whole, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    for begin, end in cut:
        out.append(whole[at:begin])
        at = end
    return b"".join([*out, whole[at:]])


def with_ranges(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    rows = keyed(docs)
    return rows.join(repeated_ranges(rows.select("k1", "k2", "text"), window, **sizes), ["k1", "k2"], "left")


def remove_repeats(docs: DataFrame, window: int = WINDOW, **sizes) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    found = with_ranges(docs.select("doc_id", "text"), window, **sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, ranges in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist()):
                cut = joined(ranges)
                left = kept_bytes(text, cut)
                removed = sum(e - a for a, e in cut)
                rows.append((len(left) + removed, removed, len(cut), hashlib.sha256(left).hexdigest()))
            cols = list(zip(*rows)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return found.select("doc_id", "text", "ranges").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def kept_text(text: Column, ranges: Column) -> Column:
    """The text without its ranges; a character cut in two at an edge goes."""
    @F.pandas_udf("string")
    def cut(texts, found):
        import pandas as pd
        return pd.Series([t if r is None or not len(r) else kept_bytes(t, joined(list(r))).decode("utf-8", "ignore")
                          for t, r in zip(texts, found)])
    return cut(text, ranges)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document without its repeated bytes (n_chars
    follows); null texts stay null."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    inner, of = docs.toDF(*names), {c: names[docs.columns.index(c)] for c in docs.columns}
    whole = F.struct(*names).alias("row")
    found = with_ranges(inner.select(F.col(of["doc_id"]).alias("doc_id"), F.col(of["text"]).alias("text"), whole))
    text = F.when(F.col(f"row.{of['text']}").isNotNull(), kept_text(F.col("text"), F.col("ranges")))
    out = found.select(text.alias("kept"), "row", "ranges")
    cols = []
    for c, name in zip(docs.columns, names):
        col = F.col(f"row.{name}")
        if c == "text":
            col = F.col("kept")
        elif c == "n_chars":
            col = F.when(F.col("ranges").isNotNull(), F.length("kept").cast(docs.schema[c].dataType)).otherwise(col)
        cols.append(col.alias(name))
    return out.select(*cols).toDF(*docs.columns)
