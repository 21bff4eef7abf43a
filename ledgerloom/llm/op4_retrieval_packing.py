"""Packing documents into token windows by lexical retrieval.

Documents are dealt to index shards by content: a document's ``KEY_TERMS``
heaviest terms (BM25 weight under document frequencies, count and mean length of
the whole corpus; terms of one document alone left out), the rarest first, are
its place in one global order, so documents that share rare terms lie side by
side. The order is cut into range partitions and these into shards of at most
``SHARD_DOCS`` documents, each cut where neighbours share fewest key terms. In a
shard a seed document opens a window; BM25 with the seed's tokens as the query
returns the shard's unused documents, best first, and they fill the window. The
document that reaches the window's end is cut there, and its rest is the next
seed. A seed takes no document that scores under ``NEAR_ENOUGH`` of what the
seed scores itself.

Windows that no unused document fills so are dealt once more, each as one unit,
by a second key (the same terms in the order of a hash), and retrieve each
other. What is left then is laid one after another and cut anew, so that only the
last window of about ``PART_TOKENS`` tokens of such rests is padded. The steps are the same at every size; a table of at most ``SHARD_DOCS``
documents is one shard, so there each seed searches all of it, and a larger
``shard_docs`` searches as much more.

The work is linear in the tokens: one shuffle of all ids, two of the rests. A task
holds one shard's remainders, less than a window each.

Defined results
  null or empty text     one piece, the end id alone
  document over a window its full windows come first, the rest is packed
  tied BM25 scores       the one that comes first in the shard's order
  tokens in over half of the documents   weight 0, they retrieve nothing
  repeated rows          packed each on its own; ``copy`` tells rows of one
                         doc_id apart, null ids included
  empty table            no rows
  extra columns          ignored
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import Scratch, blocks_for, small_batches, stored, table
from ledgerloom.llm.tokens import WhiteSpaceEncoder

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
WINDOW = 2048
SHARD_DOCS = 1024       # units of an index shard
PART_TOKENS = 1 << 21   # tokens of a range partition
KEY_TERMS = 16
NEAR_ENOUGH = 0.2       # of a seed's own score: it takes no weaker neighbour
K1, B = 1.2, 0.75


@dataclass(frozen=True)
class Corpus:
    """Statistics of all documents: document frequency by token id, count, mean length."""
    df: np.ndarray
    n: int
    mean: float

    @property
    def idf(self) -> np.ndarray:
        return np.maximum(0.0, np.log((self.n - self.df + 0.5) / (self.df + 0.5)))


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct ids and how often each occurs: ``np.unique`` with less
    to do a call, for arrays of a document's size."""
    s = np.sort(ids)
    if not len(s):
        return s, np.zeros(0, np.int64)
    edges = np.flatnonzero(s[1:] != s[:-1]) + 1
    first = np.concatenate(([0], edges))
    return s[first], np.concatenate((edges, [len(s)])) - first


class Index:
    """BM25 inverted index of one shard's units, with the corpus's statistics
    (or, without them, the shard's own)."""

    def __init__(self, ids: list[np.ndarray], corpus: Corpus | None = None):
        self.n = len(ids)
        found = [counted(x) for x in ids]
        sizes = np.array([len(x[0]) for x in found])
        term = np.concatenate([x[0] for x in found]).astype(np.int64)
        doc = np.repeat(np.arange(self.n), sizes)
        tf = np.concatenate([x[1] for x in found]).astype(np.float64)
        length = np.array([len(x) for x in ids], np.float64)
        order = np.argsort(term.astype(np.uint16) if len(term) and term.max() < 1 << 16 else term, kind="stable")      # 16 bits: radix sort
        self.terms, first, df = np.unique(term[order], return_index=True, return_counts=True)
        self.first, self.df = first, df
        idf = corpus.idf[self.terms] if corpus else np.maximum(0.0, np.log((self.n - df + 0.5) / (df + 0.5)))
        self.docs = doc[order]
        norm = K1 * (1 - B + B * length / max(1.0, corpus.mean if corpus else length.mean()))
        w = tf * (K1 + 1) / (tf + norm[doc])
        self.weights = w[order] * np.repeat(idf, df)
        # a document's query: its terms that weigh anything, as places in self.terms
        place = np.searchsorted(self.terms, term)
        keep = idf[place] > 0
        ends = np.cumsum(np.bincount(doc[keep], minlength=self.n))
        self.queries = np.split(place[keep], ends[:-1])

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document for the seed's distinct tokens."""
        q = self.queries[seed]
        n = self.df[q]
        total = int(n.sum())
        if not total:
            return np.zeros(self.n)
        ends = np.cumsum(n)
        at = np.arange(total) + np.repeat(self.first[q] - (ends - n), n)
        return np.bincount(self.docs[at], self.weights[at], self.n)


def pack(lengths: list[int], index: Index, window: int = WINDOW, near_enough: float = 0.0) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of one shard. A seed
    takes documents that score over ``near_enough`` of what it scores itself."""
    left, out = list(lengths), []
    fill, sequence, unused = 0, 0, 0        # unused: every document before it is used up
    current = -1                            # the document that was cut last

    def take(d: int) -> None:
        nonlocal fill, sequence, current
        n = min(left[d], window - fill)
        out.append((d, lengths[d] - left[d], n, sequence, fill))
        left[d] -= n
        fill += n
        current = d if left[d] else -1
        if fill == window:
            fill, sequence = 0, sequence + 1

    while True:
        if current < 0:
            while unused < len(left) and not left[unused]:
                unused += 1
            if unused == len(left):
                return out
            current = unused
        seed = current
        while left[seed]:
            take(seed)
        if fill:
            score = index.scores(seed)
            least, score[seed] = near_enough * score[seed], 0
            near = np.flatnonzero(score > least)
            for d in near[np.argsort(-score[near], kind="stable")]:
                if left[d]:
                    take(int(d))
                    if not fill:
                        break
            if fill:                    # nothing unused is near enough: the window stays open
                fill, sequence, current = 0, sequence + 1, -1


def encode_rows(docs: DataFrame, vocabulary: str, end_id: int, scratch: Scratch) -> DataFrame:
    """Every row once, stored: doc_id, uid (tells rows apart), n, ids (16 bits each)."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WhiteSpaceEncoder.get(vocabulary)
        if encoder.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        encode = encoder.encode
        for b in batches:
            ids = encode(b.column("text").to_pylist(), end_id, "<u2")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(x) // 2 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                                             ["doc_id", "n", "ids"])

    rows = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n long, ids binary")
    return scratch.store(rows.withColumn("uid", F.monotonically_increasing_id()), "packing-rows")


def corpus_of(rows: DataFrame) -> tuple[Corpus, int]:
    """Statistics of the whole corpus, and its tokens; a row a token id is collected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, last = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        for b in batches:
            found = []
            for x in b.column("ids").to_pylist():
                ids = np.frombuffer(x, "<u2")
                place = np.arange(len(ids))
                last[ids] = place
                found.append(ids[last[ids] == place])       # each id where it is last: once
            if found:
                df += np.bincount(np.concatenate(found), minlength=1 << 16)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(df[at], pa.int64())], ["term", "df"])

    n, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(1 << 16, np.int64)
    for r in rows.select("ids").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    return Corpus(df, n, max(1.0, total / max(1, n))), total


def key_terms(ids: np.ndarray, corpus: Corpus, idf: np.ndarray) -> np.ndarray:
    """The heaviest terms that another document has too and that weigh anything."""
    t, tf = counted(ids)
    fits = (idf[t] > 0) & (corpus.df[t] > 1)
    t, tf = t[fits].astype(np.int64), tf[fits]
    w = idf[t] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(ids) / corpus.mean))
    return t[np.lexsort((t, -w))][:KEY_TERMS]


def first_key(terms: np.ndarray, corpus: Corpus) -> bytes:
    return terms[np.lexsort((terms, corpus.df[terms]))].astype(">u4").tobytes()


def second_key(terms: np.ndarray) -> bytes:
    hashed = (terms * 2654435761) % (1 << 32)
    return np.sort(hashed).astype(">u4").tobytes()


@dataclass
class Unit:
    """What is packed as one: pieces (doc_id, uid, start, doc_tokens, ids) in a
    row, and the key it was dealt by."""
    key: bytes
    pieces: list[tuple]
    length: int

    def ids(self) -> np.ndarray:
        return self.pieces[0][4] if len(self.pieces) == 1 else np.concatenate([p[4] for p in self.pieces])

    def cut(self, start: int, length: int) -> list[tuple]:
        """The pieces of ``length`` tokens from ``start`` on."""
        out, at = [], 0
        for doc_id, uid, first, n, ids in self.pieces:
            a, z = max(start, at), min(start + length, at + len(ids))
            if a < z:
                out.append((doc_id, uid, first + a - at, n, ids[a - at:z - at]))
            at += len(ids)
        return out


def break_at(units: list[Unit], shard_docs: int) -> int:
    """Where to end a shard: in its last quarter, where neighbours share fewest
    key terms (the last such place)."""
    least, at = KEY_TERMS + 1, shard_docs
    sets = [set(u.key[i:i + 4] for i in range(0, len(u.key), 4)) for u in units[shard_docs * 3 // 4 - 1:shard_docs + 1]]
    for i in range(1, len(sets)):
        same = len(sets[i - 1] & sets[i])
        if same <= least:
            least, at = same, shard_docs * 3 // 4 - 1 + i
    return max(1, at)


class Writer:
    """Rows of one task: pieces of closed windows, and what is left to pack."""

    NAMES = ["doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "key", "unit"]

    def __init__(self, step: int, kind: pa.DataType):
        self.next = step << 56 | TaskContext.get().partitionId() << 28
        self.kind, self.rows = kind, []

    def add(self, pieces: list[tuple], key: bytes | None = None) -> None:
        """One window's pieces, one after another; closed unless ``key`` says
        where to deal it next."""
        offset, self.next = 0, self.next + 1
        for doc_id, uid, start, n, ids in pieces:
            crc = zlib.crc32(ids.astype("<u4").tobytes()) if key is None else None
            self.rows.append((doc_id, uid, start, len(ids), crc, n, self.next, offset, None if key is None else ids.tobytes(), key, self.next))
            offset += len(ids)

    def flush(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            kinds = [self.kind, *[pa.int64()] * 7, pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*self.rows), kinds)], self.NAMES)
            self.rows = []


def pack_units(units: list[Unit], corpus: Corpus, window: int, near_enough: float) -> Iterator[tuple[list[tuple], int, Unit]]:
    """(pieces, tokens, seed) of each window of one shard."""
    if not units:
        return
    windows: dict[int, list[tuple[int, int, int]]] = {}
    for d, start, n, sequence, _ in pack([u.length for u in units], Index([u.ids() for u in units], corpus), window, near_enough):
        windows.setdefault(sequence, []).append((d, start, n))
    for parts in windows.values():
        yield [p for d, start, n in parts for p in units[d].cut(start, n)], sum(n for *_, n in parts), units[parts[0][0]]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[Unit]:
    """Rows that follow one another and have one ``unit`` are one."""
    now, unit = None, None
    for b in batches:
        cols = [b.column(c).to_pylist() for c in ("unit", "key", "doc_id", "uid", "start", "doc_tokens", "ids")]
        for u, key, doc_id, uid, start, n, ids in zip(*cols):
            if u != now:
                if unit is not None:
                    yield unit
                now, unit = u, Unit(key, [], 0)
            x = np.frombuffer(ids, "<u2")
            unit.pieces.append((doc_id, uid, start, n, x))
            unit.length += len(x)
    if unit is not None:
        yield unit


class Chain:
    """Windows laid one after another and cut anew."""

    def __init__(self, window: int):
        self.window, self.pieces, self.fill, self.key = window, [], 0, b""

    def add(self, unit: Unit) -> Iterator[list[tuple]]:
        at = 0
        while at < unit.length:
            n = min(unit.length - at, self.window - self.fill)
            self.pieces += unit.cut(at, n)
            at, self.fill, self.key = at + n, self.fill + n, unit.key
            if self.fill == self.window:
                yield self.pieces
                self.pieces, self.fill = [], 0


def _step(left: DataFrame, step: int, corpus, window: int, shard_docs: int, tokens: int | None = None) -> DataFrame:
    """One pass over units (of ``tokens`` in all) in the order of their keys: 1 deals what it cannot
    fill for the second pass, 2 chains it and hands on each task's last
    window, 3 only chains and closes the last window, too."""
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in left.schema]
    order = ["doc_id", "uid", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids", "key", "unit"]
    schema = ", ".join(next(x for x in names if x.startswith(f"`{c}`")) for c in order)
    if tokens is None:
        tokens = left.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    dealt = left.repartitionByRange(blocks_for(tokens, PART_TOKENS, 1), "key", "unit").sortWithinPartitions("key", "unit", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        out, chain, idf = Writer(step, first.schema.field("doc_id").type), Chain(window), corpus.value.idf

        def rest(unit: Unit) -> None:
            for pieces in chain.add(unit):
                out.add(pieces)

        def shard(units: list[Unit]) -> None:
            for pieces, n, seed in pack_units(units, corpus.value, window, NEAR_ENOUGH):
                if n == window:
                    out.add(pieces)
                elif step == 1:
                    out.add(pieces, second_key(key_terms(seed.ids(), corpus.value, idf)))
                else:
                    rest(Unit(seed.key, pieces, n))

        waiting: list[Unit] = []
        for unit in _units(_and(first, batches)):
            if step == 3:
                rest(unit)
            else:
                if unit.length >= window:       # full windows first
                    full = unit.length // window * window
                    for a in range(0, full, window):
                        out.add(unit.cut(a, window))
                    unit = Unit(unit.key, unit.cut(full, unit.length - full), unit.length - full)
                if unit.length:
                    waiting.append(unit)
                if len(waiting) > shard_docs:
                    at = break_at(waiting, shard_docs)
                    shard(waiting[:at])
                    waiting = waiting[at:]
            yield from out.flush(4096)
        shard(waiting)
        if chain.fill:
            out.add(chain.pieces, None if step == 3 else chain.key)
        yield from out.flush()

    return dealt.select(*order).mapInArrow(run, schema)


def _and(first: pa.RecordBatch, others: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from others


def keyed(rows: DataFrame, corpus) -> DataFrame:
    """Documents as units of the first pass."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = corpus.value.idf
        for b in batches:
            keys = [first_key(key_terms(np.frombuffer(x, "<u2"), corpus.value, idf), corpus.value) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "uid", "n", "ids")), pa.array(keys, pa.binary())],
                                             ["doc_id", "uid", "n", "ids", "key"])

    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    return rows.select("doc_id", "uid", "n", "ids").mapInArrow(run, f"doc_id {kind}, uid long, n long, ids binary, key binary").select(
        "doc_id", "uid", zero.alias("start"), F.col("n").alias("length"), none.alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        none.alias("sequence_id"), zero.alias("offset"), "ids", "key", F.col("uid").alias("unit"))


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, window: int = WINDOW,
                   shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row a piece: doc_id, copy, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rows = encode_rows(docs, vocabulary, end_id, scratch)
    found, tokens = corpus_of(rows)
    corpus = spark.sparkContext.broadcast(found)        # a number for each of 65,536 ids
    units = Scratch(spark)      # keys are worked out once: range bounds and the shuffle read them stored
    dealt = units.store(keyed(rows, corpus), "packing-keyed")
    scratch.drop()              # one stored copy of the ids at a time
    first = stored(_step(dealt, 1, corpus, window, shard_docs, tokens), "packing-first")
    units.drop()
    second = stored(_step(first.where("ids is not null"), 2, corpus, window, shard_docs), "packing-second")
    third = stored(_step(second.where("ids is not null"), 3, corpus, window, shard_docs), "packing-third")
    closed = first.where("ids is null").unionByName(second.where("ids is null")).unionByName(third)
    return closed.select("doc_id", F.col("uid").alias("copy"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the packed pieces of the documents that are left. Null
    texts, repeated and null ids, an empty table: as in ``pack_documents``."""
    return pack_documents(docs.select("doc_id", "text"))
