"""SimHash near-duplicates, repeated passages, suffix arrays, components."""

import hashlib
import os
import re
from collections import Counter

import numpy as np
import pandas as pd
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import op7_simhash_dedup as O7
from ledgerloom.llm import op9_suffix_dedup as O9
from ledgerloom.llm.components import components
from ledgerloom.llm.suffix_array import permuted_lcp, suffix_array
from ledgerloom.session import shared_dir
from tests.conftest import SF0001
from tests.llm.conftest import COPY, EDGE, prose


# --- op7 ---------------------------------------------------------------------

def plain_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            votes[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * votes[k] > len(shingles))


def plain_components(rows):
    """doc -> smallest doc reachable, by comparing all fingerprints."""
    fps = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= 4):
            a, b = top(i), top(int(j))
            up[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return Counter((doc, f"{int(f):016x}", least.get(top(i))) for i, ((doc, _), f) in enumerate(zip(rows, fps)))


def test_simhash_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert Counter(map(tuple, O7.op7_simhash_dedup(spark, SF0001).collect())) == plain_components(rows)


def test_simhash_edges(spark, edge_docs, no_docs):
    got = Counter(map(tuple, O7.near_duplicates(edge_docs).collect()))
    assert got == plain_components([(r[0], r[1]) for r in EDGE])
    assert O7.near_duplicates(no_docs).count() == 0
    kept = O7.keep_one_of_each(spark, edge_docs, "")
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == edge_docs.columns
    assert ids.count(9) == 1 and ids.count(1) == 1 and not {2, 3, 7, 8} & set(ids) and 6 in ids


def test_one_row_of_each_component_stays(spark):
    """Rows are told apart by doc_id and text: a repeated id loses no other
    document, and copies without an id go."""
    texts = [" ".join(f"{w}{k}" for w in range(60)) for k in "abc"]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1]), (2, texts[0]), (None, texts[0]), (None, texts[2]), (None, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter(map(tuple, O7.keep_one_of_each(spark, docs, "").collect()))
    assert got == Counter([(1, texts[0]), (1, texts[1]), (None, texts[2])])


def test_blocks_and_tiles_lose_no_link(spark):
    """Many small blocks, chains of neighbours, fingerprints at all counts."""
    rng = np.random.default_rng(5)
    fps = set()
    for base in rng.integers(0, 1 << 63, 40, dtype=np.int64).tolist() + [0, (1 << 64) - 1]:
        now = base
        for _ in range(int(rng.integers(1, 25))):
            for b in rng.integers(0, 64, int(rng.integers(1, 7))).tolist():
                now ^= 1 << b
            fps.add(now)
    a = np.array(sorted(fps), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in a.view(np.int64)], "fp long")
    got = {r.node: r.root for r in components(O7.linked(df, 4, block_rows=50)).collect()}
    group = np.arange(len(a))
    for _ in range(len(a)):
        new = np.array([group[np.bitwise_count(a ^ x) <= 4].min() for x in a])
        if (new == group).all():
            break
        group = new
    mine = [got.get(int(x), int(x)) for x in a.view(np.int64)]
    assert len(set(zip(group.tolist(), mine))) == len(set(group.tolist())) == len(set(mine))


def test_tiles_of_every_split():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 1 << 63, 300, dtype=np.int64).view(np.uint64)
    fp = np.concatenate((fp, fp ^ np.uint64(0b1011)))
    for k in (1, 2, 4, 8):
        order, start, counts = O7.tiles(fp, k)
        assert sorted(order) == list(range(len(fp))) and start[-1] == len(fp) and len(counts) == len(start) - 1


def test_one_large_group_returns_few_edges(spark):
    base = 0x0123456789ABCDEF
    fps = [base] + [base ^ 1 << i for i in range(64)] + [base ^ 1 << i ^ 1 << j for i in range(64) for j in range(i)]
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    edges = O7.linked(df, 4, block_rows=400)
    # a star for each pair of blocks a fingerprint is in, not the 2 million pairs
    assert edges.count() < 1.5 * O7.LEAST_BLOCKS * len(fps)
    assert components(edges).select("root").distinct().count() == 1


# --- suffix arrays and op9 ---------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.one_of(st.binary(max_size=60), st.lists(st.sampled_from([0, 1]), max_size=60).map(bytes),
                 st.tuples(st.binary(max_size=9), st.integers(1, 9)).map(lambda x: x[0] * x[1])))
def test_suffix_array_and_lcp(data):
    t = np.frombuffer(data, np.uint8)
    order = suffix_array(t)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    before, lcp = permuted_lcp(t, order)
    for a, b in zip(order[:-1].tolist(), order[1:].tolist()):
        n = 0
        while max(a, b) + n < len(data) and data[a + n] == data[b + n]:
            n += 1
        assert before[b] == a and lcp[b] == n


def test_suffix_array_with_recursion():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 256, 3000).astype(np.uint8)
    data = np.concatenate((base, base[500:2500], base)).tobytes()
    order = suffix_array(np.frombuffer(data, np.uint8))
    assert all(data[a:] < data[b:] for a, b in zip(order[:-1], order[1:]))


def test_segments_hold_every_window_once():
    for text in (b"ab" * 600, b"x" * 900, prose(1, 400).encode(), bytes(range(256)) * 9, b"y" * 199, b"z" * 200, b""):
        raw = np.frombuffer(text, np.uint8)
        at, n, h = O9.segments(raw)
        windows = np.concatenate([np.arange(a, a + k) for a, k in zip(at, n)]) if len(at) else np.empty(0)
        assert windows.tolist() == list(range(max(0, len(text) - 199)))
        by = {}
        for a, k, x in zip(at, n, h):
            for i in range(a, a + k):
                assert by.setdefault(text[i:i + 200], x) == x      # equal windows share their minimizer


def plain_removal(rows, window=200):
    seen = Counter()
    data = [(t or "").encode() for _, t in rows]
    for b in data:
        seen.update(b[i:i + window] for i in range(len(b) - window + 1))
    out = []
    for (doc, _), b in zip(rows, data):
        cut = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                cut[i:i + window] = True
        spans = int(np.count_nonzero(cut & ~np.concatenate(([False], cut[:-1])))) if len(b) else 0
        left = np.frombuffer(b, np.uint8)[~cut].tobytes()
        out.append((doc, len(b), int(cut.sum()), spans, hashlib.sha256(left).hexdigest()))
    return Counter(out)


def test_repeats_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    assert Counter(map(tuple, O9.op9_suffix_dedup(spark, SF0001).collect())) == plain_removal(rows)


def test_minimizers_are_listed_without_their_segments(spark):
    texts = [prose(i, 60) for i in range(9)] * 2 + ["ab" * 300, "é" * 250, "", "x" * 199, "y" * 200, None]
    docs = O9.keyed(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    listed = O9.list_minimizers(docs, 200, 32)
    assert listed.columns == ["h"]
    whole = O9.list_segments(docs, 200, 32)
    assert Counter(r.h for r in listed.collect()) == Counter(r.h for r in whole.select("h").collect())


def test_repeats_with_hot_minimizers_and_many_shards(spark):
    passage = prose(3, 60)
    texts = [prose(1000 + i, 20) + passage + prose(2000 + i, 20) for i in range(40)]
    texts += ["ab" * 300, "é" * 250, passage[7:220], passage[:199], prose(1001, 20) + "é" + passage[50:]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_removal(rows)
    assert Counter(map(tuple, O9.remove_repeats(df, hot_segments=4, shard_bytes=5000).collect())) == want
    assert Counter(map(tuple, O9.remove_repeats(df).collect())) == want


def test_repeats_edges(spark, edge_docs, no_docs):
    rows = [(r[0], r[1]) for r in EDGE if r[1] is None or len(r[1]) < 50_000]
    small = edge_docs.where("text is null or length(text) < 50000")
    assert Counter(map(tuple, O9.remove_repeats(small).collect())) == plain_removal(rows)
    assert O9.remove_repeats(no_docs).count() == 0
    cut = O9.cut_repeats(spark, edge_docs, "")
    got = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == edge_docs.columns and cut.count() == len(EDGE)
    assert got[1].text is None and got[6].text == "" and got[6].n_chars == 0
    assert COPY not in got[10].text and got[4].text == "one"


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1001 + i) for i in range(300)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(301)} == {1000} and 5000 not in got


def test_components_of_a_chain_numbered_at_random(spark, monkeypatch):
    from ledgerloom.llm import components as C
    stores = []
    real = C.Scratch.store
    monkeypatch.setattr(C.Scratch, "store", lambda self, df, name: stores.append(name) or real(self, df, name))
    n = 100_000
    name = np.random.default_rng(1).permutation(n + 1)
    df = spark.createDataFrame(pd.DataFrame({"a": name[:-1], "b": name[1:]}))
    got = components(df)
    assert got.count() == n + 1 and got.where("root <> 0").count() == 0
    assert stores.count("up") < 40
    assert not [p for p in os.listdir(shared_dir(spark)) if p.startswith(("llm-up-", "llm-edges-"))]


def test_near_copies_in_a_chain_are_one_group(spark):
    """800 fingerprints, each 4 bits from the next; their ends are far apart."""
    bits = np.random.default_rng(2)
    fp = [int(bits.integers(0, 1 << 62))]
    for _ in range(799):
        fp.append(fp[-1] ^ sum(1 << int(b) for b in bits.choice(63, 4, replace=False)))
    got = components(O7.linked(spark.createDataFrame([(x,) for x in fp], "fp long"), 4))
    assert got.count() == 800 and got.select("root").distinct().count() == 1
