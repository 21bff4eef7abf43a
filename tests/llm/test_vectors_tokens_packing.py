"""Nearest neighbours, token files, packing, mixing, the pipeline."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op2_multi_index_hashing as O2
from ledgerloom.llm import op3_wavelet_tokens as O3
from ledgerloom.llm import op4_retrieval_packing as O4
from ledgerloom.llm import op8_source_mixing as O8
from ledgerloom.llm.common import new_dir
from ledgerloom.llm.tokens import ByteLevelEncoder, WhiteSpaceEncoder
from ledgerloom.llm.wavelet import WaveletMatrix, from_bytes, to_bytes
from tests.conftest import SF0001
from tests.llm.conftest import EDGE


def tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(name))


# --- op2 ---------------------------------------------------------------------

def test_neighbours_recall_and_scores(spark):
    rows = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF0001}/embeddings.parquet").collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    got = defaultdict(list)
    for r in O2.op2_multi_index_hashing(spark, SF0001).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [i for i in ids.tolist() if i % 50 == 0]
    hit = 0
    for q, found in got.items():
        found.sort()
        at = int(np.searchsorted(ids, q))
        cos = x @ x[at]
        cos[at] = -2
        assert [f[0] for f in found] == [1, 2, 3, 4, 5] and all(abs(s - cos[np.searchsorted(ids, v)]) < 1e-12 for _, v, s in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hit += len({f[1] for f in found} & set(ids[np.lexsort((ids, -cos))[:5]].tolist()))
    assert hit >= 0.9 * 5 * len(got)


@pytest.mark.parametrize("radius", [0, 3, 9, 17, 40, 64])
def test_index_retrieves_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    codes = rng.integers(0, 1 << 63, 500, dtype=np.int64).view(np.uint64)
    codes = np.concatenate((codes, codes[:50] ^ np.uint64(0x10001), codes[:50]))
    index = O2.MultiIndex(codes)
    masks = O2.probe_masks(min(O2.SUB_BITS, radius // O2.SUBSTRINGS), 600)
    for c in codes[::40]:
        assert index.within(c, radius, masks).tolist() == np.flatnonzero(np.bitwise_count(codes ^ c) <= radius).tolist()


def test_neighbours_edges(spark):
    v = lambda *x: list(map(float, x))
    rows = [(0, v(1, 0, 0), "x"), (1, v(1, 1, 0), "x"), (2, v(1, 1, 0), "x"), (3, None, None), (4, [1.0, None, 0.0], "x"),
            (5, v(0, 0, 0), "x"), (6, v(float("nan"), 1, 1), "x"), (7, v(float("inf"), 1, 1), "x"), (8, v(1, 2), "x"),
            (None, v(1, 0, 0), "x"), (50, v(-1, 0, 0), "x"), (50, v(-1, 0, 0), "x"), (100, None, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = [tuple(r) for r in O2.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert [(r[0], r[1], r[2]) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 50), (50, 1, 1), (50, 2, 2), (50, 3, 0)]
    assert got[0][3] == pytest.approx(0.5 ** 0.5, abs=1e-15) and got[3][3] == -1
    assert O2.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert O2.nearest(df.where("vec_id = 0"), F.col("vec_id") % 50 == 0).count() == 0


# --- tokens and op3 ----------------------------------------------------------

PIECES = ["a", "B", " ", "  ", "\n", " \n", "\n\n", "é", "É", "'s", "don't", "1", "23", "!", ".", ",", "a.", "b, ", ". ", "\t", " ", " ",
          "ﬁ", "İ", "ß", "<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "***", "中文", "\x1c", "\x85", "_", "#", "Word.", "’", "́", "ΑΣ", "\x00", "’ll", "\r\n", "K", "œ", "Œ",
          "<|startoftext|>", "<|endof", "text|>", "\u095c", "\u092a\u0939\u093e\u0921\u093c,", "\ufb2a", "\u05e9\u05c1", "\u1100\u1161", "A\u030a", "\u01c5", "\u3000"]


@pytest.mark.parametrize("name, kind", [("byte_bpe_50k.json", ByteLevelEncoder), ("word_bpe_49k.json", WhiteSpaceEncoder)])
def test_memoised_ids_equal_the_tokenizers(name, kind):
    r, t, e = random.Random(1), tokenizer(name), kind.get(name)
    texts = [None, ""] + ["".join(r.choice(PIECES) for _ in range(r.randrange(30))) for _ in range(8000)]
    got = [np.frombuffer(x, "<u4").tolist() for x in e.encode(texts, 7)]
    assert got == [t.encode(x or "", add_special_tokens=False).ids + [7] for x in texts]


@pytest.mark.parametrize("n, top", [(0, 5), (1, 1), (1, 50257), (9, 2), (513, 7), (3000, 50257), (2000, 100_000)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    x = rng.integers(0, top, n).astype("<u4")
    w, ids, lengths = from_bytes(to_bytes(WaveletMatrix.build(x), [3, None], [n, 0]))
    assert (w.all_ids() == x).all() and ids == [3, None] and lengths.tolist() == [n, 0]
    for i in rng.integers(0, n, 15).tolist() if n else []:
        token = int(x[i])
        places = np.flatnonzero(x == token)
        assert w.access(i) == token and w.count(token) == len(places) and w.count(token, i) == (x[:i] == token).sum()
        assert [w.find(token, j) for j in (0, len(places) - 1, len(places))] == [places[0], places[-1], -1]
    assert w.count(200_000) == 0


def check_tokens(rows, got):
    t, start, want = tokenizer(O3.VOCABULARY), 0, {}
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want


def test_token_files_round_trip(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    check_tokens(rows, O3.op3_wavelet_tokens(spark, SF0001).collect())


def test_token_files_of_many_small_shards(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect())
    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    old, O3.small_batches = O3.small_batches, lambda s: None
    try:
        manifest = O3.write_shards(docs, new_dir(spark, "tokens"), shard_tokens=20_000)
        assert manifest.count() > 5
        check_tokens(rows, O3.read_shards(manifest).collect())
    finally:
        O3.small_batches = old


def test_token_edges(spark, edge_docs, no_docs):
    manifest = O3.write_shards(edge_docs, new_dir(spark, "tokens"))
    got = O3.read_shards(manifest).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert by[1].n_tokens == by[2].n_tokens == 1 and by[1].ids_crc32 == zlib.crc32(np.array([2], "<u4").tobytes())
    assert min(r.start for r in got) == 0
    places = sorted((r.start, r.n_tokens, r.doc_id) for r in got)
    assert all(a[0] + a[1] == b[0] for a, b in zip(places, places[1:]))
    assert [p[2] for p in places] == sorted((p[2] for p in places), key=lambda i: -1 if i is None else i)
    assert O3.read_shards(O3.write_shards(no_docs, new_dir(spark, "tokens"))).count() == 0


# --- op4 ---------------------------------------------------------------------

def check_packing(rows, got):
    t = tokenizer(O4.VOCABULARY)
    want = Counter()
    for i, text in rows:
        want[(i, zlib.crc32(np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()))] += 1
    by, seq = defaultdict(list), defaultdict(list)
    for r in got:
        by[(r.doc_id, r.copy)].append(r)
        seq[r.sequence_id].append(r)
    assert len(by) == len(rows)
    texts = defaultdict(list)
    for i, text in rows:
        texts[i].append(np.array(t.encode(text or "", add_special_tokens=False).ids + [1], "<u4"))
    for (i, _), pieces in by.items():
        pieces.sort(key=lambda r: r.start)
        fits = [x for x in texts[i] if len(x) == pieces[0].doc_tokens and all(
            zlib.crc32(x[p.start:p.start + p.length].tobytes()) == p.ids_crc32 for p in pieces)]
        at = 0
        for p in pieces:
            assert p.start == at and p.length > 0
            at += p.length
        assert fits and at == pieces[0].doc_tokens
    for pieces in seq.values():
        at = 0
        for p in sorted(pieces, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    return seq


def test_packing_is_exact_and_dense(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = O4.op4_retrieval_packing(spark, SF0001).collect()
    seq = check_packing(rows, got)
    assert sum(r.length for r in got) >= 0.99 * 2048 * (len(seq) - 1)
    again = O4.op4_retrieval_packing(spark, SF0001).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_packing_edges(edge_docs, no_docs):
    check_packing([(r[0], r[1]) for r in EDGE], O4.pack_documents(edge_docs, shard_docs=8).collect())
    assert O4.pack_documents(no_docs).count() == 0


def test_bm25_matches_brute_force():
    rng = np.random.default_rng(0)
    ids = [rng.zipf(1.5, int(n)).astype(np.uint32) % 60 for n in rng.integers(1, 80, 30)]
    index, mean = O4.Index(ids), np.mean([len(x) for x in ids])
    for seed in range(30):
        got = index.scores(seed)
        for d in range(30):
            s = 0.0
            for term in set(ids[seed].tolist()):
                df = sum(term in x for x in ids)
                tf = int((ids[d] == term).sum())
                idf = max(0.0, np.log((30 - df + 0.5) / (df + 0.5)))
                s += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(ids[d]) / mean)) if tf else 0
            assert got[d] == pytest.approx(s)


def test_neighbours_fill_a_seed_window():
    a, b = np.arange(100, 400, dtype=np.uint32), np.arange(1000, 1300, dtype=np.uint32)
    ids = [a, b, b + 5, a + 5, *[np.arange(5000 + 400 * i, 5300 + 400 * i, dtype=np.uint32) for i in range(4)]]
    pieces = O4.pack([len(x) for x in ids], O4.Index(ids), window=600)
    assert [p[0] for p in pieces if p[3] == 0] == [0, 3] and [p[0] for p in pieces if p[3] == 1] == [1, 2]


def planted(n, seed=0):
    """n documents in related pairs: a pair's words are its own, apart from
    words that all share. Ids deal the two of a pair far apart."""
    r = random.Random(seed)
    words = sorted(w[:-4] for w in tokenizer(O4.VOCABULARY).get_vocab() if w.endswith("</w>") and re.fullmatch("[a-z]{5,}", w[:-4]))
    docs = []
    for i in range(n // 2):
        own = r.sample(words, 40)
        for half in (0, 1):
            docs.append((i + half * 10**6, " ".join(r.sample(own, 36) + r.sample("one two three four five six seven eight".split(), 4))))
    return docs


@pytest.mark.parametrize("n, shard_docs", [(60, 1024), (60, 16), (1200, 1024), (1200, 64), (6000, 256)])
def test_related_documents_share_a_window_at_every_size(spark, monkeypatch, n, shard_docs):
    """Related pairs meet whatever the number of index shards and tasks."""
    docs = planted(n)
    t = tokenizer(O4.VOCABULARY)
    size, = {len(t.encode(x, add_special_tokens=False).ids) + 1 for _, x in docs}
    window = 2 * size
    monkeypatch.setattr(O4, "PART_TOKENS", 1 << 16)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = O4.pack_documents(df, window=window, shard_docs=shard_docs).collect()
    seen = defaultdict(set)
    for r in got:
        seen[r.doc_id].add(r.sequence_id)
    assert len(seen) == n
    together = sum(bool(seen[i] & seen[i + 10**6]) for i in range(n // 2))
    assert together >= 0.9 * (n // 2), together
    assert sum(r.length for r in got) >= 0.9 * window * (len({r.sequence_id for r in got}) - 1)


def test_shards_score_with_the_statistics_of_the_corpus():
    rng = np.random.default_rng(3)
    ids = [rng.zipf(1.4, int(n)).astype(np.uint32) % 80 for n in rng.integers(1, 90, 60)]
    df = np.bincount(np.concatenate([np.unique(x) for x in ids]), minlength=100)
    corpus = O4.Corpus(df, 60, float(np.mean([len(x) for x in ids])))
    whole, shard = O4.Index(ids), O4.Index(ids[20:40], corpus)
    for seed in range(20):
        assert shard.scores(seed) == pytest.approx(whole.scores(20 + seed)[20:40])


def test_a_shard_ends_between_unrelated_documents():
    key = lambda *t: np.array(t, ">u4").tobytes()
    units = [O4.Unit(key(i // 2, 1000 + i // 2), [], 0) for i in range(17)]
    assert O4.break_at(units, 16) == 16 and O4.break_at(units[1:] + units[:1], 15) % 2 == 1


# --- op8 ---------------------------------------------------------------------

def plain_targets(words):
    names = sorted((s for s in words if s is not None)) + ([None] if None in words else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = 1.5 * sum(words.values()), {}
    while True:
        rest = {s for s in names if s not in capped}
        left = total - sum(capped.values())
        w = sum(weight[s] for s in rest)
        over = {s for s in rest if left * weight[s] / w > 2 * words[s]}
        if not over:
            return capped | {s: left * weight[s] / w for s in rest}
        capped |= {s: 2.0 * words[s] for s in over}


def check_mix(docs, got):
    words, taken, target = Counter(), Counter(), {}
    source = {}
    for i, text, s in docs:
        n = len([w for w in (text or "").replace("\t", " ").replace("\n", " ").split(" ") if w])
        words[s] += n
        source[(i, n)] = s
    want = plain_targets(dict(words))
    for r in got:
        s = source[(r.doc_id, r.size)]
        assert r.source_size == words[s] and r.target == pytest.approx(want[s]) and r.taken % max(1, r.size) == 0
        assert r.taken <= 2 * r.size
        taken[s] += r.taken
    return words, taken, want


def test_mix_hits_targets_and_repeats(spark):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    got = O8.op8_source_mixing(spark, SF0001).collect()
    words, taken, want = check_mix(docs, got)
    n = Counter(s for *_, s in docs)
    for s in words:
        assert abs(taken[s] - want[s]) <= 0.5 * words[s] / n[s] + 1
    assert Counter(map(tuple, got)) == Counter(map(tuple, O8.op8_source_mixing(spark, SF0001).collect()))


@pytest.mark.parametrize("steps", [O8.STEPS, 0, 2])
def test_dual_meets_constraints(spark, steps):
    """Also where Newton steps run out."""
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 3000, 200).tolist()
    hist = spark.createDataFrame([(k, s, 1) for k in range(3) for s in sizes], "no int, size long, n long")
    total = sum(sizes)
    sources = [{"no": k, "words": total, "docs": 200, "target": total * f} for k, f in enumerate((0.2, 1.0, 1.97))]
    lam = O8.solve_dual(hist, sources, steps=steps)
    for k, f in enumerate((0.2, 1.0, 1.97)):
        w = [2 / (1 + np.exp(-lam[k] * s / (total / 200))) for s in sizes]
        assert sum(a * b for a, b in zip(w, sizes)) == pytest.approx(total * f, rel=1e-5)


def test_mix_edges(spark, edge_docs, no_docs):
    sized = lambda d: d.select("doc_id", "source", O8.n_words(F.col("text")).alias("size"))
    out = O8.mix(sized(edge_docs)).withColumn("taken", F.col("copies") * F.col("size")).collect()
    assert len(out) == len(EDGE)
    check_mix([(r[0], r[1], r[3]) for r in EDGE], out)
    assert O8.mix(sized(no_docs)).count() == 0
    empty = O8.mix(sized(edge_docs.where("text is null"))).collect()
    assert {r.target for r in empty} == {0.0}
    mixed = O8.take_mixture(spark, edge_docs, "")
    assert mixed.columns == edge_docs.columns and max(Counter(r.doc_id for r in mixed.collect() if r.doc_id).values()) <= 4
    assert O8.take_mixture(spark, no_docs, "").count() == 0


# --- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF0001}/documents.parquet")
    columns, now, left = docs.columns, docs, {}
    for name, stage in P.STAGES:
        path = new_dir(spark, "stage-test")
        stage(spark, now, SF0001).write.parquet(path)
        now = spark.read.parquet(path)
        left[name] = now
        if name != "packing":
            assert now.columns == columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert left["language_id"].count() == sum(any(c.isalpha() for c in t or "") for t in texts.values())
    kept = {r.doc_id for r in left["simhash_dedup"].collect()}
    from ledgerloom.llm.op7_simhash_dedup import near_duplicates
    near = near_duplicates(left["language_id"]).collect()
    assert kept == {r.doc_id for r in near if r.doc_id == r.component_id}
    assert {r.doc_id for r in left["suffix_dedup"].collect()} == kept
    check_packing([(r.doc_id, r.text) for r in left["source_mixing"].collect()], left["packing"].collect())
    direct = P.run(spark, SF0001)
    assert Counter(map(tuple, direct.collect())) == Counter(map(tuple, left["packing"].collect()))


def test_every_query_is_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {n for n in names if n.startswith("op")} and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in names if n.startswith("op")} == set(range(1, 14))


@pytest.mark.parametrize("kind, name, text", [
    (ByteLevelEncoder, "byte_bpe_50k.json", "plain words With capitals quxzat"),
    (WhiteSpaceEncoder, "word_bpe_49k.json", "plain words without capitals quxzat")])
def test_ascii_words_go_to_the_model_at_once(monkeypatch, kind, name, text):
    import public_tokenizers
    encoder = kind(public_tokenizers.path(name))
    monkeypatch.setattr(kind, "symbols", staticmethod(lambda word: None if word[0] == "\1" else pytest.fail(word)))
    ids = np.frombuffer(encoder.encode([text], 7)[0], "<u4").tolist()
    assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [7]


def test_plain_texts_by_byte_classes():
    import random
    from ledgerloom.llm import tokens as T
    draw = random.Random(5)
    for _ in range(20_000):
        text = "".join(draw.choices("ab9 .,;_\n\té×÷ ł 　\0\1-", k=draw.randint(1, 9)))
        # False is allowed where a stop follows a letter above U+00FF
        assert not T.plain(text) or not T._PLAIN_NOT.search(text), ascii(text)
        if text.isascii():
            assert T.plain(text) == (not T._PLAIN_NOT.search(text)), ascii(text)


def test_counted_is_unique_with_counts():
    for ids in ([], [5], [5, 5], [9, 0, 65535, 9, 3, 0, 9]):
        x = np.array(ids, "<u2")
        got, want = O4.counted(x), np.unique(x, return_counts=True)
        assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (9, 300), (1000, 50_000), (1000, 1 << 20)])
def test_planes_move_ids_as_masks_do(monkeypatch, n, most):
    from ledgerloom.llm import wavelet
    used = []
    real = wavelet._mask
    monkeypatch.setattr(wavelet, "_mask", lambda plane, n: used.append(n) or real(plane, n))
    ids = np.random.default_rng(n).integers(0, most, n).astype(np.uint32)
    matrix, now = WaveletMatrix.build(ids), ids
    for k in range(matrix.width):
        bit = now >> (matrix.width - 1 - k) & 1 == 1
        assert matrix.bits(k).tolist() == bit.tolist()
        now = np.concatenate((now[~bit], now[bit]))
    assert matrix.all_ids().tolist() == ids.tolist() and used == [n] * 2 * matrix.width


@pytest.mark.parametrize("kind, file, words", [(ByteLevelEncoder, "byte_bpe_50k.json", ["\1Wort", "Zeile", "\1Über", "Été", "\0été"]),
                                               (WhiteSpaceEncoder, "word_bpe_49k.json", ["wort", "zeile", "über", "été"])])
def test_words_of_letters_are_learned_at_once(monkeypatch, kind, file, words):
    import public_tokenizers
    encoder = kind(public_tokenizers.path(file))

    def never(*args):
        raise AssertionError("a word of letters was cut or sent to the library")

    monkeypatch.setattr(encoder, "parts", never)
    monkeypatch.setattr(encoder, "_ids", never)
    encoder._learn(words)
    spelled = [encoder.spelled(w) for w in words]
    assert [list(np.frombuffer(encoder.young[w], "<u4")) for w in words] == [tokenizer(file).encode(x, add_special_tokens=False).ids for x in spelled]


def test_keys_are_worked_out_once(spark, monkeypatch):
    """Range bounds and the shuffle of the first pass read stored keys; one copy of the ids is stored."""
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 37}" for j in range(1 + i % 50))) for i in range(300)], "doc_id long, text string")
    seen, paths = [], []

    def store(self, df, name, f=O4.Scratch.store):
        out = f(self, df, name)
        paths.append(self.paths[-1])
        return out

    def step(left, step, *args, f=O4._step):
        seen.append((left._jdf.queryExecution().optimizedPlan().toString(), args[3:], list(map(os.path.isdir, paths))))
        return f(left, step, *args)

    monkeypatch.setattr(O4.Scratch, "store", store)
    monkeypatch.setattr(O4, "_step", step)
    rows = O4.pack_documents(docs).collect()
    plan, tokens, there = seen[0]
    assert "MapInArrow" not in plan and there == [False, True]
    assert tokens == (sum(r.length for r in rows),) and len(paths) == 2 and not any(map(os.path.isdir, paths))


def test_ids_of_16_bits_are_those_of_32():
    e = WhiteSpaceEncoder.get("word_bpe_49k.json")
    texts = ["", None, "plain words, and a stop.", "Größe  ünd <|startoftext|> x", "\n a\tb"]
    for x, y in zip(e.encode(texts, 1), e.encode(texts, 1, "<u2")):
        assert np.frombuffer(x, "<u4").astype("<u2").tobytes() == y
