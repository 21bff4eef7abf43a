"""Quality by neighbour votes, rules by weak supervision, language, licenses."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import op1_quality_knn as O1
from ledgerloom.llm import op5_weak_supervision as O5
from ledgerloom.llm import op6_language_id as O6
from ledgerloom.llm import op10_license_scan as O10
from tests.conftest import SF001, SF0001
from tests.llm.conftest import EDGE, LONG, row


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


# --- op1 ---------------------------------------------------------------------

def test_quality_separates_held_out_labels(spark):
    got = O1.op1_quality_knn(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert np.mean([g > b for g in good for b in bad]) > 0.95


def test_quality_does_not_read_labels_of_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF0001}/documents.parquet"), spark.read.parquet(f"{SF0001}/labels.parquet")
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0,
                                                 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (O1.classify(docs, O1.learn(docs, x)).orderBy("doc_id").collect() for x in (labels, turned))
    assert a == b


def test_votes_match_brute_force():
    rng = np.random.default_rng(0)
    m = O1.Model([], np.empty(0))
    m.vectors, m.labels = O1.unit(rng.standard_normal((60, 5))).astype(np.float32), rng.integers(0, 2, 60).astype(float)
    x = rng.standard_normal((20, 5)).astype(np.float32)
    for v, s in zip(O1.unit(x), m.score(x)):
        cos = m.vectors @ v
        near = np.argsort(-cos, kind="stable")[:O1.NEIGHBOURS]
        w = np.maximum(cos[near], 0).astype(float) ** O1.POWER
        assert s == pytest.approx((w @ m.labels[near]) / w.sum(), abs=1e-6)


def test_quality_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (20, 0, 0), (21, None, 0), (None, 1, 1), (12, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = O1.classify(edge_docs, O1.learn(edge_docs, labels)).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert O1.classify(no_docs, O1.learn(no_docs, labels)).count() == 0
    none = O1.classify(edge_docs, O1.learn(edge_docs, labels.limit(0)))
    assert {r.score for r in none.collect()} == {0.5}


# --- op5 ---------------------------------------------------------------------

def base_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    n, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            covered |= {i, i + 1, i + 2}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def check_base(rows, got):
    want = Counter((i, *base_counts(t)) for i, t in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got) == want
    assert not any(r.kept for r in got if r.base_failed)


def test_rules_base_counts_and_verdicts(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    got = O5.op5_weak_supervision(spark, SF001).collect()
    check_base([(r.doc_id, r.text) for r in docs.collect()], got)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    left = [(quality[r.doc_id], r.kept) for r in got if r.doc_id in quality and not r.base_failed]
    assert sum(k for q, k in left if q == 1) / sum(q == 1 for q, _ in left) > 0.97      # clean documents stay
    assert sum(not k for q, k in left if q == 0) / sum(q == 0 for q, _ in left) > 0.6


def test_rules_run_no_python(spark):
    plan = O5.op5_weak_supervision(spark, SF0001)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_estimate_matches_plain_em(spark):
    rng = np.random.default_rng(3)
    votes = rng.integers(-1, 2, (40, len(O5.RULES)))
    n = rng.integers(1, 30, 40)
    df = spark.createDataFrame([(*map(int, v), int(k)) for v, k in zip(votes, n)],
                               ", ".join([f"v{j} int" for j in range(len(O5.RULES))] + ["n long"]))
    e = O5.estimate(df, rounds=3)
    good, on_good, on_bad = O5.START_GOOD, [O5.START_ON_GOOD] * len(O5.RULES), [O5.START_ON_BAD] * len(O5.RULES)
    for _ in range(3):
        odds = np.full(40, np.log(good / (1 - good)))
        for j, (g, b) in enumerate(zip(on_good, on_bad)):
            for vote, x, y in ((1, g[0], b[0]), (0, g[1], b[1]), (-1, 1 - sum(g), 1 - sum(b))):
                odds[votes[:, j] == vote] += np.log(x / y)
        p = 1 / (1 + np.exp(-odds))
        good = ((p * n).sum() + O5.PSEUDO * O5.START_GOOD) / (n.sum() + O5.PSEUDO)
        for j in range(len(O5.RULES)):
            is_g, is_b = votes[:, j] == 1, votes[:, j] == 0
            g = O5._chances((p * n)[is_g].sum(), (p * n)[is_b].sum(), (p * n).sum(), O5.START_ON_GOOD)
            q = (1 - p) * n
            b = O5._chances(q[is_g].sum(), q[is_b].sum(), q.sum(), O5.START_ON_BAD)
            g = (g[0], min(g[1], O5.FALSE_ALARM))
            alarm = max(b[1], 2 * g[1])
            on_good = [*on_good[:j], g, *on_good[j + 1:]]
            on_bad = [*on_bad[:j], (min(max(b[0], O5.LEAST_GOOD_ON_BAD * g[0]), 1 - alarm - 1e-3), alarm), *on_bad[j + 1:]]
    assert e.good == pytest.approx(good)
    assert np.allclose(e.on_bad, on_bad) and np.allclose(e.on_good, on_good)
    assert set(e.accuracies()) == {r[0] for r in O5.RULES}


def test_rules_edges(edge_docs, no_docs):
    check_base([(r[0], r[1]) for r in EDGE], O5.judge(edge_docs).collect())
    assert O5.judge(no_docs).count() == 0


# --- op6 ---------------------------------------------------------------------

def plain_profile(texts, size=O6.PROFILE_SIZE):
    n = Counter()
    for t in texts:
        w = " " + " ".join("".join(c if c.isalpha() else " " for c in t.lower()).split()) + " "
        for k in (1, 2, 3):
            n.update(g for g in (w[i:i + k] for i in range(len(w) - k + 1)) if len(w) > 2 and g != " ")
    return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], [0] * (3 - len(x[0])) + [ord(c) for c in x[0]]))[:size]]


def test_language_held_out_accuracy_and_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    got = O6.op6_language_id(spark, SF0001).collect()
    assert all(r.held_out == is_held_out(r.doc_id) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) / len(held) > 0.95
    profiles = {lang: plain_profile([d.text for i, d in docs.items() if d.lang == lang and not is_held_out(i)])
                for lang in {d.lang for d in docs.values()}}
    for r in got[:40]:
        own = plain_profile([docs[r.doc_id].text])
        d = {lang: sum(abs(p.index(g) - i) if g in p else O6.PROFILE_SIZE for i, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(d), key=d.get)
        assert r.lang_pred == best
        assert r.score == pytest.approx(1 - d[best] / (O6.PROFILE_SIZE * len(own)))


def test_language_edges(spark, edge_docs, no_docs):
    profiles = O6.learn_profiles(edge_docs)
    got = {(r.doc_id, r.lang_pred, r.score) for r in O6.identify(edge_docs, profiles).collect()}
    for i in (1, 2, 3, 12):
        assert (i, "und", 0.0) in got
    assert O6.identify(edge_docs, profiles).count() == len(EDGE)
    assert {r.lang_pred for r in O6.identify(edge_docs, {}).collect()} == {"und"}
    assert O6.learn_profiles(no_docs) == {} and O6.identify(no_docs, {}).count() == 0
    kept = O6.keep_identified(spark, edge_docs, "")
    assert kept.columns == edge_docs.columns and {1, 2, 3, 12}.isdisjoint({r.doc_id for r in kept.collect()})


# --- op10 --------------------------------------------------------------------

def plain_base(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = [(i, label) for label, p in O10.BASE.items() for i in range(len(words)) if tuple(words[i:i + len(p)]) == p]
    return (len(words), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


TRICKY = ["CC  by\ncc-by; CC.BY all rights\treserved", "account by accc by cc bye", "éall rights reserved all rights reservedé",
          "GENERAL public: license general public licenses", "cc", "İcc by", "all rights reserved " * 50]


def test_license_base_matches_brute_force(spark, edge_docs):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = O10.op10_license_scan(spark, SF001).collect()
    want = {i: plain_base(t) for i, t in docs}
    assert all((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id] for r in got)
    assert all(set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score < 1 for r in got)
    scan = O10.Scanner.get().scan
    for t in [*TRICKY, LONG, None, ""]:
        assert scan(t)[:5] == plain_base(t), t[:40] if t else t


@pytest.mark.parametrize("text, labels", [
    ("Released under the MIT License.", "mit"), ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
    ("SPDX-License-Identifier: BSD-3-Clause", "bsd-3-clause"), ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
    ("under the GNU General Public License, version 3.", "gpl,gpl-3.0"), ("GNU Lesser General Public License v2.1", "gpl,lgpl-2.1"),
    ("see https://creativecommons.org/licenses/by-sa/3.0/", "cc-by-sa-3.0"), ("All rights reserved.", "reserved"),
    ("a permit limits the smithy", ""), (None, ""),
    ("BSD 3-Clause License", "bsd-3-clause"), ("Licensed under the BSD-3-Clause license.", "bsd-3-clause"),
    ("GPL-2.0-only", "gpl-2.0"), ("Apache-2.0", "apache-2.0"), ("MPL-2.0", "mpl-2.0"), ("LGPL-2.1+", "lgpl-2.1"),
    ("License: MIT", "mit"), ('"license": "ISC"', "isc"), ("SPDX-License-Identifier: (MIT OR Apache-2.0)", "apache-2.0,mit"),
    ("SPDX-License-Identifier: MIT-0", "mit-0"), ("MIT OR Apache-2.0", "apache-2.0"), ("license: MIT OR Apache-2.0", "apache-2.0,mit"),
    ("https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"), ("http://www.apache.org/licenses/LICENSE-2.0", "apache-2.0"),
    ("Permission is hereby granted, free of charge, to any person obtaining\n# a copy of this software and associated\n"
     "# documentation files (the \"Software\"), to deal", "mit"),
    (" * Redistribution and use in source and binary forms, with or without\n * modification, are permitted", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
     "Free Software Foundation; either version 2 of the License", "gpl,gpl-2.0"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software", "bsd-3-clause"),
    ("The origin of this software must not be misrepresented;", "zlib"), ("version 2.0 of the apache-2.0.1 tool", ""),
    ("3 clause by clause, bsd-like; the mit of the license", ""),
])
def test_license_labels(text, labels):
    assert O10.Scanner.get().scan(text)[5] == labels


def test_containment_and_priority():
    assert len(O10.RULES) > 300
    s = O10.Scanner.get()
    text = "licensed under the apache license, version 2.0"
    found = s.detections(text, set(range(len(O10.RULES))))
    assert [(text[a:b], p) for a, b, p, _ in found] == [(text, 2)]        # the name inside is suppressed


PATTERNS = [re.compile(r.pattern) for r in O10.RULES]       # more than re remembers


def test_keywords_gate_no_match_away():
    """A rule's pattern never matches a text without its keywords."""
    s = O10.Scanner.get()
    for text in ("Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "GPLv2 license", "the ISC license", "cc0 1.0",
                 "Dual-licensed under MPL 2.0", "placed in the public domain", "Copyright (c) 2021", "zlib license"):
        low = text.lower()
        hit = {i for _, (_, own) in s.keywords.iter(low) for i in own}
        for i, r in enumerate(O10.RULES):
            if PATTERNS[i].search(low):
                assert i in hit, (text, r)


GATED = ("GNU General Public License version 2", "GNU Lesser General Public License v2.1", "GNU Library General Public License 2.0",
         "MIT License", "MIT-style license", "licensed by MIT", "distributed with MIT", "released under a MIT", "MIT no attribution license",
         "ISC-style license", "published under terms of ISC", "SIL Open Font License", "GNU Free Documentation License 1.3",
         "Common Development and Distribution License", "Common Public License", "Server Side Public License",
         "European Union Public License", "Python Software Foundation License", "Do what the fuck you want to public license",
         "Open Database License", "Open Data Commons Attribution License", "Public Domain Dedication and License",
         "Open Software License", "CC BY-SA 4.0", "licensed under CC BY NC 3.0", "placed in the public domain")


@pytest.mark.parametrize("gap", [" ", "\n", "\t", "  ", "\r\n", " \n\t "])
def test_white_space_gates_no_match_away(gap):
    s = O10.Scanner.get()
    assert not any(c.isspace() for r in O10.RULES for k in r.keywords for c in k)
    for text in GATED:
        low = text.lower().replace(" ", gap)
        hit = {i for _, (_, own) in s.keywords.iter(low) for i in own}
        match = {i for i, p in enumerate(PATTERNS) if p.search(low)}
        assert match <= hit and (match or "cc" in low), (low, match - hit)
    assert s.scan("GNU General\nPublic License version 2")[5] == "gpl,gpl-2.0"
    assert s.scan("an MIT-style license")[5] == s.scan("licensed by MIT")[5] == "mit"


def test_license_edges(edge_docs, no_docs):
    got = O10.scan_licenses(edge_docs).collect()
    assert len(got) == len(EDGE)
    assert next(r for r in got if r.doc_id == 13).labels == "cc-by,cc-by-nc-4.0,reserved"
    assert O10.scan_licenses(no_docs).count() == 0
    assert row(1, None)[1] is None


def test_every_sentence_is_found_through_its_keyword():
    s = O10.Scanner.get()
    for label, words in O10.SENTENCES:
        text = " ".join(t.split("|")[0] for t in words.split() if t[0] != "<")
        for gap in (" ", "\n// ", ", "):
            assert label in s.scan("x " + text.replace(" ", gap).upper() + " y")[5].split(","), (label, text)
