"""Texts several times longer than any of the test tables: every word of them counts."""

import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import corpus_pipeline as CP
import test_interpolation_lm
import test_license_rules
import test_ngram_join
from ledgerlens.llm import knn_quality

PAIR = "doc_id long, text string"


def long_words(n, seed):
    rnd = random.Random(seed)
    return ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(n)]


def test_jaccard_of_long_texts(spark):
    a = long_words(120_000, 1)
    near, far = list(a), list(a)
    near[::50] = long_words(2_400, 2)  # one word in 50 differs: 0.82
    far[::30] = long_words(4_000, 3)  # 0.71
    rows = [(3, " ".join(a)), (1, " ".join(near)), (2, " ".join(far)), (4, "a short one of six words"), (5, " ".join(a[:20_000]))]
    want = dict((k, c) for k, _, c, _ in test_ngram_join.brute(rows))
    assert want[3] == want[1] == 1 and want[2] == 2
    test_ngram_join.check(spark.createDataFrame(rows, PAIR), rows)


def test_interpolation_of_long_texts(spark):
    vocabulary = long_words(3_000, 4)
    rnd = random.Random(5)
    rows = [(k, " ".join(rnd.choices(vocabulary, k=150_000 if k == 2 else 60))) for k in range(40)] + [(100, " ".join(rnd.choices(vocabulary, k=80_000)))]
    test_interpolation_lm.check(spark.createDataFrame(rows, PAIR), rows)


def test_quality_of_long_texts(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{d}/labels.parquet")
    space = knn_quality.fitted_space(docs, labels)
    texts = [" ".join(long_words(200_000, 6)), " ".join(["# $ % &"] * 100_000), " ".join(long_words(100_000, 7)) + " ####" * 100_000]
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], PAIR)
    got = {r.doc_id: r.score for r in knn_quality.quality_scores(docs.unionByName(more), labels).where("doc_id < 0").collect()}
    for i, t in enumerate(texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        counts = knn_quality.term_counts(raw, np.array([0, len(raw)]))
        assert counts[0, :knn_quality._WORDS].sum() == len(t.split())
        assert got[-1 - i] == pytest.approx(space.scores(counts)[0], rel=1e-3)


def test_license_scan_of_a_long_text(spark):
    w = long_words(60_000, 8)
    for i, x in enumerate(("all rights reserved", "SPDX-License-Identifier: MIT", "Licensed under CC BY 4.0", "GNU General Public License, version 3", "see the LICENSE file")):
        for at in range(500 * i + 7, len(w), 12_000):
            w[at] = x
    rows = [(1, " ".join([*w, "released under MPLv2.0"])), (2, " ".join(w[:200])), (3, None)]
    test_license_rules.check(spark.createDataFrame(rows, PAIR), rows)


def test_pipeline_on_long_texts(spark, tmp_path):
    a, b = long_words(100_000, 9), long_words(100_000, 10)
    near = [*a]
    near[::100] = long_words(1_000, 11)
    item = "alpha beta gamma delta epsilon zeta"
    line = "a line that stands on the pages of many sites"
    rows = [(1, " ".join(a)), (2, " ".join(near)), (3, " ".join([*b, item])), (4, " ".join(b[:50_000]) + "\n" + line), (5, " ".join(["same words again and"] * 20_000))]
    rows += [(10 + i, " ".join(long_words(30, 20 + i)) + "\n" + line) for i in range(12)]
    docs = spark.createDataFrame([(k, t, "en", f"site{k}", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in CP.run(spark, str(tmp_path)).collect()}
    # 2 is a near copy of 1, 3 ends with the item, 5 repeats itself; the line stays in 4, its first document
    assert set(got) == {1, 4, *range(10, 22)}
    assert all(r.round_trip and r.parity for r in got.values()) and got[1].n_tokens > 100_000
    assert got[4].n_tokens > 50_000 and max(got[k].n_tokens for k in range(10, 22)) < 400
