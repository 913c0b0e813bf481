"""Neighbour voting: held-out accuracy, exact neighbours, edge cases."""

import zlib

import numpy as np
import pytest

from ledgerlens.llm import knn_quality as K


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = K.quality_scores(docs, labels)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == docs.count()
    test = [(r.quality, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    y, s = np.array([q for q, _ in test]), np.array([r.score for _, r in test])
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for k, r in got.items())
    right = np.mean([q == r.predicted for q, r in test])
    print("held out", len(test), "auc", auc(y, s), "accuracy", right)
    assert auc(y, s) > 0.95 and right > 0.95


def test_neighbours_are_exact_and_blocks_do_not_matter():
    rnd = np.random.default_rng(0)
    counts = rnd.poisson(0.02, (300, K.TERMS)).astype(np.float32)
    space = K.Space(counts, (np.arange(300) % 3 > 0).astype(float), 20)
    x = rnd.poisson(0.02, (50, K.TERMS)).astype(np.float32)
    whole = space.scores(x)
    assert whole == pytest.approx(np.concatenate([space.scores(x[i:i + 7]) for i in range(0, 50, 7)]), rel=1e-4)
    v = space.project(x)
    for i in range(50):
        cos = v[i].astype(np.float64) @ space.vectors.astype(np.float64).T
        near = np.argsort(-cos)[: K.NEIGHBOURS]
        w = np.maximum(0, cos[near]) ** 4
        assert whole[i] == pytest.approx((w @ space.labels[near] + 0.01 * space.prior) / (w.sum() + 0.01), rel=1e-3)


def test_directions_are_the_leading_singular_vectors():
    rnd = np.random.default_rng(1)
    counts = rnd.poisson(0.05, (120, K.TERMS)).astype(np.float32)
    space = K.Space(counts, np.ones(120), 5)
    x = K.weighted(counts, space.idf)
    exact = np.linalg.svd(x, compute_uv=False)[:5]
    assert np.linalg.norm(x @ space.directions, axis=0) == pytest.approx(exact, rel=0.02)


def test_counts_do_not_depend_on_the_slice(spark):
    import pyarrow as pa

    texts = ["One two two.", "", "ÉÉ é $$$ 12\nline two", "x", "One two two."]
    raw, off = K.T.text_buffers(pa.array(texts))
    together = K.term_counts(raw, off)
    for i in range(5):
        r, o = K.T.text_buffers(pa.array(texts[i:i + 1]))
        assert (K.term_counts(r, o)[0] == together[i]).all()


def test_nulls_empty_repeats_and_other_columns(spark):
    texts = ["good text about things number %d" % i for i in range(30)] + ["###$$$ %%% junk" * 3] * 10
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(100, None, 1, "x"), (101, "", 1, "x"), (None, texts[0], 1, "x"), (0, texts[0], 1, "x"), (102, "w " * 30000, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int, l_id string")
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(40)] + [(0, 1, 1), (0, None, 0), (None, 1, 0), (999, 0, 0), (100, 1, 0)], "doc_id long, quality int, toxic int")
    got = K.quality_scores(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[100].score == by_id[101].score and by_id[35].score < 0.5 < by_id[3].score


def test_no_labels_and_empty_table(spark):
    docs, labels = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in K.quality_scores(docs, labels).collect()] == [0.5]
    assert K.quality_scores(docs.limit(0), labels).count() == 0
