"""Interpolation model against counts made with plain Python."""

import collections
import math
import zlib

import numpy as np
import pyarrow.compute as pc
import pytest

from ledgerlens.llm import interpolation_lm as L, ngram_join

A_Z = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    """score and base of each row from plain counters; the weights by the module's own EM."""
    uni, uni_f, bi, bi_f, ctx, ctx_f = (collections.Counter() for _ in range(6))
    toks = []
    for doc_id, text in rows:
        r = zlib.crc32((str(doc_id) if doc_id is not None else "").encode()) % 10
        t = [*(text or "").translate(A_Z).encode().split(), 0]
        pairs = list(zip(["<s>", *t], t))
        toks.append((r, t, pairs))
        if r != 0:
            uni.update(t), bi.update(pairs), ctx.update(v for v, _ in pairs)
        if r == 1:
            uni_f.update(t), bi_f.update(pairs), ctx_f.update(v for v, _ in pairs)
    n, n_f, size = sum(uni.values()), sum(uni_f.values()), len(uni)
    cells = collections.Counter()
    for r, _, pairs in toks:
        if r == 1:
            for v, w in pairs:
                c = ctx[v] - ctx_f[v]
                two = (bi[v, w] - bi_f[v, w]) / c if c else 0
                one = (uni[w] - uni_f[w]) / max(1, n - n_f)
                cells[(int(L.bucket_of(c)) * L._BINS + int(L.probability_bin(two))) * L._BINS + int(L.probability_bin(one))] += 1
    weights = L.learn_weights(np.array(list(cells), dtype=np.int64), np.array(list(cells.values()), dtype=float), size)
    out = []
    for r, t, pairs in toks:
        score = 0
        for v, w in pairs:
            l2, l1, l0 = weights[int(L.bucket_of(ctx[v]))]
            score += math.log10(l2 * (bi[v, w] / ctx[v] if ctx[v] else 0) + l1 * uni[w] / max(1, n) + l0 / (size + 1))
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (size + 1))) for w in t)
        out.append((r == 0, len(t), sum(uni[w] > 0 for w in t), n, base, score))
    return out, weights


def check(df, rows, **kw):
    got = collections.defaultdict(list)
    for r in L.interpolated_scores(df, **kw).collect():
        got[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    want, _ = brute(rows)
    assert sum(map(len, got.values())) == len(rows)
    for (doc_id, _), w in zip(rows, want):
        best = min(got[doc_id], key=lambda g: abs(g[4] - w[4]) + abs(g[1] - w[1]))
        got[doc_id].remove(best)
        assert best[:4] == w[:4], (doc_id, best, w)
        assert best[4:] == pytest.approx(w[4:], rel=1e-6, abs=1e-6), (doc_id, best, w)


@pytest.mark.parametrize("head", [1 << 18, 40, 0])
def test_scores_match_plain_counts(spark, head):
    """Whether all, a few or no words count as frequent, the scores are the same."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(df, [tuple(r) for r in df.collect()], head_words=head)


@pytest.mark.parametrize("head", [1 << 18, 40])
def test_dealing_in_steps_gives_the_same_scores(spark, monkeypatch, head):
    """Buckets and groups that are reached in three steps; the counts and scores stay those of plain counters."""
    monkeypatch.setattr(ngram_join, "FAN", 2)
    monkeypatch.setattr(L, "_BUCKET", 1500)
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(40)
    rows = [tuple(r) for r in df.collect()] + [(None, "a b"), (5, None), (6, ""), (6, "")]
    assert len(L.deal_steps(-(-sum(len((t or "").split()) + 1 for _, t in rows) // 1500))) >= 3
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows, head_words=head)


def test_a_long_text_is_one_row_of_its_flush(spark):
    rows = [(1, " ".join(f"w{i % 997} x" for i in range(400_000))), (2, "w1 x w2"), (11, "w3 x " * 10)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


@pytest.mark.parametrize("buckets", [8, 64, 4096])
def test_rows_of_a_step_do_not_grow_with_the_buckets(buckets):
    """A partition of one bucket of the step before sends at most FAN rows on for each flush."""
    rng = np.random.default_rng(1)
    w = rng.integers(1 << 62, 1 << 63, 20_000).astype(np.uint64) | L._TOP
    at, d = np.zeros(len(w), np.int8), np.zeros(len(w), np.uint32)
    rows, most = [L.pa.Table.from_batches(L._pair_rows(np.array([[0, k]]), at, w, w, d, 8, L.pa.int64())) for k in range(3)], 8
    mine = [b for t in rows for b in t.filter(pc.equal(t["p"], 3)).to_batches()]
    out = list(L._redeal_fn(buckets)(mine))
    assert len(out) <= buckets // most and all(b.column("p")[0].as_py() * most // buckets == 3 for b in out)
    assert sum(len(b.column("d")[0].as_py()) for b in out) == sum(len(x) for b in mine for x in b.column("d").to_pylist())


def test_nulls_empty_texts_repeats_and_other_columns(spark):
    rows = [(1, "a b a b"), (2, None), (3, ""), (4, "  \t\n "), (None, "a b"), (5, "B a É é"), (5, "B a É é"), (5, "other"), (6, "x " * 5000), (7, "a"), (11, "b b a")]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, score int, uid int")
    check(df, rows)


def test_empty_table(spark):
    assert L.interpolated_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_learned_probabilities_sum_to_one():
    cells = np.arange(0, L._BUCKETS * L._BINS * L._BINS, 977)
    weights = L.learn_weights(cells, np.ones(len(cells)), 100)
    assert weights.sum(axis=1) == pytest.approx(1)
    assert weights[0, 0] == 0


def dealt_scores(monkeypatch, texts, partition, head, buckets=3):
    """(part, seq, doc) -> (id, score without the rare words' parts, rare occurrences) of one scan partition."""
    context = type("Context", (), {"get": staticmethod(lambda: type("Task", (), {"partitionId": lambda self: partition})())})
    monkeypatch.setattr(L, "TaskContext", context)
    monkeypatch.setattr(L, "_FLUSH", 8)  # several flushes
    monkeypatch.setattr(L.T, "received", lambda shared: shared)
    batches = [L.pa.RecordBatch.from_arrays([L.pa.array([i]), L.pa.array([2]), L.pa.array([t], L.pa.string())], ["id", "r", "text"]) for i, t in enumerate(texts)]
    weights = np.full((L._BUCKETS, 3), 1 / 3)
    rows = [r for b in L._deal_fn(head, buckets, 50, 9)(batches) for r in b.to_pylist()]
    out, rare = [], []
    for q in range(buckets):
        out += list(L._score_fn(head, weights, 50, 9, buckets)([r for r in rows if r["p"] == q]))
    names = L._SUM_NAMES
    known = {}
    for g in sorted({r[0] for r in out if r[1] < 2}):
        mine = [dict(zip(names, r)) for r in out if r[0] == g]
        t = L._sum_fn(L.pa.Table.from_pylist(mine, L.pa.schema(
            [("g", L.pa.int32()), ("kind", L.pa.int32()), *((n, L.pa.binary()) for n in "abc"), ("flushes", L.pa.binary()), ("ids", L.pa.list_(L.pa.int64()))])))
        known |= {(r["part"], r["seq"], r["doc"]): (r["id"], r["n_tokens"], r["score"]) for r in t.to_pylist()}
    tail = [dict(zip(names, r)) for r in out if r[1] == 2]
    if tail:
        for b in L._tail_fn(weights)([L.pa.RecordBatch.from_pylist(tail)]):
            rare += [(r["part"], r["seq"], r["doc"], r["w"], round(r["two"], 9)) for r in b.to_pylist()]
    return known, sorted(rare)


@pytest.mark.parametrize("partition", [4097, 1 << 20, (1 << 31) - 1])
@pytest.mark.parametrize("frequent", [0, 2])
def test_any_partition_number_gives_the_same_scores(monkeypatch, partition, frequent):
    texts = ["a b a b c", "d e", None, "", "a b f g h i j", "b a b a", "k " * 20, "c a"]
    words = np.unique(L._tokens(*L.T.text_buffers(L.pa.array(texts)))[0])[:frequent]
    head = L._Head(words, np.full(frequent, 5), np.zeros(frequent), 8, 0)
    first, first_rare = dealt_scores(monkeypatch, texts, 0, head)
    known, rare = dealt_scores(monkeypatch, texts, partition, head)
    assert sorted(v[0] for v in known.values()) == list(range(len(texts))) and len({k[1] for k in known}) > 2
    assert known.keys() == {(partition, *k[1:]) for k in first} and rare == [(partition, *r[1:]) for r in first_rare] and rare
    for k, v in first.items():
        assert known[(partition, *k[1:])] == pytest.approx(v, rel=1e-5)
