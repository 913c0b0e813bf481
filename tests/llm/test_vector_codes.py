"""Vector codes against plain nearest-entry search over all entries."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from ledgerlens.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows):
    ok = [(i, [math.floor(1024 * x) for x in v], v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not ok:
        return []
    lengths = collections.Counter(len(v) for _, v, _, _ in ok)
    d = max(lengths, key=lambda n: (lengths[n], n))
    ok = [x for x in ok if len(x[1]) == d]
    cut = [0]
    for p in range(4):
        cut.append(cut[-1] + d // 4 + (p < d % 4))
    part = lambda v, p: v[cut[p]:cut[p + 1]]
    first = sorted(ok, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:256]
    books = [[part(r[1], p) for r in first] for p in range(4)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(4):
        for p in range(4):
            held = collections.defaultdict(list)
            for _, v, _, _ in ok:
                held[nearest(part(v, p), books[p])[1]].append(part(v, p))
            for e, xs in held.items():
                books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, by_label = [], collections.Counter()
    for i, v, _, label in ok:
        found = [nearest(part(v, p), books[p]) for p in range(4)]
        error = sum(x for x, _ in found)
        by_label[label] += error
        out.append((i, label, "".join(f"{e:02x}" for _, e in found), error))
    long = lambda x: x if x < 1 << 63 else None
    return sorted(((*r[:3], long(r[3]), long(by_label[r[1]]), digest) for r in out), key=str)


def check(spark, rows, schema=SCHEMA):
    got = V.vector_codes(spark.createDataFrame(rows, schema).repartition(3))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_more_vectors_than_entries(spark, monkeypatch):
    monkeypatch.setattr(V, "_FAN_IN", 2)  # partial sums are merged in several steps
    rnd = random.Random(1)
    centres = [[rnd.gauss(0, 0.2) for _ in range(16)] for _ in range(20)]
    rows = [(i, [float(np.float32(c + rnd.gauss(0, 0.05))) for c in rnd.choice(centres)], rnd.choice([0, 1, None])) for i in range(400)]
    check(spark, rows)


def test_ties_repeats_nulls_and_unusable_vectors(spark):
    grid = [[float(a), float(b), float(a), float(-b)] for a in (0, 1) for b in (0, 1)]
    rows = [(i % 7, grid[i % 4], i % 3) for i in range(30)] + [(None, [0.5, 0.5, 0.5, 0.5], None)]
    rows += [(90, None, 1), (91, [], 1), (92, [1.0, None, 0.0, 0.0], 1), (93, [float("nan"), 0.0, 0.0, 0.0], 1), (94, [float("-inf"), 0.0, 0.0, 0.0], None), (95, [1.0] * 5, 1)]
    check(spark, rows)


@pytest.mark.parametrize("d", [1, 2, 7])
def test_lengths_that_are_no_multiple_of_the_parts(spark, d):
    rnd = random.Random(d)
    check(spark, [(i, [rnd.uniform(-1, 1) for _ in range(d)], None) for i in range(20)])


@pytest.mark.parametrize("size", [1e5, 1e9, 1e300])
def test_large_components_stay_exact(spark, size):
    rnd = random.Random(0)
    rows = [(i, [rnd.uniform(-size, size) if j % 3 else rnd.uniform(-1, 1) for j in range(8)], i % 2) for i in range(12)]
    check(spark, rows + [(99, [1e-320, -1e-320, 0.0, -0.0] * 2, 0)])


def test_floats_and_columns_with_clashing_names(spark):
    rows = [(i, [0.1 * i, -0.3, 0.7, 1 / 3], 0) for i in range(6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    exact = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    for c in ("id", "v", "code", "error", "label_error"):
        df = df.withColumn(c, df.embedding)
    assert sorted((tuple(r) for r in V.vector_codes(df).collect()), key=str) == brute(exact)


def test_no_rows(spark):
    assert V.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert V.vector_codes(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


def test_orchard_search_looks_at_fewer_entries():
    """On vectors near their entries the walk ends early, and finds what the full search finds."""
    rnd = np.random.default_rng(0)
    entries = rnd.integers(-1024, 1024, (256, 4))
    book = V.Codebook(entries)
    x = entries[rnd.integers(0, 256, 500)] + rnd.integers(-20, 20, (500, 4))
    full = ((x[:, None] - entries[None]) ** 2).sum(2)
    code, error = book.nearest(x)
    assert (code == full.argmin(1)).all() and (error == full.min(1)).all()
    measured = []
    plain = V.Codebook._squares
    V.Codebook._squares = staticmethod(lambda diff: measured.append(len(diff)) or plain(diff))
    try:
        book.nearest(x)
    finally:
        V.Codebook._squares = staticmethod(plain)
    assert sum(measured) < 0.5 * full.size
