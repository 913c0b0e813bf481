"""Near vectors against all pairs."""

import numpy as np
import pytest

from ledgerlens.llm import near_vectors as N

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, threshold=0.95):
    ok = [bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [N.units(np.array([v]))[0] if k else None for (_, v), k in zip(rows, ok)]
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and float((unit[i] * unit[j]).sum()) >= threshold:
                links[i] += 1
                links[j] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), k) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((k, links[i], least[find(i)], k == least[find(i)]) for i, (k, _) in enumerate(rows)), key=str)


def check(df, rows):
    got = N.near_vectors(df)
    assert got.columns == [df.columns[0], "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def clusters(seed, d, sizes, noise):
    rnd = np.random.default_rng(seed)
    rows = []
    for n, s in zip(sizes, noise):
        centre = rnd.normal(size=d)
        for _ in range(n):
            rows.append((int(len(rows) * 7 % 1009), (N.units(centre[None])[0] + rnd.normal(size=d) * s / np.sqrt(d)).tolist()))
    return rows


@pytest.mark.parametrize("seed,tile,ball", [(1, 2048, 32), (2, 70, 16), (3, 70, 1000)])
def test_groups_of_all_sizes(spark, monkeypatch, seed, tile, ball):
    """A large tight group, loose ones whose pairs lie around the threshold, small ones and single vectors;
    small tiles split buckets, with balls and without."""
    monkeypatch.setattr(N, "TILE", tile)
    monkeypatch.setattr(N, "BALL", ball)
    monkeypatch.setattr(N, "PACK", 200)
    rows = clusters(seed, 32, [250, 90, 60] + [3] * 20 + [1] * 60, [0.1, 0.2, 0.225] + [0.15] * 20 + [0] * 60)
    want = {r[0]: r for r in brute(rows)}
    got = {r.vec_id: tuple(r) for r in N.near_vectors(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert sum(g[1] for g in got.values()) >= 0.998 * sum(w[1] for w in want.values())
    assert all(g[1] <= want[k][1] for k, g in got.items())  # no pair below the threshold, none counted twice
    tight = [k for k, w in want.items() if w[1] >= 249 and got[k][1] == w[1]]
    assert len(tight) >= 250 and sum(got[k] == want[k] for k in want) >= 0.95 * len(want)


def test_nulls_zero_vectors_lengths_scales_and_repeats(spark):
    v = [0.3, -0.2, 0.9, 0.1]
    rows = [(5, v), (3, v), (3, v), (9, [x * 1e-200 for x in v]), (8, [x * 1e200 for x in v]), (None, v), (1, None), (2, []), (4, [0.0, -0.0, 0.0, 0.0]), (6, [1.0, None, 0.0, 0.0]),
            (7, [float("nan"), 1.0, 0.0, 0.0]), (10, [float("inf"), 1.0, 0.0, 0.0]), (11, [-x for x in v]), (12, v + [0.0]), (None, [0.0, 1.0, 0.0, 0.0]), (13, [2.0]), (14, [5.0]), (15, [-1.0]),
            (16, [0.0, 0.0, 1.0, 0.0]), (17, [-0.0, 0.0, 1.0, 0.0]), (None, None)]
    df = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in rows], "vec_id long, embedding array<double>, node long, key long, ball long")
    check(df.select("vec_id", "embedding", "node", "key", "ball"), rows)


def test_empty_table_and_other_types(spark):
    assert N.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, [1, 2, 3]), (2, [2, 4, 6]), (3, [3, -1, 0])]
    check(spark.createDataFrame(rows, "vec_id int, embedding array<int>"), rows)


def test_pairs_at_the_threshold(spark):
    exact = [[0.0] * 4, [0.0] * 4, [0.0] * 4]
    exact[0][0], exact[1][0], exact[1][1], exact[2][0], exact[2][2] = 1.0, 19.0, float(np.sqrt(39)), 19.0, float(np.sqrt(39.001))
    check(spark.createDataFrame(list(enumerate(exact)), SCHEMA), list(enumerate(exact)))


def test_recall_of_the_tables():
    """All tables together find at least 0.99 of the pairs at the threshold itself."""
    rnd = np.random.default_rng(5)
    for d, n in ((8, 1000), (64, 500), (64, 50_000), (100, 10**7)):
        h = N.planned(d, n, 0.95)
        x = N.units(rnd.normal(size=(1500, d)))
        z = rnd.normal(size=(1500, d))
        z = N.units(z - (z * x).sum(1, keepdims=True) * x)
        a, b = h.codes(x), h.codes(N.units(0.95 * x + np.sqrt(1 - 0.95 ** 2) * z))
        assert np.mean(np.any([N._meet(a[:, t], b[:, t]) for t in range(h.tables)], 0)) >= 0.99


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    check(df, [(r[0], list(r[1])) for r in df.collect()])
