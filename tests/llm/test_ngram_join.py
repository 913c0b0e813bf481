"""Jaccard join against all pairs in plain Python."""

import collections
import random

import pytest

from ledgerlens.llm import ngram_join as J

A_Z = {c: c + 32 for c in range(65, 91)}


def brute(rows, size=5):
    sets = []
    for _, text in rows:
        w = (text or "").translate(A_Z).encode().split()
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    holders = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        both = collections.Counter(j for g in s for j in holders[g] if j != i)
        for j, m in both.items():
            if 100 * m >= 80 * (len(s) + len(sets[j]) - m):
                links[i] += 1
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (k, _) in enumerate(rows):
        ids = [x for x in (least.get(find(i)), k) if x is not None]
        least[find(i)] = min(ids) if ids else None
    return sorted(((k, len(s), least[find(i)] if s else k, links[i]) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=str)


def check(df, rows):
    got = sorted((tuple(r) for r in J.jaccard_components(df).select("doc_id", "n_shingles", "component_id", "n_links").collect()), key=str)
    assert got == brute(rows)


def test_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(df, [tuple(r) for r in df.collect()])


@pytest.mark.parametrize("seed,tile,common", [(1, 400_000, 8), (2, 500, 8), (3, 2000, 2)])
def test_near_copies_near_the_threshold(spark, monkeypatch, seed, tile, common):
    """Chains of edited copies of all sizes, many of them close to 0.8, sharing passages; small tiles split the components."""
    monkeypatch.setattr(J, "TILE", tile)
    monkeypatch.setattr(J, "_COMMON_IN_RUN", common)
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(3000)
    passage = [word() for _ in range(30)]
    rows, k = [], 0
    for n in [1, 2, 4, 5, 6, 7, 9, 12, 20, 35, 60, 90, 150, 400]:
        base = [word() for _ in range(n)]
        for _ in range(12):
            copy = list(base)
            for _ in range(rnd.randrange(0, 1 + max(1, n // 30))):
                copy[rnd.randrange(len(copy))] = word()
            if rnd.random() < 0.3:
                copy = copy + passage[: rnd.randrange(30)]
            rows.append((k, " ".join(copy)))
            k += 1
            if rnd.random() < 0.3:
                base = copy
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), rows)


def test_nulls_empty_texts_repeats_and_other_columns(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (5, "A  B\nC"), (5, "A  B\nC"), (6, "a b c d"), (None, "a b c"), (None, "only here"), (7, "x " * 3000), (8, "é É ü"),
            (7, "other text with the id of seven")]
    df = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], "doc_id long, text string, n long, node long, comp long")
    check(df, rows)


def test_empty_table(spark):
    assert J.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_linked_pair_shares_a_key():
    """Whatever counts as common, two sets at the threshold share a key."""
    import numpy as np

    rnd = np.random.default_rng(0)
    for n in (5, 9, 10, 17, 40, 81, 163, 500, 1200):
        for _ in range(30):
            d = int((n + n) / 9)
            x = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
            y = np.concatenate((x[: n - d // 2], rnd.integers(0, 1 << 63, d - d // 2, dtype=np.uint64)))
            shared = J.Common(rnd.choice(x, n // 3, replace=False), np.full(n // 3, 9))
            x, y = np.unique(x), np.unique(y)
            both = len(np.intersect1d(x, y))
            if 100 * both < 80 * (len(x) + len(y) - both):
                continue
            for common in (shared, J.Common(np.zeros(0, np.uint64), np.zeros(0, int))):
                k, node = J.block_keys(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]), np.array([1, 2]), J.Fraction(4, 5), common)
                assert len(np.intersect1d(k[node == 1], k[node == 2])), (n, d)


def test_a_full_tile_of_short_near_copies_keeps_no_pairs():
    """8,000 rows of 9 shingles that differ in one: all 32 million pairs link, in little memory."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n = 8_000
    sets = [np.sort(np.append(np.arange(1, 9, dtype=np.uint64), np.uint64(100 + i))).tobytes() for i in range(n)]
    t = pa.table({"across": pa.array([False] * n), "node": pa.array(range(n), pa.int64()), "side": pa.array([0] * n), "copies": pa.array([1] * n, pa.int64()), "items": pa.array(sets, pa.binary())})
    tracemalloc.start()
    out = J._tile_fn(J.Fraction(4, 5))(t)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    got = out.to_pydict()
    assert sorted(x for x, y, k in zip(got["a"], got["b"], got["links"]) if k == n - 1) == list(range(n))
    assert sum(1 for x, y in zip(got["a"], got["b"]) if x != y) == n - 1
    assert peak < 100e6


def test_dealing_in_steps(spark, monkeypatch):
    monkeypatch.setattr(J, "FAN", 3)
    monkeypatch.setattr(J, "_BUCKET", 40)
    monkeypatch.setattr(J, "_FLUSH", 300)
    assert J.deal_steps(1) == [1] and J.deal_steps(3) == [3] and J.deal_steps(20) == [3, 9, 27] and J.deal_steps(7) == [3, 9]
    rnd = random.Random(9)
    base = [["w%d" % rnd.randrange(500) for _ in range(60)] for _ in range(25)]
    rows = []
    for k in range(120):
        words = list(rnd.choice(base))
        words[rnd.randrange(60)] = "x%d" % rnd.randrange(9)
        rows.append((k, " ".join(words)))
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def test_size_classes_of_a_large_component(spark, monkeypatch):
    """A chain of growing texts: one component over many size classes, tiled by class and rows."""
    monkeypatch.setattr(J, "TILE", 300)
    monkeypatch.setattr(J, "TILE_ROWS", 8)
    words = ["w%d" % i for i in range(700)]
    rows = [(k, " ".join(words[: 20 + 4 * k])) for k in range(160)] + [(500 + k, " ".join(words[:200] + ["y%d" % k])) for k in range(20)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


def test_very_long_texts(spark):
    rnd = random.Random(4)
    words = ["w%d" % rnd.randrange(10**6) for _ in range(150_000)]
    other = words[:-20_000] + ["z%d" % i for i in range(10_000)]
    rows = [(1, " ".join(words)), (2, " ".join(other)), (3, " ".join(words[:75_000]))]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_pairs_of_unlike_sizes_at_the_threshold_share_a_key():
    """Sizes up to n / t and across size classes, with as few columns in common as the threshold lets them have."""
    import numpy as np

    rnd = np.random.default_rng(1)
    tried = 0
    for t in (J.Fraction(4, 5), J.Fraction(1, 2), J.Fraction(1, 1)):
        for a in [*range(1, 30), 49, 50, 77, 78, 97, 120, 121, 188, 189, 294, 460, 717, 718, 1000]:
            for b in {a, int(a / t), *rnd.integers(a, int(a / t) + 1, 4).tolist()}:
                both = -(-t.numerator * (a + b) // (t.numerator + t.denominator))
                x = np.unique(rnd.integers(0, 1 << 63, a, dtype=np.uint64))
                y = np.unique(np.append(x[rnd.permutation(a)[:both]], rnd.integers(0, 1 << 63, max(0, b - both), dtype=np.uint64)))
                if both > a or (len(x), len(y)) != (a, b):
                    continue
                for common in (J.Common(x[: a // 3], np.full(a // 3, 9)), J.Common(np.zeros(0, np.uint64), np.zeros(0, int))):
                    k, node = J.block_keys(np.concatenate((x, y)), np.array([0, a, a + b]), np.array([1, 2]), t, common)
                    assert len(np.intersect1d(k[node == 1], k[node == 2])), (t, a, b)
                    tried += 1
    assert tried > 600


def test_a_set_sends_keys_for_two_fifths_of_its_shingles_at_most():
    import numpy as np

    rnd = np.random.default_rng(2)
    sizes = np.arange(100, 1500, 7)
    values = np.concatenate([np.unique(rnd.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)) for n in sizes])
    off = np.concatenate(([0], np.cumsum(sizes)))
    keys, node = J.block_keys(values, off, np.arange(len(sizes)), J.Fraction(4, 5), J.Common(np.zeros(0, np.uint64), np.zeros(0, int)))
    assert set(node) == set(range(len(sizes)))
    assert len(keys) <= J._KEYS_EACH * len(values)


def near_rows(n, words, seed):
    rnd = random.Random(seed)
    base = [["w%d" % rnd.randrange(5000) for _ in range(words)] for _ in range(n // 5)]
    rows = []
    for k in range(n):
        text = list(rnd.choice(base))
        text[rnd.randrange(words)] = "x%d" % rnd.randrange(9)
        rows.append((k, " ".join(text)))
    return rows


def test_more_buckets_than_fan_are_dealt_at_once_while_rows_hold_many_keys(spark, monkeypatch):
    """Each step writes all keys again; one of many buckets is taken as long as a flush fills its rows."""
    def again(buckets):
        raise AssertionError("dealt twice")

    rows = near_rows(100, 60, 5)
    monkeypatch.setattr(J, "_redeal_fn", again)
    monkeypatch.setattr(J, "_BUCKET", 14)  # some 150 buckets
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)


def shuffle_bytes(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName(): f.length() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def test_no_job_leaves_its_shuffle_files_to_the_next(spark):
    """Keys and sets that were dealt are on no disk when the components are known; each job may read its own only."""
    import time

    rows = near_rows(600, 300, 6)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).checkpoint()
    before = shuffle_bytes(spark)
    out = J.jaccard_components(df)
    for _ in range(40):  # files go in the background
        left = sum(n for name, n in shuffle_bytes(spark).items() if name not in before)
        if left < 100_000:
            break
        time.sleep(0.5)
    assert left < 100_000
    assert out.count() == 600 and out.count() == 600  # the result can be computed again
    assert sorted(out.collect()) == sorted(out.collect())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
