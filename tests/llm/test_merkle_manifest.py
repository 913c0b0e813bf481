"""Merkle manifest against a plain tree over sorted lists."""

import hashlib
import random
import zlib

import pytest

from ledgerlens.llm import merkle_manifest as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def digest(values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([H("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def climb(steps, h):
    sibs = ""
    for tree, at in steps:
        for level in tree[:-1]:
            other = level[at ^ 1] if at ^ 1 < len(level) else ""
            sibs += other
            h = H(other + h) if at & 1 else H(h + other)
            at >>= 1
    return sibs, h


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    leaves = [(lang, i, digest((i, source, lang, n, text)), digest((i, source, lang, None if n is None else n + 1, text))) for i, text, lang, source, n in rows]
    langs = sorted({x[0] for x in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    groups = {g: sorted((x for x in leaves if x[0] == g), key=lambda x: (x[1] is not None, x[1] or 0, x[2])) for g in langs}
    trees = {g: levels([x[2] for x in xs]) for g, xs in groups.items()}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for j, g in enumerate(langs):
        for k, (_, i, leaf, changed) in enumerate(groups[g]):
            hit = i is not None and zlib.crc32(str(i).encode()) % 7 == 0
            sibs, folded = climb([(trees[g], k), (top, j)], changed if hit else leaf)
            out.append((i, leaf, trees[g][-1][0], top[-1][0], H(sibs), folded, folded == top[-1][0]))
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    got = M.document_manifest(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    assert dict(got.dtypes) == {"doc_id": "bigint", "leaf": "string", "subroot": "string", "root": "string", "proof_sha256": "string", "folded_root": "string", "verified": "boolean"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("bits", [1, 2, 10])
def test_levels_of_blocks(spark, monkeypatch, bits):
    monkeypatch.setattr(M, "BITS", bits)
    rnd = random.Random(bits)
    rows = [(i, f"text {i}", lang, "s", 7) for lang, n in (("a", 1), ("b", 2), ("c", 37), ("d", 16), ("e", 17)) for i in rnd.sample(range(1000), n)]
    check(spark, rows)


def test_nulls_long_texts_and_langs_by_bytes(spark):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (None, "x", "null", "s", 3), (None, "y", None, "s", 3), (4, "é ü\n", "ü", "é", 4),
            (5, "x " * 300_000, "z", "s", (1 << 63) - 2), (6, "z", "\U0001F600", "s", -5), (7, "z", "�", "s", 5)]
    check(spark, rows)
    check(spark, [(i, "t", "en", "s", None) for i in range(40)])  # nulls stay: tampering changes nothing


def test_repeated_rows_and_ids(spark):
    check(spark, [(0, "same", "en", "s", 4)] * 30 + [(0, "other", "en", "s", 4), (3, "same", "en", "s", 4)], parts=5)


def test_one_row_and_no_rows(spark):
    check(spark, [(9, "only", "en", "s", 4)])
    assert M.document_manifest(spark.createDataFrame([], SCHEMA)).count() == 0


def test_columns_with_clashing_names(spark):
    rows = [(i, "t", "en", "s", 1) for i in range(9)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("tree", "pos", "n", "leaf", "root", "_at", "up", "id"):
        df = df.withColumn(c, df.text)
    assert sorted((tuple(r) for r in M.document_manifest(df).collect()), key=str) == brute(rows)


def test_a_version_shares_untouched_nodes():
    base = M.build([str(i) for i in range(13)], 4)

    def nodes(t):
        return {id(t)} | (nodes(t.left) if t.left else set()) | (nodes(t.right) if t.right else set())

    for at in range(13):
        new = M.version(base, 4, at, "changed")
        assert len(nodes(new) - nodes(base)) == 5  # the leaf and its four ancestors
        assert new.digest == M.build([str(i) if i != at else "changed" for i in range(13)], 4).digest
