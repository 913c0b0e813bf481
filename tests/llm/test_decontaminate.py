"""Containment search against plain Python sets."""

import random

import pytest

from ledgerlens.llm import _spans
from ledgerlens.llm import decontaminate as D


def words(text):
    return [w for w in (text or "").lower().translate({c: 32 for c in range(9, 14)}).split(" ") if w]


def runs(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, items):
    out = set()
    for i, t in items:
        w = words(t)
        if not w:
            continue
        s = runs(w, min(5, len(w)))
        for d, text in docs:
            n = len(s & runs(words(text), min(5, len(w))))
            if 5 * n >= 4 * len(s) and n:
                out.add((d, i, len(s), n))
    return sorted(out, key=str)


def check(docs_df, items_df, docs, items):
    got = sorted({(r.id, r.item_id, r.n_item, r.n_found) for r in D.contained_items(docs_df, items_df).collect()}, key=str)
    assert got == brute(docs, items)
    kept = D.decontaminated(docs_df, items_df)
    assert kept.columns == docs_df.columns
    bad = {(d, text) for d, text in docs if brute([(d, text)], items)}
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted((x for x in docs if x not in bad), key=str)


def test_planted_passages_near_the_threshold(spark):
    rnd = random.Random(2)
    word = lambda: "w%d" % rnd.randrange(400)
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([1, 2, 4, 5, 6, 9, 10, 14, 15, 24, 25, 60, 61, 200])]
    docs = []
    for d in range(150):
        i, text = rnd.choice(items)
        w = text.split(" ")
        for _ in range(rnd.randrange(0, 1 + max(1, len(w) // 20))):
            w[rnd.randrange(len(w))] = word()
        docs.append((d, " ".join([word() for _ in range(rnd.randrange(0, 300))] + w + [word() for _ in range(rnd.randrange(0, 100))])))
    check(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), docs, items)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_nulls_empty_long_repeats_and_other_columns(spark, monkeypatch, limit):
    """The same with every join broadcast and with every join shuffled."""
    monkeypatch.setattr(_spans, "BROADCAST_ROWS", limit)
    item = "One two THREE four five six seven eight nine ten"
    docs = [(1, None), (2, ""), (3, item), (3, item), (3, "not the item"), (None, "x " * 4000 + item.upper() + " y" * 50), (4, "one two\nthree\tfour five six seven eight nine eleven"),
            (5, "É été " + item.replace(" ", "  ")), (6, "short one here")]
    items = [(1, item), (1, item), (2, None), (3, ""), (4, " \n"), (None, "short one"), (5, "été")]
    check(spark.createDataFrame([(i, t, 1, "q", 2) for i, t in docs], "doc_id long, text string, hit_id int, s string, hit_h int"),
          spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int"), docs, items)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string"), spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert D.contained_items(docs, items.limit(0)).count() == 0
    assert D.contained_items(docs.limit(0), items).count() == 0
    assert D.decontaminated(docs, items.limit(0)).count() == 1
