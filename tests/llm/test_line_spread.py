"""Line spread against plain Python counts."""

import random
import re

import pytest

from ledgerlens.llm import _spans
from ledgerlens.llm import line_spread as L

BLANK = re.compile("[\\x20\\x09-\\x0D]*")



def brute(rows, hashes, min_sites):
    sites, first = {}, {}
    for (k, site, text), h in zip(rows, hashes):
        for line in set((text or "").split("\n")) if text is not None else ():
            if not BLANK.fullmatch(line):
                sites.setdefault(line, set()).update([site] if site is not None else [])
                mine = ((k is not None, k or 0), h)
                first[line] = min(first.get(line, mine), mine)
    out = []
    for (k, site, text), h in zip(rows, hashes):
        lines = text.split("\n") if text is not None else []
        gone = [not BLANK.fullmatch(x) and len(sites[x]) >= min_sites and first[x] != ((k is not None, k or 0), h) for x in lines]
        stay = [x for x, g in zip(lines, gone) if not g]
        kept = not any(gone) or any(not BLANK.fullmatch(x) for x in stay)
        out.append((k, len(lines), sum(gone), kept, "\n".join(stay) if text is not None else None))
    return sorted(out, key=str)


def check(spark, rows, min_sites, extra=""):
    df = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, source string, text string, drop_id int, n_lines int, stay string").repartition(3)
    # the order of equal ids is by hash
    hashes = {r.text: r.h for r in df.select("text", L.text_hash(df.text).alias("h2")).withColumnRenamed("h2", "h").collect()}
    got = L.deduplicated(df, min_sites=min_sites)
    assert got.columns == ["doc_id", "source", "text", "drop_id", "stay", "n_lines", "n_removed", "kept"]
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.kept, r.text) for r in got.collect()), key=str) == brute(rows, [hashes[t] for *_, t in rows], min_sites)


@pytest.mark.parametrize("min_sites,limit", [(3, 500_000), (10, 500_000), (25, 0)])
def test_spread_near_the_threshold(spark, monkeypatch, min_sites, limit):
    monkeypatch.setattr(_spans, "BROADCAST_ROWS", limit)
    rnd = random.Random(min_sites)
    shared = ["shared line %d" % i for i in range(40)]
    rows = []
    for k in range(400):
        lines = ["own %d %d" % (k, i) for i in range(rnd.randrange(0, 3))]
        lines += [s for i, s in enumerate(shared) if rnd.random() < 0.15 and (k % 60) < i + 1]
        rnd.shuffle(lines)
        rows.append((k, "site%d" % (k % 60), "\n".join(lines)))
    check(spark, rows, min_sites)


def test_nulls_empty_long_repeats(spark):
    foot = "the footer"
    rows = [(i, "s%d" % (i % 5), f"text {i}\n{foot}\n\n") for i in range(2, 12)]
    rows += [(1, "s1", None), (None, "s9", foot), (5, None, foot + "\n " + foot), (7, "s7", "w " * 5000 + "\n" + foot), (7, "s7", "w " * 5000 + "\n" + foot), (0, "s0", ""), (12, "s3", f"{foot}\n{foot}\r\n \t")]
    check(spark, rows, 4)


def test_empty_table(spark):
    assert L.deduplicated(spark.createDataFrame([], "doc_id long, source string, text string")).count() == 0
