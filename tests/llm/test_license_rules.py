"""License scan against Python's re and a pairwise suppression."""

import re

import pytest

from ledgerlens.llm import license_rules as R

A_Z = {c: c + 32 for c in range(65, 91)}
WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
RULES = [(n, label, p, k, re.compile(x)) for n, label, p, k, x in R.rules()]


def brute(text):
    words = WORD.findall((text or "").translate(A_Z))
    at, base = [], set()
    for phrase, label in R.BASE.items():
        p = phrase.split(" ")
        here = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        at += here
        base |= {label} if here else set()
    joined = " ".join(words)
    found = []
    for n, label, prio, _, x in RULES:
        for m in x.finditer(joined):
            found.append((prio, joined.count(" ", 0, m.start()), joined.count(" ", 0, m.end()) + 1, n, label))

    def hidden(a):
        for b in found:
            if b is not a and b[1] <= a[1] and b[2] >= a[2]:
                if b[0] < a[0] or b[0] == a[0] and (b[2] - b[1] > a[2] - a[1] or b[1:3] == a[1:3] and b[3] < a[3]):
                    return True
        return False

    stay = [a for a in found if not hidden(a)]
    labels = base | {a[4] for a in stay}
    score = max([R.CONFIDENCE[a[0]] for a in stay] + ([R.CONFIDENCE[4]] if at else [0.0]))
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score


def check(df, rows):
    got = sorted((tuple(r) for r in R.license_scan(df).collect()), key=str)
    assert got == sorted(((k, *brute(t)) for k, t in rows), key=str)


def test_documents_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(df, [tuple(r) for r in df.collect()])


SAMPLES = [
    "Licensed under the Apache License, Version 2.0 (the \"License\")", "SPDX-License-Identifier: GPL-3.0-or-later\nfoo", "https://creativecommons.org/licenses/by-nc-sa/4.0/", "Licensed under CC BY-NC 4.0.",
    "CC-BY 3.0 and cc by cc by-sa 4.0", "This is free: GNU General Public License, version 2 of the License, or (at your option) any later version.", "All Rights Reserved. all rights reserved",
    "éall rights reserved", "gplv3 GPL v2 lgplv2.1", "Permission is hereby granted, free of charge, to any person obtaining a copy", "the MIT License; MIT licence", "see the LICENSE file, copyright (c) 2021 Someone",
    "released into the public domain (CC0 1.0 Universal) http://unlicense.org/", "Mozilla Public License 2.0 / MPL-1.1", "Redistribution and use in source and binary forms, with or without modification, are permitted",
    "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "no part of this book may be reproduced", "BSD 3-Clause License BSD-style license simplified BSD license",
]


@pytest.mark.parametrize("repeat", [1, 40])
def test_samples_nulls_repeats_and_other_columns(spark, repeat):
    rows = [(i, (" x\n".join([s] * repeat))) for i, s in enumerate(SAMPLES)]
    rows += [(100, None), (101, ""), (102, " .,; "), (103, " ".join(SAMPLES)), (103, " ".join(SAMPLES)), (103, "the id again"), (None, SAMPLES[0]), (104, "w " * 3000 + SAMPLES[0])]
    df = spark.createDataFrame([(i, t, "k", 1, 2) for i, t in rows], "doc_id long, text string, keyword string, n_words int, rule int")
    check(df, rows)


def test_empty_table(spark):
    assert R.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_rules_are_many_ordered_and_reachable():
    """Each rule's keyword stands in its regex, and its sample text passes the first gate."""
    assert len(RULES) > 300
    gate = re.compile(R.GATE)
    for n, label, _, k, x in RULES:
        assert k in x.pattern, (label, k, x.pattern)
        assert any(s.split(" ")[0] in x.pattern for s in R.STEMS), (label, x.pattern)
    for s in SAMPLES:
        assert gate.search(s), s


def texts_of(parsed):
    """Texts that a parsed regex matches: optional parts absent and present, all branches and set members."""
    out = [""]
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            more = [chr(arg)]
        elif name == "IN":
            more = []
            for kind, x in arg:
                if str(kind) == "LITERAL":
                    more.append(chr(x))
                elif str(kind) == "RANGE":
                    more.append(chr(x[0]))
                elif str(kind) == "CATEGORY":
                    more.append("w")
        elif name == "SUBPATTERN":
            more = texts_of(arg[3])
        elif name == "BRANCH":
            more = [t for branch in arg[1] for t in texts_of(branch)]
        elif name == "MAX_REPEAT":
            lo, hi, inner = arg
            more = [t * n for n in {lo, max(lo, 1), min(int(hi), 2)} for t in texts_of(inner)]
        elif name in ("ASSERT", "ASSERT_NOT"):
            continue
        else:
            raise AssertionError(name)
        out = [a + b for a in out for b in dict.fromkeys(more)]
    return out


def test_every_text_of_a_rule_passes_the_gate_and_the_keyword():
    gate, many = re.compile(R.GATE), 0
    for _, label, _, k, x in RULES:
        texts = texts_of(re._parser.parse(x.pattern))
        assert texts
        for t in texts:
            assert x.search(t), (label, t)
            assert k in t, (label, k, t)
            for raw in (t, t.upper(), t.replace(" ", "."), f"(see {t.replace(' ', '-')})"):
                assert gate.search(raw), (label, raw)
            many += 1
    assert many > len(RULES)


def test_mplv2_alone_is_found(spark):
    rows = [(1, "released under MPLv2.0"), (2, "MPLv2.0"), (3, "nothing here")]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
    assert [r.labels for r in R.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id").collect()] == ["mpl-2.0", "mpl-2.0", ""]
