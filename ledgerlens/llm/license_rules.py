"""License scan by ordered signature rules (DataFrame functions only).

A text's words (lower-case ASCII letters, digits and all non-ASCII characters) joined by single
blanks are what the rules' regular expressions see. A text is looked at when a keyword regex finds
it; of the rules only those run whose own keyword it holds. Detections are intervals of words. One
that lies inside a detection of a rule with higher priority (or of the same priority but wider, or
equal and listed earlier) is suppressed.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._spans import finding, located, same_rows, text_hash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"  # on text that still has capitals
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
CONFIDENCE = {1: 0.99, 2: 0.95, 3: 0.9, 4: 0.75, 5: 0.5}  # by priority
LEVELS = sorted(CONFIDENCE)

# label: (keyword, names as regexes on the joined words, SPDX identifiers as words, URL words)
FAMILIES = {
    "apache-2.0": ("apache", ["apache (?:software )?licen[sc]e (?:version |v ?)?2(?: 0)?", "apache 2(?: 0)?(?: licen[sc]e)?", "asl 2(?: 0)?"], ["apache 2 0"], ["apache org licenses license 2 0"]),
    "apache-1.1": ("apache", ["apache (?:software )?licen[sc]e (?:version |v ?)?1 1"], ["apache 1 1"], ["apache org licenses license 1 1"]),
    "mit": ("mit", ["mit licen[sc]e", "mit x11 licen[sc]e", "expat licen[sc]e"], ["mit"], ["opensource org licenses mit"]),
    "bsd-2-clause": ("bsd", ["(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) licen[sc]e"], ["bsd 2 clause"], ["opensource org licenses bsd 2 clause"]),
    "bsd-3-clause": ("bsd", ["(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e"], ["bsd 3 clause"], ["opensource org licenses bsd 3 clause"]),
    "bsd": ("bsd", ["bsd (?:style )?licen[sc]e"], ["bsd"], ["opensource org licenses bsd license"]),
    "gpl-2.0": ("public", ["gnu general public licen[sc]e (?:version |v ?)2(?: 0)?", "gnu gpl (?:version |v ?)?2(?: 0)?", "gpl ?v2"], ["gpl 2 0", "gpl 2 0 only"], ["gnu org licenses (?:old licenses )?gpl 2 0"]),
    "gpl-3.0": ("public", ["gnu general public licen[sc]e (?:version |v ?)3(?: 0)?", "gnu gpl (?:version |v ?)?3(?: 0)?", "gpl ?v3"], ["gpl 3 0", "gpl 3 0 only"], ["gnu org licenses gpl 3 0"]),
    "gpl-2.0-or-later": ("public", ["general public licen[sc]e (?:version |v ?)?2(?: 0)? (?:of the licen[sc]e )?or (?:at your option )?any later version"], ["gpl 2 0 or later"], []),
    "gpl-3.0-or-later": ("public", ["general public licen[sc]e (?:version |v ?)?3(?: 0)? (?:of the licen[sc]e )?or (?:at your option )?any later version"], ["gpl 3 0 or later"], []),
    "lgpl-2.1": ("lesser", ["gnu lesser general public licen[sc]e (?:version |v ?)2 1", "lgpl ?v2 1"], ["lgpl 2 1", "lgpl 2 1 only", "lgpl 2 1 or later"], ["gnu org licenses (?:old licenses )?lgpl 2 1"]),
    "lgpl-3.0": ("lesser", ["gnu lesser general public licen[sc]e (?:version |v ?)3(?: 0)?", "lgpl ?v3"], ["lgpl 3 0", "lgpl 3 0 only", "lgpl 3 0 or later"], ["gnu org licenses lgpl 3 0"]),
    "agpl-3.0": ("affero", ["gnu affero general public licen[sc]e (?:version |v ?)3(?: 0)?", "agpl ?v3"], ["agpl 3 0", "agpl 3 0 only", "agpl 3 0 or later"], ["gnu org licenses agpl 3 0"]),
    "gfdl-1.3": ("documentation", ["gnu free documentation licen[sc]e(?: (?:version |v ?)1 3)?"], ["gfdl 1 3"], ["gnu org licenses fdl 1 3"]),
    "mpl-2.0": ("mozilla", ["mozilla public licen[sc]e (?:version |v ?)?2(?: 0)?", "mpl ?v?2(?: 0)"], ["mpl 2 0"], ["mozilla org mpl 2 0"]),
    "mpl-1.1": ("mozilla", ["mozilla public licen[sc]e (?:version |v ?)?1 1"], ["mpl 1 1"], ["mozilla org mpl 1 1"]),
    "epl-1.0": ("eclipse", ["eclipse public licen[sc]e (?:version |v ?)?1 0"], ["epl 1 0"], ["eclipse org legal epl v10"]),
    "epl-2.0": ("eclipse", ["eclipse public licen[sc]e (?:version |v ?)?2(?: 0)?"], ["epl 2 0"], ["eclipse org legal epl 2 0"]),
    "cddl-1.0": ("distribution", ["common development and distribution licen[sc]e(?: (?:version |v ?)?1 0)?"], ["cddl 1 0"], ["opensource org licenses cddl 1 0"]),
    "isc": ("isc", ["isc licen[sc]e"], ["isc"], ["opensource org licenses isc"]),
    "zlib": ("zlib", ["zlib(?: libpng)? licen[sc]e"], ["zlib"], ["opensource org licenses zlib"]),
    "bsl-1.0": ("boost", ["boost software licen[sc]e(?: (?:version |v ?)?1 0)?"], ["bsl 1 0"], ["boost org license 1 0"]),
    "artistic-2.0": ("artistic", ["artistic licen[sc]e (?:version |v ?)?2(?: 0)?"], ["artistic 2 0"], ["opensource org licenses artistic license 2 0"]),
    "unlicense": ("unlicense", ["the unlicense"], ["unlicense"], ["unlicense org"]),
    "wtfpl": ("fuck", ["do what the fuck you want to public licen[sc]e", "wtfpl"], ["wtfpl"], ["wtfpl net"]),
    "cc0-1.0": ("cc0", ["cc0(?: 1 0)?(?: universal)?", "creative commons zero"], ["cc0 1 0"], ["creativecommons org publicdomain zero 1 0"]),
    "ofl-1.1": ("font", ["sil open font licen[sc]e(?: (?:version |v ?)?1 1)?"], ["ofl 1 1"], ["scripts sil org ofl"]),
    "odbl-1.0": ("database", ["open database licen[sc]e(?: (?:version |v ?)?1 0)?"], ["odbl 1 0"], ["opendatacommons org licenses odbl"]),
    "ogl-3.0": ("government", ["open government licen[sc]e(?: (?:version |v ?)?3 0)?"], ["ogl uk 3 0"], ["nationalarchives gov uk doc open government licence"]),
}
CC_PARTS = {"by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s?", "by nc": "attribution non ?commercial",
            "by nc sa": "attribution non ?commercial share ?alike", "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?"}
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
GENERAL = [  # (label, priority, keyword, regex): wording that names no one license
    ("gpl", 4, "public", "gnu general public licen[sc]e"), ("lgpl", 4, "lesser", "gnu lesser general public licen[sc]e"), ("agpl", 4, "affero", "gnu affero general public licen[sc]e"),
    ("mpl", 4, "mozilla", "mozilla public licen[sc]e"), ("epl", 4, "eclipse", "eclipse public licen[sc]e"), ("apache", 4, "apache", "apache licen[sc]e"),
    ("creative-commons", 4, "creative", "creative commons(?: licen[sc]e)?"), ("public-domain", 4, "domain", "(?:in the|to the|dedicated to the) public domain"),
    ("mit", 3, "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("bsd", 3, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("isc", 3, "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("proprietary", 4, "proprietary", "(?:confidential and proprietary|proprietary and confidential)"), ("proprietary", 4, "unauthorized", "unauthorized copying of this file"),
    ("proprietary", 4, "reproduced", "(?:may not|no part of this \\w+ may) be reproduced"), ("reserved", 4, "rights", "all rights reserved"), ("reserved", 5, "rights", "rights reserved"),
    ("copyright", 5, "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}"), ("unknown-license", 5, "licensed", "licensed under"),
    ("unknown-license", 5, "licen", "see (?:the )?licen[sc]e file"),
]


def rules() -> list[tuple[int, str, int, str, str]]:
    """(number, label, priority, keyword, regex) of all rules in order; each family gives its forms."""
    out = []
    for label, (keyword, names, spdx, urls) in FAMILIES.items():
        for s in spdx:
            out.append((label, 1, "spdx", f"spdx license identifier {s}"))
            out.append((label, 1, s.split(" ")[0], f"license {s}(?= |$)"))
        for u in urls:
            out.append((label, 2, u.split(" ")[0], f"(?:https? )?(?:www )?{u}"))
        for x in names:
            out.append((label, 2, keyword if keyword in x else x.split(" ")[0], f"(?:licen[sc]ed|released|distributed|available|published) under (?:the terms of )?(?:the |an? )?{x}"))
            out.append((label, 3, keyword if keyword in x else x.split(" ")[0], x))
    for part, words in CC_PARTS.items():
        own = part.replace(" ", "-")
        for v in CC_VERSIONS:
            label = f"cc-{own}-{v.replace(' ', '.')}"
            out.append((label, 1, "spdx", f"spdx license identifier cc {part} {v}"))
            out.append((label, 2, "creativecommons", f"creativecommons org licenses {part} {v}"))
            out.append((label, 2, "cc", f"(?:licen[sc]ed|released|distributed|available|published) under (?:the |an? )?cc {part} {v}"))
            out.append((label, 3, "cc", f"cc {part} {v}"))
            out.append((label, 3, "creative", f"creative commons {words} {v}(?: international| unported| generic)?(?: licen[sc]e)?"))
        out.append((f"cc-{own}", 4, "cc", f"cc {part}"))
        out.append((f"cc-{own}", 4, "creative", f"creative commons {words}"))
    out += GENERAL
    fix = lambda k: re.match("[a-z0-9]*", k).group() or "licen"
    return [(i, label, prio, fix(keyword), f"(?<![^ ])(?:{x})(?![^ ])") for i, (label, prio, keyword, x) in enumerate(out)]


# one of these begins a word of each text that a rule or a base phrase matches; those of up to four letters are whole words
STEMS = ("licen", "unlicen", "copyright", "reserved", "spdx", "creative", "gnu", "gpl", "lgpl", "agpl", "gplv", "lgplv", "agplv", "mpl", "mplv", "asl", "apache", "cc", "cc0", "wtfpl", "hereby", "redistribution",
         "reproduced", "proprietary", "unauthorized", "domain", "bsd", "ofl", "epl", "use copy")
GATE = "(?i)(?<![a-z0-9])(?:" + "|".join(f"{x}(?![a-z])" if len(x) < 5 and x != "licen" else x.replace(" ", "[^a-z0-9]+") for x in STEMS) + ")"


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _places(words: str, phrase: list[str]) -> Column:
    """Where the phrase's words stand one after the other."""
    rest, size = " ".join(phrase[1:]), len(phrase) - 1

    def place(x, i):
        return F.when((x == phrase[0]) & (F.array_join(F.slice(words, i + 2, size), " ") == rest), i.cast("long"))

    return F.array_compact(F.transform(words, place))


def license_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, n_words, n_base, first_word, last_word, base_labels) of each row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("h"), text.alias("t"))
    none = F.array().cast("array<string>")
    step = rows.select("id", "h", F.regexp_count("t", F.lit(WORD)).cast("long").alias("n_words"),
                       F.when(F.col("t").rlike(GATE), F.regexp_extract_all(_lower(F.col("t")), F.lit(WORD), F.lit(0))).otherwise(none).alias("w"))
    found = []
    for phrase, label in BASE.items():
        p = phrase.split(" ")
        found.append((label, F.when(F.array_contains("w", p[0]) & F.array_contains("w", p[-1]), _places("w", p)).otherwise(F.array().cast("array<long>"))))
    step = step.select("id", "h", "n_words", *(x.alias(f"at_{i}") for i, (_, x) in enumerate(found)))
    every = F.concat(*(F.col(f"at_{i}") for i in range(len(found))))
    labels = F.array_sort(F.array_compact(F.array(*(F.when(F.size(f"at_{i}") > 0, F.lit(label)) for i, (label, _) in enumerate(found)))))
    return step.select("id", "h", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).alias("first_word"), F.array_max(every).alias("last_word"), labels.alias("base"))


def license_detections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, label, priority, rule, start, end) of the detections that stay, in words, once for equal rows."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), text.alias("t")).where(F.col("t").rlike(GATE)).dropDuplicates(["id", "h"])
    rows = rows.select("id", "h", F.array_join(F.regexp_extract_all(_lower(F.col("t")), F.lit(WORD), F.lit(0)), " ").alias("t"))
    listed = rules()
    words = sorted({r[3] for r in listed})
    # outer: a plain explode would push a filter on the array's size below, computing the words again
    held = rows.select("id", "h", "t", F.explode_outer(F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(F.col("t"), w))).alias("keyword"))
    table = spark.createDataFrame(listed, "rule int, label string, priority int, keyword string, pattern string")  # fixed, a few hundred rows
    tried = held.join(F.broadcast(table.select("rule", "keyword", "pattern")), "keyword").where(F.expr("t rlike pattern"))
    spaces = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    # in units of blanks a match starts at its first word's index and ends before the next word's
    found = tried.select("id", "h", finding(F.col("rule"), F.col("t"), F.col("pattern")).alias("f"))
    spans = located(found, ["id", "h"], "f", spaces).join(F.broadcast(table.drop("keyword", "pattern")), F.col("kind") == F.col("rule")).select(
        "id", "h", "rule", "label", "priority", "start", (F.col("end") + 1).alias("end"))
    # contained in an earlier or equal start with at least the same end, of a stronger rule: running
    # maxima of the ends by priority over the starts so far (all detections with equal starts included)
    so_far = Window.partitionBy("id", "h").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy("id", "h", "priority").orderBy("start", F.desc("end"), "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = spans.select("*", F.max("end").over(before).alias("same"), *(F.max(F.when(F.col("priority") == p, F.col("end"))).over(so_far).alias(f"r{p}") for p in LEVELS))
    inside = F.coalesce(F.col("same") >= F.col("end"), F.lit(False))
    for p in LEVELS:
        inside = inside | ((F.col("priority") > p) & F.coalesce(F.col(f"r{p}") >= F.col("end"), F.lit(False)))
    return reach.where(~inside).select("id", "h", "label", "priority", "rule", "start", "end")


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``.

    base_labels and labels are distinct, sorted and comma-joined; first_word and last_word are null
    without base phrases; score is the confidence of the strongest rule or base phrase, 0 without
    any. A null text is an empty one. Very long texts are scanned whole; a text's detections meet in
    one window. Repeated rows get the same result each; ids may repeat or be null. Other columns are not read. No rows give an empty table.
    """
    best = F.coalesce(*(F.when(F.col("priority") == p, F.lit(c)) for p, c in CONFIDENCE.items()))
    det = license_detections(docs, id_col, text_col).groupBy(F.col("id").alias("r_id"), F.col("h").alias("r_h")).agg(F.collect_set("label").alias("more"), F.max(best).alias("best"))
    rows = license_rows(docs, id_col, text_col).join(det, same_rows(["id", "h"], ["r_id", "r_h"]), "left")
    every = F.array_sort(F.array_distinct(F.concat("base", F.coalesce("more", F.array().cast("array<string>")))))
    base_score = F.when(F.col("n_base") > 0, F.lit(CONFIDENCE[4])).otherwise(F.lit(0.0))
    return rows.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                       F.array_join(every, ",").alias("labels"), F.greatest(base_score, F.coalesce("best", F.lit(0.0))).alias("score"))
