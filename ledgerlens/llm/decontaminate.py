"""Benchmark decontamination: size-partitioned MinHash containment search (DataFrame functions only).

Items are partitioned by their number of shingles (powers of two). A partition's MinHash sketch of
an item is its m smallest shingle hashes, with m = q - ceil(t*q) + 1 of q: a text that holds at least
the share t of an item's shingles holds at least one of those m. So the search misses nothing, while
a fixed-length MinHash signature of a long text (Jaccard similarity with a short item near 0.001)
would miss most. On the document side a shingle can only meet a sketch if its hash is under the
highest sketched hash of some partition; only those are joined. Candidates are verified by counting
the item's shingles, compared as words, in the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize

from ._spans import fresh, same_rows, small, text_hash

SPACE = "[\\x20\\x09-\\x0D]+"


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), SPACE), lambda w: w != "")


def _runs(words: str, k: int, make) -> Column:
    """``make(i)`` for the start of each run of k words."""
    n = F.size(words)
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), make))


def _strings(words: str, k: int) -> Column:
    return _runs(words, k, lambda i: F.array_join(F.slice(words, i + 1, k), " "))


def item_shingles(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(item_id, k, q, s, x, part): each distinct shingle of each item as words and hash; an item of fewer
    words is one shingle of its k words; items without words have none."""
    w = items.select(F.col(item_col).alias("item_id"), _words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("k", F.least(F.size("w"), F.lit(size))).withColumn("item", F.xxhash64(F.col("item_id"), F.array_join("w", " ")))
    strings = F.coalesce(*(F.when(F.col("k") == k, F.array_distinct(_strings("w", k))) for k in range(1, size + 1)))
    s = w.select("item", "item_id", "k", strings.alias("all")).dropDuplicates(["item"])
    s = s.select("item", "item_id", "k", F.size("all").alias("q"), F.explode_outer("all").alias("s"))
    return s.withColumn("x", F.xxhash64(F.transform(F.split("s", " "), lambda v: F.xxhash64(v)))).withColumn("part", F.ceil(F.log2("q")).cast("int"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text", threshold: tuple[int, int] = (4, 5), size: int = 5) -> DataFrame:
    """(id, text_hash, item_id, n_item, n_found) where a row's text holds at least the share ``threshold``
    of an item's distinct ``size``-word shingles, once for equal rows.

    Words are lower-cased. Items of fewer words must occur as they are. Null and empty texts and
    items hold and match nothing; repeated items count once; null ids are ids. Very long texts are
    searched whole, to their last word. Other columns are not read. An empty table on either side
    gives no rows.
    """
    num, den = threshold
    listed = materialize(item_shingles(items, item_col, item_text_col, size))
    shape = listed.agg(F.collect_set("k"), F.count("*")).first()
    lengths = sorted(shape[0])
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), text.alias("t"))
    # the sketches: of each item the smallest hashes, as many as make a miss impossible
    order = F.sort_array(F.collect_list("x"))
    least = (F.col("q") - F.ceil(F.col("q") * num / F.lit(den)) + 1).cast("int")
    sketch = listed.groupBy("item", "part", "q").agg(order.alias("all")).select("item", "part", F.slice("all", F.lit(1), least).alias("sketch"))
    ceilings = {r[0]: r[1] for r in sketch.groupBy("part").agg(F.max(F.array_max("sketch"))).collect()}  # at most one a power of two
    sketch = sketch.select("item", "part", F.explode("sketch").alias("x"))
    if not lengths:
        lengths, ceilings = [size], {0: -(1 << 63)}
    hashed = rows.select("id", "h", F.transform(_words(F.col("t")), lambda w: F.xxhash64(w)).alias("w"))
    kept = hashed.select("id", "h", _sketchable("w", lengths, max(ceilings.values())).alias("xs"))
    # outer: a plain explode would push a filter on the arrays' size below, computing them again for each element
    # each size partition is searched with its own ceiling
    bounds = F.array(*(F.struct(F.lit(p).alias("part"), F.lit(c).alias("most")) for p, c in sorted(ceilings.items())))
    probes = kept.select("id", "h", F.explode_outer("xs").alias("x")).where("x IS NOT NULL")
    probes = probes.select("id", "h", "x", F.explode(F.transform(F.filter(bounds, lambda b: F.col("x") <= b["most"]), lambda b: b["part"])).alias("part"))
    met = materialize(probes.join(small(sketch), ["part", "x"]).select("id", "h", "item").distinct())
    # verification reads only texts with a candidate
    wanted = met.select(F.col("id").alias("c_id"), F.col("h").alias("c_h")).distinct()
    texts = rows.join(small(wanted), same_rows(["id", "h"], ["c_id", "c_h"]), "left_semi").dropDuplicates(["id", "h"])
    texts = texts.select("id", "h", _words(F.col("t")).alias("w"))
    strings = F.array_distinct(F.concat(*(F.coalesce(_strings("w", k), F.array().cast("array<string>")) for k in lengths)))
    found = texts.select("id", "h", F.explode_outer(strings).alias("s")).join(small(listed.select("item", "item_id", "q", "s")), "s")
    hits = found.groupBy("id", "h", "item", "item_id", "q").agg(F.count("*").alias("n_found")).where(F.col("n_found") * den >= F.col("q") * num)
    sure = hits.join(met.select(F.col("id").alias("m_id"), F.col("h").alias("m_h"), F.col("item").alias("m_item")), same_rows(["id", "h", "item"], ["m_id", "m_h", "m_item"]), "left_semi")
    return sure.select("id", "h", "item_id", F.col("q").cast("long").alias("n_item"), "n_found")


def _sketchable(words: str, lengths: list[int], ceiling: int) -> Column:
    """Distinct shingle hashes of at most ``ceiling``."""
    out = []
    for k in lengths:
        out.append(F.coalesce(F.filter(_runs(words, k, _shingle(words, k)), lambda x: x <= F.lit(ceiling)), F.array().cast("array<long>")))
    return F.array_distinct(F.concat(*out))


def _shingle(words: str, k: int):
    return lambda i: F.xxhash64(F.slice(words, i + 1, k))


def decontaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no item."""
    of, hashed = fresh(docs, "hit_id"), fresh(docs, "hit_h")
    hits = materialize(contained_items(docs, items, id_col, text_col, **kw).select(F.col("id").alias(of), F.col("h").alias(hashed)).distinct())
    return docs.join(small(hits), F.col(id_col).eqNullSafe(F.col(of)) & text_hash(F.col(text_col)).eqNullSafe(F.col(hashed)), "left_anti")
