"""Line deduplication by distinct-site spread.

Each line's sites go into a HyperLogLog sketch per line hash; sketches merge in the aggregation's
partial and final steps. Lines whose estimate is clear of the threshold are decided by it; those
near it get an exact distinct count. A line of at least ``min_sites`` sites is boilerplate: it stays
in the first document that holds it and is taken out of all others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import materialize

from ._spans import fresh, small, text_hash

MIN_SITES = 10
LOG_SIZE = 10  # 2^10 registers: a standard error of 3.3 %
NON_SPACE = "[^\\x20\\x09-\\x0D]"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")


def _keys(text: Column) -> Column:
    """Distinct hashes of a text's lines that are not blank."""
    return F.array_distinct(F.transform(F.filter(_lines(text), lambda x: x.rlike(NON_SPACE)), lambda x: F.xxhash64(x)))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, margin: float = 0.15) -> DataFrame:
    """(line) of the lines on at least ``min_sites`` sites. ``lines``: (line, site), a row per document and line.

    The margin is over four standard errors of the sketch; a null site is no site."""
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", LOG_SIZE).alias("sketch"))
    spread = materialize(spread.select("line", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites * (1 - margin) - 1))
    clear = spread.where(F.col("sites") > min_sites * (1 + margin) + 1).select("line")
    near = spread.where(F.col("sites") <= min_sites * (1 + margin) + 1).select("line")
    exact = lines.join(small(near), "line", "left_semi").groupBy("line").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites).select("line")
    return clear.unionByName(exact)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with n_lines, n_removed and kept, and the text without boilerplate lines.

    Lines end at line feeds and are compared whole; blank ones are never boilerplate. The first
    document holding a line is the one with the smallest id (a null id is the smallest; of one id the
    smallest text hash); it keeps all its occurrences. kept is false where every line that is not
    blank was removed. Texts without a removed line stay as they are, null ones null. Very long texts
    are split whole, and very long lines compared by the same 64-bit hash as others. Repeated rows
    are treated alike. Columns of ``docs`` of the names added are replaced. No rows give an empty table.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text).alias("h"), F.col(site_col).alias("site"), text.alias("t")).where(F.col("t").isNotNull())
    # outer: a plain explode would compute the keys twice, for a filter on their number
    lines = rows.select("id", "h", "site", F.explode_outer(_keys(F.col("t"))).alias("line")).where("line IS NOT NULL")
    common = materialize(boilerplate_lines(lines.select("line", F.col("site").cast("string").alias("site")), min_sites))
    hits = lines.select("id", "h", "line").join(small(common), "line")
    first = hits.groupBy("line").agg(F.min(F.struct("id", "h")).alias("first"))
    drop = hits.join(small(first.withColumnRenamed("line", "f_line")), F.col("line") == F.col("f_line")).where(~F.struct("id", "h").eqNullSafe(F.col("first")))
    mine = [c for c in docs.columns if c not in ("n_lines", "n_removed", "kept")]
    d_id, d_h, key, gone, stay = (fresh(docs, x) for x in ("drop_id", "drop_h", "drop_key", "drop_lines", "stay"))
    drop = materialize(drop.groupBy("id", "h").agg(F.collect_set("line").alias(gone)).select(F.col("id").alias(d_id), F.col("h").alias(d_h), gone))
    # a broadcast only if its lines were counted and are few
    size = drop.agg(F.sum(F.size(gone))).first()[0] or 0
    joined = docs.select(*mine, text_hash(text).alias(key)).join(
        F.broadcast(drop) if size <= 1_000_000 else drop, F.col(id_col).eqNullSafe(F.col(d_id)) & F.col(key).eqNullSafe(F.col(d_h)), "left")
    every = _lines(text)
    left = F.filter(every, lambda x: ~(x.rlike(NON_SPACE) & F.array_contains(gone, F.xxhash64(x))))
    out = joined.withColumn(stay, F.when(F.col(gone).isNotNull(), left)).withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size(every)).cast("long"))
    out = out.withColumn("n_removed", F.coalesce(F.col("n_lines") - F.size(stay), F.lit(0)).cast("long"))
    out = out.withColumn(text_col, F.when(F.col(stay).isNotNull(), F.array_join(stay, "\n")).otherwise(F.col(text_col)))
    return out.withColumn("kept", (F.col("n_removed") == 0) | F.col(text_col).rlike(NON_SPACE)).select(*mine, "n_lines", "n_removed", "kept")
