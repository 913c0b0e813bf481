"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Each rule measures a share of a document (symbols, repeated lines, ...) and rejects above a cutoff.
A cutoff is chosen for each rule and stratum from labelled documents: going down a fixed grid from
the mildest cutoff, a cutoff is certified while the exact binomial test rejects "this rule rejects
more than alpha/rules of the good documents of this stratum" at level delta/(rules * strata). The
grid is walked in a fixed order (fixed-sequence testing), so only rules and strata need the
Bonferroni correction. With probability 1-delta, in every stratum at most alpha of the good
documents are rejected by the rules. A stratum with too few labels gets no cutoffs and rejects nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerlens.session import materialize

from ._spans import fresh, small, text_hash

SPACE = "[\\x20\\x09-\\x0D]+"
NON_SPACE = "[^\\x20\\x09-\\x0D]"
RULES = ("symbols", "dup_lines", "repeats", "upper", "same_words")
CUTOFFS = (0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.65, 0.6, 0.55, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.12, 0.1, 0.08, 0.06, 0.04, 0.02, 0.01)
ALPHA, DELTA = 0.02, 0.05


def measures(docs: DataFrame, text: Column, keep: dict[str, Column], window: int = 5) -> DataFrame:
    """``keep`` and the counts of each row's text (null: no words)."""
    step0 = docs.select(*(c.alias(k) for k, c in keep.items()), F.coalesce(text.cast("string"), F.lit("")).alias("q_text"))
    step1 = step0.select(
        *keep, F.filter(F.split("q_text", SPACE), lambda w: w != "").alias("q_words"), F.length("q_text").alias("q_len"),
        F.filter(F.split("q_text", "\n"), lambda line: line.rlike(NON_SPACE)).alias("q_lines"),
        F.regexp_count("q_text", F.lit("[#*$%&|<>]")).alias("n_symbols"), F.regexp_count("q_text", F.lit("\\p{Lu}")).alias("n_upper"))
    step2 = step1.select(
        *keep, F.size("q_words").cast("long").alias("n_words"), F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"), F.col("n_upper").cast("long").alias("n_upper"), F.size("q_lines").cast("long").alias("n_lines"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("q_words", lambda w: F.xxhash64(w)).alias("q_h"))
    counts = ["n_words", "word_chars", "n_symbols", "n_upper", "n_lines", "n_dup_lines"]
    none = F.array().cast("array<long>")
    step3 = step2.select(
        *keep, *counts, F.size(F.array_distinct("q_h")).cast("long").alias("n_distinct_words"),
        F.when(F.col("n_words") >= window, F.transform(F.sequence(F.lit(0), F.size("q_h") - window), lambda i: F.xxhash64(*(F.get("q_h", i + k) for k in range(window)))))
        .otherwise(none).alias("q_w"))
    # only texts that hold a window twice are sorted
    step4 = step3.select(
        *keep, *counts, "n_distinct_words",
        F.when(F.size(F.array_distinct("q_w")) < F.size("q_w"), F.sort_array(F.transform("q_w", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("q_s"))
    step5 = step4.select(
        *keep, *counts, "n_distinct_words",
        F.sort_array(F.transform(
            F.filter("q_s", lambda x, i: (x["h"] == F.get("q_s", i - 1)["h"]) | (x["h"] == F.get("q_s", i + 1)["h"])), lambda x: x["i"])).alias("q_p"))
    covered = F.aggregate(
        F.transform("q_p", lambda p, i: F.least(F.lit(window), F.coalesce(F.get("q_p", i + 1) - p, F.lit(window)))), F.lit(0).cast("long"), lambda a, x: a + x)
    return step5.select(*keep, *counts, "n_distinct_words", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _share(a, b) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def rule_values() -> dict[str, Column]:
    """Each rule's share of a measured row, high is bad."""
    return {
        "symbols": _share("n_symbols", "word_chars"), "dup_lines": _share("n_dup_lines", "n_lines"), "repeats": _share("n_repeat_words", "n_words"),
        "upper": _share("n_upper", "word_chars"), "same_words": F.when(F.col("n_words") > 0, 1 - F.col("n_distinct_words") / F.col("n_words")).otherwise(F.lit(0.0))}


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def _ln_factorial(x: Column) -> Column:
    x = x.cast("double")
    big = (x + 0.5) * F.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * F.pow(x, F.lit(3.0))) + 1 / (1260 * F.pow(x, F.lit(5.0)))
    return F.when(x < 20, F.log(F.factorial(F.least(x, F.lit(20.0)).cast("int")).cast("double"))).otherwise(big)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k), exact; 1 where k is not under the mean (no test passes there)."""
    log_term = _ln_factorial(n) - _ln_factorial(k) - _ln_factorial(n - k) + k * F.log(F.lit(p)) + (n - k) * F.log(F.lit(1 - p))
    # terms below k, relative to term k, fall at least geometrically; beyond these none counts
    many = F.least(k, (60 * F.sqrt(k + 1) + 60).cast("long"))
    start = F.struct(F.lit(1.0).alias("sum"), F.lit(1.0).alias("term"))

    def add(acc, i):
        term = acc["term"] * (k - i + 1) / (n - k + i) * ((1 - p) / p)
        return F.struct((acc["sum"] + term).alias("sum"), term.alias("term"))

    total = F.aggregate(F.when(many > 0, F.sequence(F.lit(1).cast("long"), many)).otherwise(F.array().cast("array<long>")), start, add, lambda acc: acc["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_term) * total))


def certified_cutoffs(good: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected, p_value) of the strictest certified cutoff of each stratum and rule.

    ``good``: one row per good labelled document with its stratum and measures."""
    grid = F.array(*(F.lit(c) for c in CUTOFFS))
    values = rule_values()
    long = good.select("stratum", F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), values[r].alias("x")) for r in RULES))).alias("v")).select(
        "stratum", "v.rule", F.size(F.filter(grid, lambda c: F.col("v.x") <= c)).alias("step"))  # rejected from this step on
    counted = long.groupBy("stratum", "rule", "step").agg(F.count("*").alias("m"))
    # everything from here on has a row per stratum, rule and step
    strata = F.size(F.collect_set("stratum").over(Window.partitionBy(F.lit(1))))
    whole = counted.groupBy("stratum", "rule").agg(F.sum("m").alias("n"), F.map_from_entries(F.collect_list(F.struct("step", "m"))).alias("by_step")).withColumn("strata", strata)
    steps = whole.select("stratum", "rule", "n", "strata", "by_step", F.posexplode(grid).alias("j", "cutoff")).withColumn(
        "rejected", F.aggregate(F.map_values(F.map_filter("by_step", lambda s, _: s <= F.col("j"))), F.lit(0).cast("long"), lambda a, m: a + m))
    tested = steps.withColumn("p_value", binomial_tail(F.col("n"), F.col("rejected"), alpha / len(RULES))).withColumn(
        "ok", F.col("p_value") <= delta / (len(RULES) * F.col("strata")))
    walk = Window.partitionBy("stratum", "rule").orderBy("j")
    passed = tested.withColumn("so_far", F.min(F.col("ok").cast("int")).over(walk)).where("so_far = 1")
    return passed.groupBy("stratum", "rule").agg(F.min_by(F.struct("cutoff", "n", "rejected", "p_value"), "cutoff").alias("c")).select("stratum", "rule", "c.*")


def quality_verdicts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str | None = "lang",
                     label_col: str = "quality", alpha: float = ALPHA, delta: float = DELTA) -> tuple[DataFrame, DataFrame]:
    """Verdicts, one for each row of ``docs``, and the certified cutoffs.

    Verdict columns: id, text_hash (xxhash64, null for a null text), n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, failed_rules, kept. Good labelled documents are those
    with a label 1 (of several labels of an id the highest counts, null ones do not) that pass the
    base test; repeated document rows count as documents each. A null stratum is a stratum; a null
    id has no label; a null text has no words and fails the base test. Very long texts are measured
    whole, inside their row. Other columns of the tables are not read. No labels: only the base test
    rejects. No rows: no verdicts.
    """
    stratum = F.col(stratum_col).cast("string") if stratum_col else F.lit("all")
    keep = {"id": F.col(id_col), "text_hash": text_hash(F.col(text_col)), "stratum": F.coalesce(F.concat(F.lit("="), stratum), F.lit("null"))}
    rows = materialize(measures(docs, F.col(text_col), keep).withColumn("base_failed", base_failed()))
    good = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).where("id IS NOT NULL").distinct()
    cutoffs = materialize(certified_cutoffs(rows.where("NOT base_failed").join(good, "id", "left_semi"), alpha, delta))
    by_stratum = cutoffs.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    joined = rows.join(by_stratum.select(F.col("stratum").alias("of"), *(F.col(r).alias(f"c_{r}") for r in RULES)), F.col("stratum") == F.col("of"), "left")
    failed = F.array_compact(F.array(*(F.when(v > F.col(f"c_{r}"), F.lit(r)) for r, v in rule_values().items())))
    out = joined.select("id", "text_hash", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", failed.alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).withColumnRenamed("id", id_col), cutoffs


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    verdicts, _ = quality_verdicts(docs, labels, id_col, text_col, **kw)
    of, hashed = fresh(docs, "kept_id"), fresh(docs, "kept_hash")
    keys = materialize(verdicts.where("kept").select(F.col(id_col).alias(of), F.col("text_hash").alias(hashed)).distinct())
    return docs.join(small(keys), F.col(id_col).eqNullSafe(F.col(of)) & text_hash(F.col(text_col)).eqNullSafe(F.col(hashed)), "left_semi")
