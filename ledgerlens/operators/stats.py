"""Correlation and fit.

Inputs are entity-level panels (one row per entity), as in the reference: correlations are taken
over the key set present in both series. Ranks for Spearman are mean ranks on ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pearson(df: DataFrame, y: str, x: str) -> DataFrame:
    """Pearson r and n over rows where both are present."""
    both = df.where(F.col(y).isNotNull() & F.col(x).isNotNull())
    return both.agg(F.corr(y, x).alias("pearson_r"), F.count(F.lit(1)).alias("n"))


def spearman(df: DataFrame, y: str, x: str) -> DataFrame:
    """Spearman rho = Pearson r of mean ranks.

    Ranks come from ``windows.global_rank`` (distributed, ties share the mean position), so a
    row-level input of any size is ranked without a single-partition window."""
    from .windows import global_rank

    both = df.where(F.col(y).isNotNull() & F.col(x).isNotNull()).select(F.col(y).alias("__y"), F.col(x).alias("__x"))
    ranked = global_rank(global_rank(both, "__y", "__ry", ties="mean"), "__x", "__rx", ties="mean")
    return ranked.agg(F.corr("__ry", "__rx").alias("spearman_rho"), F.count(F.lit(1)).alias("n"))


def partial_corr(df: DataFrame, y: str, x: str, z: str) -> DataFrame:
    """First-order partial correlation of y and x controlling for z."""
    both = df.where(F.col(y).isNotNull() & F.col(x).isNotNull() & F.col(z).isNotNull())
    r = both.agg(F.corr(y, x).alias("rxy"), F.corr(y, z).alias("ryz"), F.corr(x, z).alias("rxz"), F.count(F.lit(1)).alias("n"))
    num = F.col("rxy") - F.col("ryz") * F.col("rxz")
    den = F.sqrt((1 - F.col("ryz") ** 2) * (1 - F.col("rxz") ** 2))
    return r.select(F.try_divide(num, F.nullif(den, F.lit(0.0))).alias("partial_r"), "rxy", "ryz", "rxz", "n")


def loglog_fit(df: DataFrame, key: str, y: str, x: str) -> DataFrame:
    """Least squares of log10(y) on log10(x) over positive pairs; residual per key.

    The fit is a one-row aggregate broadcast back to the rows.
    """
    pos = df.where((F.col(y) > 0) & (F.col(x) > 0)).select(
        key, F.log10(y).alias("log_y"), F.log10(x).alias("log_x")
    )
    fit = pos.agg(
        F.regr_slope("log_y", "log_x").alias("slope"),
        F.regr_intercept("log_y", "log_x").alias("intercept"),
        F.corr("log_y", "log_x").alias("r"),
    )
    return (
        pos.crossJoin(F.broadcast(fit))
        .withColumn("fitted", F.col("intercept") + F.col("slope") * F.col("log_x"))
        .withColumn("residual", F.col("log_y") - F.col("fitted"))
    )


def extremes(df: DataFrame, value: str, key: str, k: int) -> DataFrame:
    """Top ``k`` over- and under-performers by ``value`` (F4): two ordered limits, unioned."""
    over = df.orderBy(F.col(value).desc(), F.col(key)).limit(k).withColumn("side", F.lit("over"))
    under = df.orderBy(F.col(value).asc(), F.col(key)).limit(k).withColumn("side", F.lit("under"))
    return over.unionByName(under)


def corr_matrix(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """Pearson r of ``y`` against each column in ``xs``, each over the rows where both are
    present (D13). One aggregate pass; one output row per x."""
    aggs = []
    for x in xs:
        both = F.col(y).isNotNull() & F.col(x).isNotNull()
        aggs += [
            F.corr(F.when(both, F.col(y)), F.when(both, F.col(x))).alias(f"r__{x}"),
            F.count_if(both).alias(f"n__{x}"),
        ]
    wide = df.agg(*aggs)
    stacked = F.stack(F.lit(len(xs)), *[v for x in xs for v in (F.lit(x), F.col(f"r__{x}"), F.col(f"n__{x}"))])
    return wide.select(stacked.alias("x", "pearson_r", "n"))
