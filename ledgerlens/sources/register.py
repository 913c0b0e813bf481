"""The keyed register: citation harvest, stats, watermark, merge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import extract_ids
from ..operators.windows import latest_per_key

REGISTER_SCHEMA = (
    "id long, kind string, date timestamp, entity string, title string, url string, cited boolean, fetched_at timestamp"
)


def harvest_citations(docs: DataFrame, text_col: str, pattern: str, id_col: str = "id", doc_col: str | None = None) -> DataFrame:
    """Every id matching ``pattern`` (group 1) in whole texts, one row per (document, id) (A4, H5)."""
    keep = [doc_col] if doc_col else []
    return docs.select(*keep, F.explode(extract_ids(text_col, pattern)).alias(id_col)).distinct()


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Register stored as Parquet partitioned by kind and year (A8); filters on kind/date prune."""
    return spark.read.parquet(path)


def write_register(df: DataFrame, path: str, mode: str = "overwrite", files: int = 8) -> None:
    """Write the register partitioned by (kind, year), rows clustered by date inside files. A
    (kind, year) is dealt to ``files`` tasks by id, so a hot one is not one task."""
    out = df.withColumn("year", F.year("date")).withColumn("__f", F.pmod(F.xxhash64("id"), F.lit(files)))
    out = out.repartition("kind", "year", "__f").drop("__f").sortWithinPartitions("kind", "year", "date")
    out.write.mode(mode).partitionBy("kind", "year").parquet(path)


def merge_registers(dfs: Sequence[DataFrame], key: Sequence[str], order: Sequence[str], carry_max: Sequence[str] = ()) -> DataFrame:
    """Merge parallel backfills: union by name, then one row per key (newest wins)."""
    u = None
    for d in dfs:
        u = d if u is None else u.unionByName(d, allowMissingColumns=True)
    return latest_per_key(u, list(key), list(order), carry_max)


def watermark(df: DataFrame, kind: str, date: str) -> DataFrame:
    """Last indexed date per kind: drives the next increment."""
    return df.groupBy(kind).agg(F.max(date).alias("last_indexed"))


def adhoc_sql(spark: SparkSession, sql: str, args: Mapping[str, object] | None = None, **views: DataFrame) -> DataFrame:
    """Ad-hoc SQL over named DataFrames (J2): ``{name}`` stands for a frame, ``:name`` for a value of
    ``args``. Values are parameters, never part of the text."""
    return spark.sql(sql, args=dict(args or {}), **views)


def save_register(df: DataFrame, table: str, path: str, entity: str, date: str, buckets: int = 32) -> None:
    """The register as a table at ``path`` that is partitioned by year, bucketed by ``entity`` and
    sorted by (entity, date) (A8). Each bucket of a year is one sorted file. A look-up by entity reads one
    bucket, one by date the years' folders, and joins and upserts by entity need no shuffle of it."""
    out = df.withColumn("year", F.year(date)).repartition(buckets, entity)
    out.write.mode("overwrite").partitionBy("year").bucketBy(buckets, entity).sortBy(entity, date).option("path", path).saveAsTable(table)


def entity_range(spark: SparkSession, table: str, entity: str, value, date: str, date_from, date_to) -> DataFrame:
    """Rows of one entity with date_from <= date < date_to from a ``save_register`` table."""
    lo, hi = F.lit(date_from).cast("timestamp_ntz"), F.lit(date_to).cast("timestamp_ntz")
    rows = spark.table(table).where(F.col("year").between(int(str(date_from)[:4]), int(str(date_to)[:4])))
    return rows.where((F.col(entity) == F.lit(value)) & (F.col(date) >= lo) & (F.col(date) < hi))


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Text files below ``path``, one row a file: (path, length, text) (A4). Files are dealt to tasks whole."""
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("length"), F.col("value").alias("text"))
