"""Bulletin files, dated snapshots and manifests (A1, A2, A3, C11)."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

DATE_IN_NAME = r"_(\d{4}-\d{2}-\d{2})"


def read_bulletins(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One multi-line JSON object per file, with an explicit schema (no inference pass) (A1).

    ``file_name`` and ``snapshot_date`` come from the file metadata: the date stamped in the file's
    name, else the one in its folder's name (Spark's writers name folders, not files).
    """
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    folder = F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]+$", 1)
    stamp = lambda c: F.try_to_date(F.nullif(F.regexp_extract(c, DATE_IN_NAME, 1), F.lit("")), "yyyy-MM-dd")
    return df.withColumn("file_name", F.col("_metadata.file_name")).withColumn("snapshot_date", F.coalesce(stamp(F.col("_metadata.file_name")), stamp(folder)))


def read_snapshots(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Dated immutable snapshots, the date read from a ``snapshot_date=`` partition (A2)."""
    return spark.read.format(fmt).load(path)


def write_snapshot(df: DataFrame, path: str, date: str, partition_cols: tuple[str, ...] = ()) -> str:
    """Append one dated snapshot; an existing snapshot of that date is never rewritten (A2).

    The data is written to a hidden staging folder first and renamed to
    ``path/snapshot_date=<date>`` only after the write job committed. A failed or retried job
    therefore never leaves a partial snapshot for readers (hidden folders are not listed), and a
    second snapshot of the same date is refused."""
    spark = df.sparkSession
    target = f"{path.rstrip('/')}/snapshot_date={date}"
    staging = f"{path.rstrip('/')}/.staging-{date}-{uuid.uuid4().hex[:12]}"
    fs, jpath = _fs(spark, target)
    if fs.exists(jpath):
        raise FileExistsError(f"snapshot {target} exists; snapshots are immutable")
    w = df.write.mode("errorifexists")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.parquet(staging)
    _, jstaging = _fs(spark, staging)
    if not fs.rename(jstaging, jpath):
        raise RuntimeError(f"could not publish snapshot {target}")
    return target


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerlens/{name}-{uuid.uuid4().hex[:12]}"


def purge_scratch(spark: SparkSession, older_than_hours: float = 24.0) -> int:
    """Delete the library's scratch folders under the shared checkpoint folder that were last
    changed before that; returns how many. Results that still read a younger one keep it."""
    fs, root = _fs(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens")
    if not fs.exists(root):
        return 0
    limit = (time.time() - 3600 * older_than_hours) * 1000
    old = [st.getPath() for st in fs.listStatus(root) if st.getModificationTime() < limit]
    for p in old:
        fs.delete(p, True)
    return len(old)


def manifest_status(manifest: DataFrame, entry_col: str, data_col: str, listing: DataFrame, file_col: str) -> DataFrame:
    """Per manifest entry and data file: ``ok`` (file listed), ``missing`` (not listed) or
    ``no_data`` (entry names no file) (A3, C11). The listing is joined, not looped over."""
    files = manifest.select(entry_col, F.explode_outer(data_col).alias(file_col))
    listed = listing.select(file_col).distinct().withColumn("__listed", F.lit(True))
    j = files.join(listed, file_col, "left")
    status = (
        F.when(F.col(file_col).isNull(), F.lit("no_data"))
        .when(F.col("__listed"), F.lit("ok"))
        .otherwise(F.lit("missing"))
    )
    return j.withColumn("status", status).drop("__listed")


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """File listing (path, length, modificationTime) without reading contents."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


def missing(manifest: DataFrame, entry_col: str, data_col: str, listing: DataFrame, file_col: str) -> DataFrame:
    """Manifest files that are not in the listing (C11): the ``missing`` rows of ``manifest_status``."""
    return manifest_status(manifest, entry_col, data_col, listing, file_col).where(F.col("status") == "missing")
