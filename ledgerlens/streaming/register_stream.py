"""Structured Streaming versions of the register logic.

Every stream reads a folder of Parquet files (the landing folder), runs with
``trigger(availableNow=True)`` and keeps its checkpoint and outputs under the session's shared
checkpoint folder, so a restarted driver or a lost executor resumes from the last committed epoch.
An epoch writes the ``epoch=`` partition of its number and overwrites it if it runs again; tables
are read as the newest rows over the epochs. All of it is plain Spark reads and writes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from ..operators.joins import bounded
from ..operators.windows import latest_per_key, revisions
from ..sources.bulletins import scratch_path


def _source(spark: SparkSession, landing: str, schema, max_files: int = 3) -> DataFrame:
    """The landing folder as a stream; a folder that is not there yet becomes an empty one."""
    try:
        spark.read.schema(schema).parquet(landing)
    except AnalysisException:
        spark.createDataFrame([], schema).write.mode("append").parquet(landing)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(landing)


def _run(writer, checkpoint: str) -> None:
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """An epoch's rows as its partition; the same epoch again replaces them."""
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_epochs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All epochs' rows with their ``epoch`` number; a table without epochs is empty."""
    with_epoch = StructType([*schema.fields]).add("epoch", LongType())
    try:
        return spark.read.schema(with_epoch).option("basePath", path).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], with_epoch)


def stream_register(
    spark: SparkSession,
    landing: str,
    schema,
    key: Sequence[str],
    order: Sequence[str],
    work_dir: str | None = None,
    carry_max: Sequence[str] = (),
    keep_first: Sequence[str] = (),
) -> DataFrame:
    """Incremental register (I1, I2 by key): each micro-batch's newest row per key is an epoch of
    the register, which is read as the newest row per key over the epochs, whatever the order of
    arrival. ``keep_first`` columns keep their oldest value; an epoch then keeps all its rows.
    Returns the register after the stream has caught up. ``compact_register`` bounds the epochs."""
    work = work_dir or scratch_path(spark, "register-stream")

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch if keep_first else latest_per_key(batch, key, order, carry_max), f"{work}/register", epoch)

    _run(_source(spark, landing, schema).writeStream.foreachBatch(write), f"{work}/checkpoint")
    return current_register(spark, f"{work}/register", schema, key, order, carry_max, keep_first)


def current_register(
    spark: SparkSession, path: str, schema: StructType, key: Sequence[str], order: Sequence[str], carry_max: Sequence[str] = (), keep_first: Sequence[str] = ()
) -> DataFrame:
    """The register that the epochs under ``path`` add up to: one row per key."""
    return latest_per_key(read_epochs(spark, path, schema).drop("epoch"), key, order, carry_max, keep_first)


def compact_register(
    spark: SparkSession, path: str, target: str, schema: StructType, key: Sequence[str], order: Sequence[str], carry_max: Sequence[str] = (), keep_first: Sequence[str] = ()
) -> DataFrame:
    """The register as one epoch of a new folder, in which later epochs go on; an ordinary write.

    It becomes the lowest epoch (-1). ``keep_first`` values are the oldest ones of all epochs so far,
    on the row of the newest version; a later epoch with a still older version needs the old folder."""
    write_epoch(current_register(spark, path, schema, key, order, carry_max, keep_first), target, -1)
    return current_register(spark, target, schema, key, order, carry_max, keep_first)


def dedup_stream(
    spark: SparkSession, landing: str, schema, key: Sequence[str], ts_col: str, delay: str = "4 days", work_dir: str | None = None
) -> DataFrame:
    """Re-delivered rows dropped by key while the watermark still covers them.

    State holds the keys seen within ``delay`` of the newest event time, so it is bounded by
    the rows of that time span, not by the whole history; ``delay`` must exceed the lateness of
    a re-delivery (here: files carry at most the previous file's days again)."""
    work = work_dir or scratch_path(spark, "dedup-stream")
    src = _source(spark, landing, schema).withColumn("__wm", F.col(ts_col).cast("timestamp"))
    dedup = src.withWatermark("__wm", delay).dropDuplicatesWithinWatermark(list(key)).drop("__wm")
    _run(dedup.writeStream.foreachBatch(lambda batch, epoch: write_epoch(batch, f"{work}/out", epoch)), f"{work}/checkpoint")
    return read_epochs(spark, f"{work}/out", schema).drop("epoch")


_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def daily_counts_stream(
    spark: SparkSession, landing: str, schema, ts_col: str, kind_col: str, work_dir: str | None = None, delay: str = "7 days"
) -> DataFrame:
    """Count per day and kind (tumbling one-day windows) with a watermark.

    State holds the windows that ``delay`` still covers; rows later than that are not counted.
    Update mode: an epoch holds the counts that its batch changed, and the newest epoch of a day and
    kind counts. Windows are over the wall-clock value read as UTC, so day boundaries do not move
    with the session time zone."""
    work = work_dir or scratch_path(spark, "daily-stream")
    src = _source(spark, landing, schema).withColumn("__wm", F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {_EPOCH}, `{ts_col}`))"))
    agg = src.withWatermark("__wm", delay).groupBy(F.window("__wm", "1 day").alias("w"), kind_col).agg(F.count(F.lit(1)).alias("n"))
    kind = schema[kind_col].dataType.simpleString()
    counts = StructType.fromDDL(f"day timestamp_ntz, `{kind_col}` {kind}, n long")

    def write(batch: DataFrame, epoch: int) -> None:
        day = F.expr(f"timestampadd(MICROSECOND, unix_micros(w.start), {_EPOCH})")
        write_epoch(batch.select(day.alias("day"), kind_col, "n"), f"{work}/daily", epoch)

    _run(agg.writeStream.outputMode("update").foreachBatch(write), f"{work}/checkpoint")
    return read_epochs(spark, f"{work}/daily", counts).groupBy("day", kind_col).agg(F.max_by("n", "epoch").alias("n"))


def speed_merge(batch: DataFrame, speed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Speed layer over batch layer (I4): batch rows win; speed rows only for keys the batch
    does not have yet. ``layer`` says where each row came from."""
    b = batch.withColumn("layer", F.lit("batch"))
    s = speed.join(batch.select(*key), list(key), "left_anti").withColumn("layer", F.lit("speed"))
    return b.unionByName(s)


def verify_patches(patches: DataFrame, batch: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The next batch re-verifies pending patches (I4): per patch its values, the batch's as
    ``batch_<value>`` and ``verdict``: ``confirmed`` (all equal, nulls too), ``corrected`` (the batch
    says otherwise) or ``missing`` (the batch has no such key). ``key`` is unique in the batch."""
    seen = batch.select(*key, *(F.col(v).alias(f"batch_{v}") for v in values), F.lit(True).alias("__seen"))
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"batch_{v}"))
    verdict = F.when(F.col("__seen").isNull(), "missing").when(same, "confirmed").otherwise("corrected")
    return patches.join(seen, list(key), "left").withColumn("verdict", verdict).drop("__seen")


def speed_layer_stream(spark: SparkSession, landing: str, schema, where=None, work_dir: str | None = None) -> DataFrame:
    """Collect the speed layer from the stream (append log, one folder per epoch)."""
    work = work_dir or scratch_path(spark, "speed-stream")
    src = _source(spark, landing, schema)
    if where is not None:
        src = src.where(where)
    _run(src.writeStream.foreachBatch(lambda batch, epoch: write_epoch(batch, f"{work}/out", epoch)), f"{work}/checkpoint")
    return read_epochs(spark, f"{work}/out", schema).drop("epoch")


def revision_stream(
    spark: SparkSession,
    landing: str,
    schema,
    key: Sequence[str],
    value: str,
    version: str = "version",
    work_dir: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Late corrections (I5): rows carry the number of their delivery in ``version``, so files may
    arrive in any order and number.

    A micro-batch is appended to the log as its epoch. The ledger (every change of ``value`` between
    consecutive versions of a key, E8) is kept up by a stream-static join: only the keys of the batch
    are looked up in the log and their entries written again, as this epoch's; a key's newest epoch
    counts. A run therefore reads the new files and those keys' history, and a late older version
    goes between the entries that it splits. Returns (current, ledger): the newest version per key,
    and the ledger; both are empty for an empty landing folder."""
    work = work_dir or scratch_path(spark, "revision-stream")
    log, ledger = f"{work}/log", f"{work}/ledger"
    keys = list(key)
    entry = StructType([schema[k] for k in (*keys, version, value)]).add("old_value", schema[value].dataType).add("old_version", schema[version].dataType)

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(batch, log, epoch)
        touched = bounded(batch.select(*keys).distinct())
        history = read_epochs(spark, log, schema).join(touched, keys, "left_semi").select(*keys, version, value).distinct()
        # versions of one key are few (one per delivery), so the per-key window is small
        write_epoch(revisions(history, keys, version, value).select(*entry.fieldNames()), ledger, epoch)

    _run(_source(spark, landing, schema).writeStream.foreachBatch(write), f"{work}/checkpoint")
    current = latest_per_key(read_epochs(spark, log, schema).drop("epoch"), keys, [version])
    newest = F.max("epoch").over(Window.partitionBy(*keys))
    entries = read_epochs(spark, ledger, entry).withColumn("__newest", newest).where(F.col("epoch") == F.col("__newest"))
    return current, entries.select(*entry.fieldNames())
