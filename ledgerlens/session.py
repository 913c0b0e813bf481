"""Session helpers: local defaults for tests and benches, cluster settings untouched."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
    "spark.sql.ansi.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", app: str = "ledgerlens") -> SparkSession:
    """A local session for tests and the bench. On a cluster, build your own session."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_scratch: dict[str, str] = {}  # application id -> the folder taken for it


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset and the master is local (tests) a fresh scratch folder is taken, once per
    application; a cluster without the setting is an error, since a machine-local folder would not
    survive. A folder that the application has set itself is kept.
    """
    sc = spark.sparkContext
    now = sc._jsc.sc().getCheckpointDir()
    d = spark.conf.get("spark.checkpoint.dir", None) or _scratch.get(sc.applicationId) or (now.get() if now.isDefined() else None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (checkpoints and stream state live there)")
        d = _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not now.isDefined():
        sc.setCheckpointDir(d)
    return d


TASKS_PER_CORE = 4  # of rows dealt out anew: short tasks even out what rows cost


def spread(df):
    """``df`` dealt round-robin, several tasks per core, if one split of its scan has more than a core's share of the rows.

    For work that is heavy for each row. The number of splits does not tell: a row group is read by one
    of the splits that a file is cut into, and the others are empty. So the rows of each split are counted, which
    reads no columns; a scan that is even is left as it is, so large inputs in many files are not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = df.groupBy(F.spark_partition_id().alias("split")).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    return df.repartition(TASKS_PER_CORE * cores) if n["most"] and n["most"] * cores > n["all"] else df


# called with each materialised frame once it has run; set by the plan audit only
recorder = None


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, release: bool = False):
    """Compute a small intermediate once and cut its lineage (reliable checkpoint in the shared
    checkpoint folder; never a local checkpoint).

    Used for aggregates bounded by a dimension (places, sectors, periods) that several branches
    of one query read: without it every branch would re-scan the fact tables under it, because
    differently pruned branches do not share exchanges.

    ``release``: the job's shuffle files go when its result is written, not whenever the driver next
    collects its garbage, so the jobs of a query do not add up on the executors' disks (from Spark 4.1;
    before, the setting does nothing). Nothing reads them again: the plan that wrote them is run here only.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if release:
        before = spark.conf.get(_FREE_SHUFFLES, None)
        spark.conf.set(_FREE_SHUFFLES, "true")
        try:
            df = df.select("*")  # a plan takes the setting when it is made
        finally:
            spark.conf.unset(_FREE_SHUFFLES) if before is None else spark.conf.set(_FREE_SHUFFLES, before)
    out = df.checkpoint(eager=True)
    if recorder is not None:
        recorder(df)
    return out
