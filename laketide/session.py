"""Session settings the pipeline relies on.

Library functions never create a session: every public function takes the
caller's ``SparkSession`` (or DataFrames).  ``build_session`` is for tests,
the bench and local runs only.
"""

from __future__ import annotations

import contextlib
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the pipeline expects, whatever the cluster size.
SESSION_CONF = {
    # Spark 4 defaults to ANSI mode; cleaning uses try_* forms so bad
    # input becomes NULL instead of failing the job.
    "spark.sql.ansi.enabled": "true",
    # Dates and times are compared as calendar values: pin the zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn sort-merge into broadcast when a side turns out
    # small at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rewriting one date partition must leave the other dates alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "laketide",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests (UI off, pipeline settings on)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable pipeline settings to an existing session."""
    for k, v in SESSION_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: leave it
            pass


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Read from ``spark.checkpoint.dir``; only when it is unset (local runs,
    tests) a scratch folder is created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
    # a local run or a test
    local = tempfile.mkdtemp(prefix="laketide-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def cut_lineage(df, name: str = "table"):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it
    back.

    Used where a derived plan is read several times: it is computed once
    (a reliable ``checkpoint()`` computes it twice unless cached), the copy
    survives executor loss (unlike a local checkpoint), and the reader gets
    file statistics Catalyst and AQE use for their size-checked join
    choices.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


@contextlib.contextmanager
def stored(df, name: str = "table"):
    """:func:`cut_lineage` for as long as the block runs; the copy is deleted
    behind it."""
    from laketide.sources.tables import delete_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_path(spark, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local folder on a cluster)."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/laketide-scratch/{name}-{uuid.uuid4().hex[:12]}"
