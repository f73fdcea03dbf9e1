"""Session settings and lineage cuts shared by the jobs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# What the jobs expect of a session. Sizes are Spark's own defaults where not listed.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join also where the next step groups by the join key and must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Pages may reach the loading cap of 1 MiB, and an Arrow batch must stay below 2 GiB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

# Frees the shuffle files of a statement when it ends; used where its result has been written.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job relies on (UTC times, adaptive plans)."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir`.

    Where it is unset and all runs on one machine, a folder in the warehouse; on a cluster nothing says that
    executors share one, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_crawlstrata"
    sc.setCheckpointDir(configured)
    return configured


def _stage_root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/stage-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that `drop_staged` removes too."""
    return f"{_stage_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str | None = None, **options: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: a cut of the lineage that any executor
    can read again, with only the columns that later steps name. `drop_staged` removes all of them, and
    `drop_folder` those of one `folder` (a path from `scratch`). What the write shuffled is freed when it ends. `options`
    are the Parquet writer's.
    """
    spark = df.sparkSession
    path = f"{folder or _stage_root(spark)}/rows-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a path from `scratch` and what was staged in it; call it when all that is made of it has been written."""
    if not folder.startswith(f"{_stage_root(spark)}/"):
        raise ValueError(f"{folder} is not a staged folder of this application")
    _delete(spark, folder)


def drop_staged(spark: SparkSession) -> None:
    """Delete what this application staged; call it when its results have been written."""
    _delete(spark, _stage_root(spark))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The same rows, written once, so that later passes all read the same ones."""
    return stage(df)
