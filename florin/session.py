"""Session defaults, the shared folder, lineage cutting."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "florin", **confs: str) -> SparkSession:
    """A session with the settings the plans expect; extra confs override them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
        "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
        "spark.ui.enabled": "false",
        # A checkpoint goes when nothing refers to its frame any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # The whole report generates more classes than the default cache holds.
        "spark.sql.codegen.cache.maxEntries": "2000",
        # Call-site capture on every column expression is only useful while debugging.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **confs,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; without that setting it lies in the
    warehouse, which driver and executors share, too.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_florin"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute once into reliable storage, so later actions do not recompute the plan.

    The plan's shuffle files go as soon as the result is stored; nothing reads them again.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        own_plan = df.select("*")
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    return own_plan.checkpoint(eager=True)


def remove(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it is missing."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(hadoop) if s.isDirectory()] if store.exists(hadoop) else []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
