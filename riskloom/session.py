"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans here rely on.

    The feature view is one projection of about a hundred expressions. Fused into a
    single generated method it passes HotSpot's 8,000-byte limit, is never compiled, and
    ran six times slower than unfused on six million rows. The lower method limit lets
    Spark fall back for exactly those stages; narrow stages stay fused.
    """
    settings = {
        "spark.sql.codegen.hugeMethodLimit": "8000",
        "spark.sql.codegen.maxFields": "300",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # parts of one partition each stay tasks of their own when they are put together
        "spark.sql.unionOutputPartitioning": "false",
        # batches that Python stages hold are bounded by bytes, not only by rows
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "riskloom", cores: int | str = "*", memory: str = "16g") -> SparkSession:
    """A local session for tests and the bench; on a cluster, pass your own to ``tune``."""
    n = os.cpu_count() if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        # call-site capture costs milliseconds on every Column call
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        context = spark.sparkContext
        folder = context.getCheckpointDir()
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-"))
            folder = context.getCheckpointDir()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/riskloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder."""
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> None:
    """Deletes what this application has settled; a job calls it when its results are written."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Input in fewer pieces than there are cores, such as one small file, cut by key.

    A Parquet row group is read by one task, and without a shuffle that task would do all
    the work of every stage up to the next one. Large input is returned as it is, and so is
    a plan with an exchange: its rows are dealt out already, and asking adaptive execution
    for its pieces would run it.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def settle(df: DataFrame, key: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    Iterative fits read their input many times; from files, a lost executor costs a
    re-read and not a recomputation of everything upstream.
    """
    path = scratch_path(df.sparkSession, "settled")
    spread(df, key).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
