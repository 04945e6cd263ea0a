"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH = 1_000  # rows of a batch that goes to Python: some MB of documents, where Spark's 10,000 are tens of MB in the JVM and in Python each


def local_session(cores: int | str = 8, name: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def small_batches(spark: SparkSession) -> None:
    """From now on the session sends at most ``BATCH`` rows at a time to Python; a smaller number stays."""
    if not 0 < int(spark.conf.get(BATCH_KEY)) <= BATCH:
        spark.conf.set(BATCH_KEY, str(BATCH))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local master, where driver and executors are one process, may fall
    back to a temporary folder of this machine.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.conf.get("spark.master", "local").partition("[")[0] == "local":
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """An unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def discard(settled: DataFrame) -> None:
    """Remove the files of a table that ``settle`` wrote and that nothing reads any more."""
    spark = settled.sparkSession
    for folder in {name.rpartition("/")[0] for name in settled.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    The lineage ends at files that outlive any executor, and Catalyst then
    knows the true size of the table, so its own threshold decides whether
    joins with it may broadcast.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
