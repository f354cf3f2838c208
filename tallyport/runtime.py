"""Session helpers: the shared folder for intermediate results, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, may fall
    back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tallyport-")
    context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession) -> str:
    """The part of the shared folder that belongs to this application."""
    return f"{shared_folder(spark).rstrip('/')}/tallyport/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{work_folder(spark)}/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small result, so that later passes see the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def settings(spark: SparkSession, **held: str) -> Iterator[None]:
    """Session settings (``__`` for a dot) for what is run inside; then they are as they were."""
    names = {name.replace("__", "."): value for name, value in held.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def settle_table(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there.

    For results as large as a table: unlike a checkpoint they are compressed, and later
    passes read only the columns they need.  What the write has shuffled is deleted when it is
    done, not when the driver happens to collect its garbage.  ``options`` go to the writer.
    """
    path = work_path(df.sparkSession, label)
    with settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_work(spark: SparkSession) -> None:
    """Delete what this application wrote with :func:`work_path` and
    :func:`settle_table`; frames that read it are no longer usable."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def default_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def local_session(cores: int | str = 8, app: str = "tallyport") -> SparkSession:
    """A local session for tests and benchmarks."""
    parallel = 8 if cores == "*" else int(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(parallel))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
