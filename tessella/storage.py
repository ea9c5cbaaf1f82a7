"""Shared storage for intermediate tables: what cuts lineage must outlive any one executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, else the session's checkpoint folder.

    Where neither is set, a session whose executors are threads of this process gets a temporary
    folder; on a cluster that would be a different disk for each executor, so it is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessella-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder for files in the shared folder, as a path that Python and Spark open."""
    path = _new_path(spark, tag)
    if path.startswith("file:"):
        return path.removeprefix("file://").removeprefix("file:")
    if "://" in path:
        raise RuntimeError(f"files need a folder that is mounted on all executors, not {path}")
    return path


def _new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder; the JVM's end removes what is there."""
    path = f"{shared_dir(spark)}/tessella/{tag}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    # The file system keeps the path only if it exists; the write that follows puts files into the folder.
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target)
    system.deleteOnExit(target)
    return path


def write_through(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    path = append_through(df, tag)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_through(df: DataFrame, tag: str, path: str | None = None) -> str:
    """Add the rows of ``df`` to the Parquet table at ``path`` (None: a new one in the shared folder); its path."""
    path = path or _new_path(df.sparkSession, tag)
    df.write.mode("append").parquet(path)
    return path


def dealt_out(spark: SparkSession) -> int:
    """Partitions for few rows that make much work: a number given to ``repartition`` is kept, while tables that
    look small are otherwise put together into one task."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
