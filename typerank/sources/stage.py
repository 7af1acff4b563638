"""Intermediate tables on the shared folder of the cluster.

A staged table cuts the lineage, survives the loss of executors, and has a known
size, so the adaptive planner can choose a broadcast or split a skewed join side.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_written: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``, else the warehouse of the session.

    Both are shared by all executors; a folder of one machine is never used.
    """
    for setting in ("spark.checkpoint.dir", "spark.sql.warehouse.dir"):
        folder = spark.conf.get(setting, None)
        if folder:
            return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/typerank-{name}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as a parquet table to the shared folder and read it back."""
    return stored(df, new_folder(df.sparkSession, name))


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a parquet table to ``path`` and read it back. The shuffles of the write,
    which nothing reads again, are deleted when it ends, not when the driver happens to
    collect its garbage, so the disk holds those of one table at a time."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def drop(table: DataFrame) -> None:
    """Delete the staged folders that ``table`` reads; other files stay."""
    spark = table.sparkSession
    written = _written.get(spark.sparkContext.applicationId, [])
    files = table.inputFiles()
    for path in [p for p in written if any(p.rsplit("/", 1)[1] in f for f in files[:1])]:
        _delete(spark, path)
        written.remove(path)


def clear(spark: SparkSession) -> int:
    """Delete the tables that this application has staged; their number.

    Call it when a run's results are written: what still reads a staged table fails.
    """
    paths = _written.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        _delete(spark, path)
    return len(paths)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
