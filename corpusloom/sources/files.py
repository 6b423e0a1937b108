"""File checks through the file system Spark itself uses for a path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def join(folder: str, *names: str) -> str:
    return "/".join([folder.rstrip("/"), *names])


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = _path(spark, path)
    return bool(system.exists(hadoop))


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    hadoop, system = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in system.globStatus(hadoop) or [])


def delete(spark: SparkSession, path: str) -> None:
    hadoop, system = _path(spark, path)
    system.delete(hadoop, True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one of the same file system."""
    delete(spark, target)
    hadoop, system = _path(spark, source)
    if not system.rename(hadoop, _path(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")


def modified(spark: SparkSession, path: str) -> float:
    """Modification time in seconds since the epoch."""
    hadoop, system = _path(spark, path)
    return system.getFileStatus(hadoop).getModificationTime() / 1000.0
