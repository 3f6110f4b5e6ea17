"""Files and folders of tables, through the file system that Spark itself reads them with."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _at(spark: SparkSession, *parts: str):
    """A Hadoop path and its file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, system = _at(spark, path)
    return system.exists(at)


def is_written(spark: SparkSession, path: str) -> bool:
    """True for a folder whose write was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names directly below a folder; none if it isn't there."""
    at, system = _at(spark, folder)
    return [entry.getPath().getName() for entry in system.listStatus(at)] if system.exists(at) else []


def data_files(spark: SparkSession, folder: str) -> Iterator[str]:
    """The paths of all Parquet files below a folder."""
    at, system = _at(spark, folder)
    if system.exists(at):
        files = system.listFiles(at, True)
        while files.hasNext():
            path = files.next().getPath()
            if path.getName().endswith(".parquet"):
                yield path.toString()


def has_files(spark: SparkSession, path: str) -> bool:
    """True if there is any data file below a folder."""
    return next(data_files(spark, path), None) is not None


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder that this library has written; one that isn't there is fine."""
    at, system = _at(spark, path)
    system.delete(at, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within a file system; the folder above the target is made if need be."""
    at, system = _at(spark, source)
    goal, _ = _at(spark, target)
    system.mkdirs(goal.getParent())
    if not system.rename(at, goal):
        raise FileNotFoundError(f"can't move {source} to {target}")


def read_text(spark: SparkSession, path: str) -> str:
    at, system = _at(spark, path)
    stream = system.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a hidden name and then move it to its own, where nothing may be yet."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}"
    at, system = _at(spark, hidden)
    stream = system.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    move(spark, hidden, path)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """``write_text`` over a file that may be there; a reader in between finds none."""
    delete(spark, path)
    write_text(spark, path, text)
