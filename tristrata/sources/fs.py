"""File system calls on names and on small text files; data goes through Spark."""

import time

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def glob(spark: SparkSession, pattern: str, directories: bool) -> list[str]:
    """Sorted paths of the directories (or the plain files) matching ``pattern``."""
    system, target = _at(spark, pattern)
    found = system.globStatus(target) or []
    return sorted(s.getPath().toString() for s in found if s.isDirectory() == directories)


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _at(spark, path)
    return system.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    system, target = _at(spark, path)
    system.delete(target, True)


def move_directory(spark: SparkSession, source: str, destination: str) -> None:
    """Rename one directory, replacing the destination."""
    system, origin = _at(spark, source)
    target = spark._jvm.org.apache.hadoop.fs.Path(destination)
    system.mkdirs(target.getParent())
    if system.exists(target):
        system.delete(target, True)
    if not system.rename(origin, target):
        raise OSError(f"could not move {source} to {destination}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    system, target = _at(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file, without its end; no more than a few blocks are read."""
    system, target = _at(spark, path)
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(system.open(target), "UTF-8"))
    try:
        return reader.readLine() or ""
    finally:
        reader.close()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system."""
    system, target = _at(spark, path)
    return system.makeQualified(target).toString()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing what is there."""
    system, target = _at(spark, path)
    stream = system.create(target, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def rename_if_new(spark: SparkSession, source: str, destination: str) -> bool:
    """Rename a file unless the destination exists; says whether it was renamed."""
    jvm = spark._jvm
    origin, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, destination))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(origin.toUri(), spark._jsc.hadoopConfiguration()) if (
        origin.toUri().getScheme()
    ) else jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(origin, target, plain)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


def age_hours(spark: SparkSession, path: str) -> float:
    """Hours since a file or directory was last changed."""
    system, target = _at(spark, path)
    return (time.time() * 1000 - system.getFileStatus(target).getModificationTime()) / 3_600_000
