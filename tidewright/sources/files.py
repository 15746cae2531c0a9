"""Small files and folder listings on any file system that Hadoop knows."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import SparkSession


def session() -> SparkSession:
    found = SparkSession.getActiveSession()
    if found is None:
        raise RuntimeError("there is no active session")
    return found


def filesystem(spark: SparkSession, path: str):
    """(file system, path) objects of the JVM."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def files_under(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths of the files in a folder and below, hidden ones left out; of a file or pattern, its matches."""
    fs, target = filesystem(spark, path)
    for match in fs.globStatus(target) or []:
        found = fs.listFiles(match.getPath(), True)
        while found.hasNext():
            file = found.next().getPath()
            if not file.getName().startswith(("_", ".")):
                yield file.toString()


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


def is_file(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target) and fs.getFileStatus(target).isFile()


def first_mark(spark: SparkSession, path: str) -> str:
    """The first character of a file that is no blank."""
    fs, target = filesystem(spark, path)
    stream = fs.open(target)
    try:
        while (byte := stream.read()) >= 0:
            if not chr(byte).isspace():
                return chr(byte)
    finally:
        stream.close()
    return ""


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename, over whatever is there."""
    fs, new = filesystem(spark, target)
    fs.delete(new, True)
    fs.mkdirs(new.getParent())
    if not fs.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source), new):
        raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, target = filesystem(spark, path)
    fs.delete(target, True)


def parts(spark: SparkSession, folder: str) -> list[str]:
    """The files that tasks wrote into a folder, in the order of the tasks."""
    fs, target = filesystem(spark, folder)
    return sorted(s.getPath().toString() for s in fs.listStatus(target) if s.getPath().getName().startswith("part-"))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file."""
    fs, target = filesystem(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as one string."""
    fs, target = filesystem(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def save_text(path: str, text: str) -> None:
    """A small file by path or address; plain paths are files of the driver and need no session."""
    if "://" in path or path.startswith("file:"):
        write_text(session(), path, text)
        return
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    with open(path, "w", encoding="utf-8") as out:
        out.write(text)
