"""Small files beside the tables, through the file system that Spark uses for
a path, so any shared folder does."""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from pyspark.errors.exceptions.captured import convert_exception
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _plain(spark: SparkSession, fs):
    """The file system without files of checksums, which are renamed after the
    files that they belong to: a reader beside two writers may find another's."""
    checked = is_instance_of(spark.sparkContext._gateway, fs, "org.apache.hadoop.fs.ChecksumFileSystem")
    return fs.getRawFileSystem() if checked else fs


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it is not there."""
    fs, p = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, p = _at(spark, path)
    fs = _plain(spark, fs)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False if another writer
    has it.  The text is written aside and renamed, so a file that is seen is
    whole; the rename refuses to replace a file."""
    import uuid

    jvm = spark.sparkContext._jvm
    fs, p = _at(spark, path)
    fs = _plain(spark, fs)
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(aside, p, no_options)
    except Exception as e:
        fs.delete(aside, False)
        if fs.exists(p):
            return False
        raise convert_exception(e.java_exception) if hasattr(e, "java_exception") else e
    return read_text(spark, path) == text


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)
