"""The few things that tables need of a file system itself."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def file_system(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def names(spark: SparkSession, path: str) -> list[str]:
    """What lies directly in a folder; nothing if there is no such folder."""
    files, at = file_system(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(at)) if files.exists(at) else []


def read_folder(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All parquet files below a folder, which is made if it is not there.

    Making a folder is one call that any number of drivers may make at a time; nothing is written.
    """
    files, at = file_system(spark, path)
    files.mkdirs(at)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    files, at = file_system(spark, path)
    files.delete(at, True)


def write_once(spark: SparkSession, path: str, text: str) -> str:
    """Write a small file unless it is there; what it holds then, whoever wrote it.

    The file system lets one writer create it.
    """
    files, at = file_system(spark, path)
    try:
        out = files.create(at, False)
    except Py4JJavaError as error:
        if "AlreadyExists" not in str(error.java_exception):
            raise
    else:
        out.write(bytearray(f"{text}\n", "utf-8"))
        out.close()
    found = read_small(spark, path)
    assert found is not None
    return found


def read_small(spark: SparkSession, path: str, wait: float = 10) -> str | None:
    """A file of ``write_once``, if it is there; one that is just being written is waited for."""
    files, at = file_system(spark, path)
    until = time.monotonic() + wait
    while files.exists(at):
        stream = files.open(at)
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.endswith("\n"):
            return text[:-1]
        if time.monotonic() > until:
            raise RuntimeError(f"{path} was begun and not finished; remove it")
        time.sleep(0.1)
    return None
