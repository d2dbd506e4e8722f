"""The few file-system calls that are not reads or writes of a table."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, hadoop_path


def absolute(spark: SparkSession, path: str) -> str:
    """Absolute form without scheme and host."""
    fs, p = _resolve(spark, path)
    return fs.makeQualified(p).toUri().getPath()


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute form with scheme and host, as a URI."""
    fs, p = _resolve(spark, path)
    return fs.makeQualified(p).toUri().toASCIIString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Have the driver's JVM delete ``path`` when it ends."""
    fs, p = _resolve(spark, path)
    fs.deleteOnExit(p)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; False if it does. One of several callers wins.

    Local disks and HDFS decide that in one step. Object stores do as far as their Hadoop client
    makes a create without overwrite conditional; one that only looks first can let two callers in.
    """
    fs, p = _resolve(spark, path)
    fs.mkdirs(p.getParent())
    try:
        if fs.getScheme() == "file":
            local = spark._jvm.java.io.File(fs.makeQualified(p).toUri().getPath())
            return local.createNewFile()
        fs.create(p, False).close()
        return True
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise


def join(root: str, *steps: str) -> str:
    return "/".join([root.rstrip("/"), *steps])
