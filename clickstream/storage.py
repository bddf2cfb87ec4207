"""The few file operations beside reading and writing tables, on any Hadoop file system."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = _path(spark, path)
    return fs.exists(jvm_path)


def names(spark: SparkSession, path: str) -> list[str]:
    """What the folder holds; nothing if it does not exist."""
    fs, jvm_path = _path(spark, path)
    if not fs.exists(jvm_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(jvm_path)]


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """The values of an integer partition column, from the names of the folders."""
    prefix = f"{column}="
    found = [name[len(prefix) :] for name in names(spark, path) if name.startswith(prefix)]
    return sorted(map(int, found))


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = _path(spark, path)
    fs.delete(jvm_path, True)


def create(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a small file."""
    fs, jvm_path = _path(spark, path)
    out = fs.create(jvm_path)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="clickstream-")
    return f"{base.rstrip('/')}/clickstream/{name}-{uuid.uuid4().hex}"


def read(spark: SparkSession, path: str) -> bytes:
    """The content of a small file."""
    fs, jvm_path = _path(spark, path)
    stream = fs.open(jvm_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, content: bytes) -> bool:
    """Writes a small file that appears whole or not at all; False if there is one already.

    The file system must have an atomic rename, as a streaming checkpoint needs too.
    """
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    create(spark, hidden, content)
    jvm = spark._jvm.org.apache.hadoop.fs
    context = jvm.FileContext.getFileContext(
        jvm.Path(path).toUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    options[0] = jvm.Options.Rename.NONE
    try:
        context.rename(jvm.Path(hidden), jvm.Path(path), options)
    except Py4JJavaError as error:
        delete(spark, hidden)
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below the folder."""
    fs, jvm_path = _path(spark, path)
    return fs.getContentSummary(jvm_path).getLength()
