"""Files by Hadoop's file system API, for any store that Spark reads: existence, digests, markers."""

from __future__ import annotations

import posixpath

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files up to this size are digested by tasks, which hold them whole; larger ones are streamed.
WHOLE_BYTES = 64 << 20
BUFFER_BYTES = 1 << 20


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def kind_of(spark: SparkSession, path: str) -> str | None:
    """``file``, ``folder`` or None where there is nothing."""
    fs, where = file_system(spark, path)
    if not fs.exists(where):
        return None
    return "folder" if fs.getFileStatus(where).isDirectory() else "file"


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder in order; none where it is missing."""
    fs, where = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def streamed_sha256(spark: SparkSession, path: str) -> str:
    """SHA-256 of a file of any size, read once through a buffer of BUFFER_BYTES inside the JVM."""
    fs, where = file_system(spark, path)
    java = spark._jvm.java
    digest = java.security.MessageDigest.getInstance("SHA-256")
    sink = java.security.DigestOutputStream(java.io.OutputStream.nullOutputStream(), digest)
    spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(fs.open(where), sink, BUFFER_BYTES, True)
    return bytes(digest.digest()).hex()


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of a file, or of each file of a folder: small ones by tasks, large ones one after another as streams."""
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= WHOLE_BYTES).select("path", F.sha2("content", 256).alias("sha256"))
    large = [r["path"] for r in files.where(F.col("length") > WHOLE_BYTES).select("path").collect()]
    if not large:
        return small
    return small.unionByName(spark.createDataFrame([(p, streamed_sha256(spark, p)) for p in large], "path string, sha256 string"))


def file_sha256(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file's bytes, or for a folder of its files' digests in the order of their paths."""
    if kind_of(spark, path) == "file":
        return streamed_sha256(spark, path)
    parts = digests(spark, path).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("path", "sha256"))), lambda x: x["sha256"]), "").alias("all"))
    return parts.select(F.sha2("all", 256).alias("h")).first()["h"]


def mark(spark: SparkSession, path: str) -> bool:
    """Make an empty file that nobody else has made; whether it was this call that did."""
    fs, where = file_system(spark, path)
    try:
        fs.mkdirs(where.getParent())
        return bool(fs.createNewFile(where))
    except Py4JJavaError as error:
        if fs.exists(where):
            return False
        raise error


def remove(spark: SparkSession, path: str) -> None:
    fs, where = file_system(spark, path)
    fs.delete(where, True)


def refuse_same_path(source: str, target: str) -> None:
    if posixpath.normpath(source) == posixpath.normpath(target):
        raise ValueError(f"the output would overwrite the input {source}")
