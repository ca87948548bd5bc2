"""File checksums against a pinned manifest."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import ship_by_value

ship_by_value(__name__)

#: Files longer than this go to the opener, if one is given.
MAX_FILE_BYTES = 2**31 - 1
#: Bytes of a file that its task holds at a time.
PIECE_BYTES = 4 << 20


class ChecksumError(RuntimeError):
    """A file differs from its pin, or is missing."""


def file_checksums(
    spark: SparkSession,
    folder: str,
    pattern: str = "*",
    opener: Callable[[str], BinaryIO] | None = None,
) -> DataFrame:
    """(file, length, sha256) of every matching file of any size; all digests are taken in tasks.

    One task reads a file from start to end into a running hash and holds ``PIECE_BYTES`` of it at
    a time. Spark's own file systems open it, so every store that Spark lists will do. With an
    ``opener`` files over ``MAX_FILE_BYTES`` are dealt over the tasks by name and read in Python
    through it instead. Nothing comes to the driver.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
        .select("path", "length")
    )
    name = F.element_at(F.split("path", "/"), -1).alias("file")
    sha256 = _streamed_sha256(spark, "path").alias("sha256")
    if opener is None:
        return files.select(name, "length", sha256)
    small = files.filter(F.col("length") <= MAX_FILE_BYTES).select(name, "length", sha256)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    large = (
        files.filter(F.col("length") > MAX_FILE_BYTES)
        .repartition(tasks, "path")
        .mapInArrow(_running_digests(opener), "path string, length bigint, sha256 string")
    )
    return small.unionByName(large.select(name, "length", "sha256"))


def _streamed_sha256(spark: SparkSession, path: str) -> Column:
    """SHA-256 of the file that a column names, read by the JVM in pieces.

    Built of Spark's expressions for calls of Java objects, as its functions only take a file as one
    value. A filter by name or length goes below the read; one by digest may read a file again.
    """
    jvm = spark._jvm
    types = jvm.org.apache.spark.sql.types
    expressions = jvm.org.apache.spark.sql.catalyst.expressions
    columns = jvm.org.apache.spark.sql.classic.ExpressionUtils
    none, seq = jvm.scala.Option.empty(), jvm.PythonUtils.toSeq

    def named(java_class: str):
        return jvm.java.lang.Class.forName(java_class)

    def a(java_class: str):
        return types.ObjectType(named(java_class))

    def call(target, method: str, result: str, *given):
        return expressions.objects.Invoke(
            target, method, a(result), seq([*given]), seq([]), True, True, True
        )

    def new(java_class: str, *given):
        return expressions.objects.NewInstance(
            named(java_class), seq([*given]), seq([]), True, a(java_class), none
        )

    conf = expressions.Literal(
        jvm.org.apache.spark.util.SerializableConfiguration(
            spark._jsparkSession.sessionState().newHadoopConf()
        ),
        a("org.apache.spark.util.SerializableConfiguration"),
    )
    conf = call(conf, "value", "org.apache.hadoop.conf.Configuration")
    text = call(columns.expression(F.col(path)._jc), "toString", "java.lang.String")
    file = new("org.apache.hadoop.fs.Path", text)
    store = call(file, "getFileSystem", "org.apache.hadoop.fs.FileSystem", conf)
    stream = call(store, "open", "org.apache.hadoop.fs.FSDataInputStream", file)
    size = expressions.Literal(PIECE_BYTES, types.DataType.fromDDL("int"))
    pieces = new("java.io.BufferedInputStream", stream, size)
    closed_at_end = new("org.apache.commons.io.input.AutoCloseInputStream", pieces)
    digest = expressions.objects.StaticInvoke(
        named("org.apache.commons.codec.digest.DigestUtils"), types.DataType.fromDDL("binary"),
        "sha256", seq([closed_at_end]), seq([]), True, True, True, none,
    )
    return F.lower(F.hex(Column(columns.column(digest))))


def _running_digests(opener: Callable[[str], BinaryIO]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for path in batch.column("path").to_pylist():
                sha = hashlib.sha256()
                with opener(path) as stream:
                    while piece := stream.read(PIECE_BYTES):
                        sha.update(piece)
                sums.append(sha.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.string())], [*batch.schema.names, "sha256"]
            )

    return run


def against_manifest(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """Status per file of either side: match, mismatch, missing, unlisted or unread.

    A file whose digest is NULL is unread, and a pin that is NULL matches nothing.
    """
    pins = manifest.select("file", F.col("sha256").alias("expected"), F.lit(1).alias("listed"))
    found = checksums.withColumn("found", F.lit(1))
    status = (
        F.when(F.col("found").isNull(), "missing")
        .when(F.col("listed").isNull(), "unlisted")
        .when(F.col("sha256").isNull(), "unread")
        .when(F.col("sha256") == F.col("expected"), "match")
        .otherwise("mismatch")
    )
    return found.join(pins, "file", "full").select(
        "file", "length", "sha256", "expected", status.alias("status")
    )


def require_match(checked: DataFrame) -> None:
    bad = checked.filter(F.col("status").isin("mismatch", "missing", "unread"))
    if not bad.isEmpty():
        raise ChecksumError("a file is missing, unread or differs from its pinned checksum")
