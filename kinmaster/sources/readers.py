"""Finding and reading inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmaster.functions.text import version_of, version_parts


def list_files(spark: SparkSession, root: str, prefix: str = "", modified_after: str | None = None) -> DataFrame:
    """Tables below ``root`` whose name starts with ``prefix``: files, or folders of part files.

    A table is the first level on the way down that has the prefix. A folder
    counts with the time of its newest part and the length of all of them.
    Contents are not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    parts = reader.load(root).select("path", "modificationTime", "length")
    base = _qualified(spark, root)
    below = F.split(F.substring(F.col("path"), F.lit(len(base) + 2), F.length("path")), "/")
    named = F.transform(below, lambda name: name.startswith(prefix) & ~name.rlike("^[._]"))
    level = F.array_position(named, True).cast("int")
    tables = parts.where(level > 0).select(
        F.concat_ws("/", F.lit(base), F.array_join(F.slice(below, F.lit(1), level), "/")).alias("path"), "modificationTime", "length"
    )
    files = tables.groupBy("path").agg(F.max("modificationTime").alias("modificationTime"), F.sum("length").alias("length"))
    major, minor = version_parts(F.col("path"))
    return files.withColumns({"major": major, "minor": minor, "version": version_of(F.col("path"))})


def _qualified(spark: SparkSession, root: str) -> str:
    """``root`` as Spark writes it in paths of files, without a slash at the end."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(path).toString().rstrip("/")


def _newest(files: DataFrame, order, root: str, prefix: str) -> str:
    path = files.agg(F.max_by("path", order).alias("path")).first()["path"]
    if path is None:
        raise FileNotFoundError(f"no file starting with {prefix!r} under {root}")
    return path


def latest_versioned(spark: SparkSession, root: str, prefix: str = "", mode: str = "strict") -> str:
    """Path with the highest ``vN.N``; ``compat`` compares versions as decimals."""
    files = list_files(spark, root, prefix)
    order = (
        F.struct("version", "path") if mode == "compat" else F.struct("major", "minor", "path")
    )
    return _newest(files, order, root, prefix)


def latest_by_time(spark: SparkSession, root: str, prefix: str = "") -> str:
    """Path of the file modified last."""
    files = list_files(spark, root, prefix)
    return _newest(files, F.struct("modificationTime", "path"), root, prefix)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    encoding: str = "UTF-8",
    modified_after: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """Read CSV, JSON, ORC or Parquet, chosen by the extension (else Parquet).

    CSV has a header and needs a schema, so that codes and zips stay text and
    no pass over the data is spent on guessing types. ``multiline`` allows line
    breaks inside quoted values, at the price of one task per file.
    """
    extension = path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[-1].lower()
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    if extension == "csv":
        if schema is None:
            raise ValueError("a CSV input needs a schema")
        return (
            reader.option("header", True)
            .option("encoding", encoding)
            .option("multiLine", multiline)
            .option("escape", '"')
            .option("mode", "FAILFAST")
            .csv(path)
        )
    if extension in ("json", "orc"):
        return reader.format(extension).load(path)
    if extension in ("xlsx", "xls"):
        raise ValueError("export each sheet to CSV or Parquet first")
    return reader.parquet(path)


def read_since(spark: SparkSession, path: str, timestamp: str, schema: T.StructType | None = None) -> DataFrame:
    """Only the files changed after ``timestamp`` (``yyyy-MM-ddTHH:mm:ss``)."""
    return read_table(spark, path, schema, modified_after=timestamp)
