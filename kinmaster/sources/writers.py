"""Writing outputs: single tables, named sets, versions and the run log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinmaster.functions.text import version_of, version_parts


def write_table(df: DataFrame, path: str, run_id: str | None = None, mode: str = "errorifexists") -> str:
    """Write CSV (with header, UTF-8) or Parquet by extension.

    ``run_id`` keeps every run's output next to the others as a partition; the
    data itself is not shuffled for it.
    """
    if run_id is not None:
        path = f"{path.rstrip('/')}/run_id={run_id}"
    base = path.split("/run_id=")[0]
    if base.rstrip("/").lower().endswith(".csv"):
        df.write.mode(mode).options(
            header=True, encoding="UTF-8", escape='"',
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        ).csv(path)
    else:
        df.write.mode(mode).parquet(path)
    return path


def write_set(tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists") -> dict[str, str]:
    """Write several tables as one set, one dataset per name."""
    return {name: write_table(df, f"{root.rstrip('/')}/{name}", mode=mode) for name, df in tables.items()}


def read_set(spark: SparkSession, root: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in names}


def next_version(spark: SparkSession, root: str, prefix: str, mode: str = "strict") -> str:
    """Path of the version after the newest set ``<prefix>vN.N`` under ``root``.

    ``strict`` counts the minor number up; ``compat`` adds 0.01 to the version
    read as a decimal. Sets already there are left alone.
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = []
    if system.exists(hadoop):
        names = [s.getPath().getName() for s in system.listStatus(hadoop)]
    names = [n for n in names if n.startswith(prefix)]
    if not names:
        return f"{root.rstrip('/')}/{prefix}v1.0"
    found = spark.createDataFrame([(n,) for n in names], "name string")
    if mode == "compat":
        latest = found.agg(F.max(version_of(F.col("name")))).first()[0]
        return f"{root.rstrip('/')}/{prefix}v{latest + 0.01:.2f}"
    major, minor = found.agg(F.max(F.struct(*version_parts(F.col("name"))))).first()[0]
    return f"{root.rstrip('/')}/{prefix}v{major}.{minor + 1}"


def append_run_log(stats: DataFrame, path: str) -> str:
    """Add rows to the run log."""
    return write_table(stats, path, mode="append")
