"""Choosing, naming and ordering columns; unions."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmaster.session import materialise


def _ref(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[_ref(c) for c in columns])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def to_front(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return select_columns(df, [*columns, *[c for c in df.columns if c not in columns]])


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[_ref(c).alias(prefix + c) for c in df.columns])


def group_by_prefix(columns: Sequence[str], prefixes: Sequence[str]) -> list[str]:
    """Names sorted within each prefix group, the rest after them as they were."""
    grouped = [c for p in prefixes for c in sorted(c for c in columns if c.startswith(p))]
    return grouped + [c for c in columns if c not in grouped]


def order_columns(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in that order; warn about the others."""
    missing = [c for c in order if c not in df.columns]
    if missing:
        warnings.warn(f"columns not in the input: {missing}", stacklevel=2)
    return select_columns(df, [c for c in order if c in df.columns])


def empty_columns(df: DataFrame) -> list[str]:
    """Columns without a single value, found in one aggregate pass."""
    if not df.columns:
        return []
    counts = df.agg(*[F.count(_ref(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return [c for i, c in enumerate(df.columns) if counts[i] == 0]


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that are entirely missing.

    Which columns remain needs a job, so the rows are written first and not worked out twice.
    """
    typed = df.drop(*[f.name for f in df.schema.fields if f.dataType.simpleString() == "void"])
    stored = materialise(typed, "wide")
    return stored.drop(*empty_columns(stored))


def align_columns(df: DataFrame, predefined: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Predefined columns first (NULL where absent), then the rest but ``exclude``."""
    rest = [c for c in df.columns if c not in predefined and c not in exclude]
    absent = {c: F.lit(None).cast("string") for c in predefined if c not in df.columns}
    return select_columns(df.withColumns(absent) if absent else df, [*predefined, *rest])


def union_all(*tables: DataFrame) -> DataFrame:
    """Union by name; a column absent on one side is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
