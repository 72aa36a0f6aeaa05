"""Dense numbers without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmaster.operators.joins import join_back
from kinmaster.session import materialise

_PART, _INDEX, _OFFSET = "__part", "__index", "__offset"


def dense_number(df: DataFrame, order: Sequence[str | Column], name: str, start: int | Column = 1) -> DataFrame:
    """Numbers ``start, start+1, ...`` in the given order, which must be total.

    A range shuffle puts the rows in order across tasks; each task counts its
    own rows, and one small row per task carries the offsets. The sorted rows
    are written once, since the range bounds come from a sample and both the
    counts and the numbers must see the same ones.
    """
    order = list(order)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_INDEX, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )
    stored = materialise(placed, "numbered")
    sizes = stored.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    # One row per task of the range shuffle, so this window and the broadcast
    # are bounded by the partition count and not by the data.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias(_OFFSET)
    )
    start = start if isinstance(start, Column) else F.lit(start).cast("bigint")
    return (
        stored.join(F.broadcast(offsets), _PART)
        .withColumn(name, start + F.col(_OFFSET) + F.col(_INDEX))
        .drop(_PART, _INDEX, _OFFSET)
    )


def entry_number(df: DataFrame, key: str, order: Sequence[str], name: str = "entry") -> DataFrame:
    """1, 2, ... within each key, in the given (total) order.

    Numbers all rows by (key, order) and subtracts each key's first number, so
    a key with a third of the rows is still spread over many tasks.
    """
    numbered = dense_number(df, [key, *order], "__row")
    first = numbered.groupBy(key).agg(F.min("__row").alias("__first"))
    return (
        join_back(numbered, first, key, key, nulls_match=True)
        .withColumn(name, F.col("__row") - F.col("__first") + 1)
        .drop("__row", "__first")
    )


def first_entries(df: DataFrame, key: str, order: Sequence[str], n: int, name: str = "entry") -> DataFrame:
    """The first ``n`` rows of each key.

    The rank filter is applied before the shuffle too (a window group limit),
    so a hot key sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
