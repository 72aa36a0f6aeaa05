"""Joining rows to a table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_back(
    rows: DataFrame, keyed: DataFrame, left: str, right: str, how: str = "inner", nulls_match: bool = False
) -> DataFrame:
    """Join on ``left = right``, fit for a key that holds a third of ``rows``.

    ``keyed`` usually comes from grouping by the key. A plain equality would
    reuse the grouping's partitions, and such a join cannot be split where a
    key is hot. The null-safe comparison makes Spark shuffle both sides for the
    join itself, which adaptive execution can split. Unless ``nulls_match``,
    the missing key is taken out of ``keyed``, so it still equals nothing.
    The key column of ``keyed`` is dropped.
    """
    if not nulls_match:
        keyed = keyed.where(F.col(right).isNotNull())
    if left == right:
        right = f"__{right}"
        keyed = keyed.withColumnRenamed(left, right)
    joined = rows.join(keyed, F.col(left).eqNullSafe(F.col(right)), how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(right)


# Ids are told apart by this many buckets: a fixed number of rows, whatever the table, so the list may be broadcast.
ID_BUCKETS = 1 << 18


def in_buckets(rows: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose ``column`` may be among ``ids`` (one column), or with ``left_anti`` those that certainly are not.

    Long rows are thus left where they are if they do not take part in the join that follows.
    """
    bucket = F.pmod(F.xxhash64(ids.columns[0]), F.lit(ID_BUCKETS))
    buckets = F.broadcast(ids.select(bucket.alias("__bucket")).distinct())
    return rows.join(buckets, F.pmod(F.xxhash64(rows[column]), F.lit(ID_BUCKETS)) == F.col("__bucket"), how)
