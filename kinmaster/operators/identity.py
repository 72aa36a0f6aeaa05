"""Master identifiers: inherit within a cluster, otherwise create."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.text import format_id, id_number, is_pending
from kinmaster.operators.intake import matched, unmatched
from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.operators.reshape import rename, to_front


def max_id(df: DataFrame, column: str, prefix: str = S.ID_PREFIX, width: int = S.ID_WIDTH) -> DataFrame:
    """Highest ID in use, 0 if there is none: ``max_number`` and ``max_id``."""
    used = F.when(~is_pending(F.col(column)), id_number(F.col(column), prefix))
    top = df.agg(F.coalesce(F.max(used), F.lit(0).cast("bigint")).alias("max_number"))
    return top.withColumn("max_id", format_id(F.col("max_number"), prefix, width))


def max_id_text(df: DataFrame, column: str) -> DataFrame:
    """Greatest ID as text (pending text sorts above every ID)."""
    return df.agg(F.max(column).alias("max_id_text"))


def pending_counts(df: DataFrame, column: str) -> DataFrame:
    pending = is_pending(F.col(column))
    return df.agg(F.count_if(pending).alias("pending"), F.count_if(~pending).alias("not_pending"))


def _inheritable(column: Column, policy: str) -> Column:
    if policy == "compat":
        return F.coalesce(column, F.lit("")) != ""
    if policy == "strict":
        return ~is_pending(column)
    raise ValueError(f"unknown policy {policy!r}")


def assign_ids(
    df: DataFrame, start: int | None = None, *, cluster: str = "cluster_id", ordinal: str = "record_number",
    column: str = "final_id", pending_policy: str = "compat",
    prefix: str = S.ID_PREFIX, width: int = S.ID_WIDTH, master: DataFrame | None = None,
) -> DataFrame:
    """Fill pending and blank IDs.

    A cluster's first ID in file order goes to its pending rows; a cluster with
    none gets one new ID, numbered in order of the clusters' first rows from
    ``start`` (or one above the highest ID in ``master``). ``compat`` lets
    pending text count as the first ID, ``strict`` does not.
    """
    if start is None:
        if master is None:
            raise ValueError("give either start or master")
        start = max_id(master, column, prefix, width).first()["max_number"] + 1
    own = F.col(column)
    usable = _inheritable(own, pending_policy)
    clusters = df.groupBy(F.col(cluster).alias("__cluster")).agg(
        F.min_by(own, F.when(usable, F.col(ordinal))).alias("__known"),
        F.min(ordinal).alias("__first"),
    )
    created = dense_number(
        clusters.where(F.col("__known").isNull()), ["__first"], "__number", start
    ).select("__cluster", format_id(F.col("__number"), prefix, width).alias("__created"))
    filled = join_back(clusters, created, "__cluster", "__cluster", "left", nulls_match=True).select(
        "__cluster", F.coalesce("__known", "__created").alias("__id")
    )
    return (
        join_back(df, filled, cluster, "__cluster", "left", nulls_match=True)
        .withColumn(column, F.when(is_pending(own), F.col("__id")).otherwise(own))
        .drop("__id")
    )


def seq_id_per_cluster(
    df: DataFrame, *, cluster: str = "cluster_id", ordinal: str = "record_number",
    column: str = "new_id", start: int = 1, prefix: str = S.ID_PREFIX, width: int = S.ID_WIDTH,
) -> DataFrame:
    """One new ID per cluster in order of the clusters' first rows."""
    clusters = df.groupBy(F.col(cluster).alias("__cluster")).agg(F.min(ordinal).alias("__first"))
    ids = dense_number(clusters, ["__first"], "__number", start).select(
        "__cluster", format_id(F.col("__number"), prefix, width).alias(column)
    )
    return to_front(join_back(df, ids, cluster, "__cluster", nulls_match=True), [column])


def attach_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """All rows with the columns of ``ids``, which has a row per key; NULL where a key has none."""
    return join_back(df, ids, key, key, "left")


def is_net_new(column: Column, last: str, mode: str = "strict", prefix: str = S.ID_PREFIX) -> Column:
    """ID above the previous maximum.

    ``strict`` compares numbers and leaves pending rows out; ``compat`` compares
    text, in which pending text counts as new.
    """
    if mode == "compat":
        return F.coalesce(column > F.lit(last), F.lit(False))
    number = F.when(~is_pending(column), id_number(column, prefix))
    return F.coalesce(number > int(last.replace(prefix, "")), F.lit(False))


def flag_net_new(df: DataFrame, last: str, column: str = "final_id", mode: str = "strict", prefix: str = S.ID_PREFIX) -> DataFrame:
    """``net_new`` 1/0, with it and the ID moved to the front."""
    flagged = df.withColumn("net_new", is_net_new(F.col(column), last, mode, prefix).cast("int"))
    return to_front(flagged, [column, "net_new"])


def net_new_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.col("net_new") == 1)


def net_new_split(
    flagged: DataFrame, other: DataFrame, left_key: str = "ship_to_code", right_key: str = "ship_to_number",
    export_names: dict[str, str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Net-new rows not found and found in a second dataset, by code."""
    new = net_new_rows(flagged)
    missing = unmatched(new, other, left_key, right_key)
    return rename(missing, export_names or {}), matched(new, other, left_key, right_key)


def id_qc(df: DataFrame, cluster: str = "cluster_id", column: str = "final_id") -> DataFrame:
    return df.agg(
        F.count_distinct(cluster).alias("unique_clusters"),
        F.count_distinct(column).alias("unique_ids"),
    )


def duplicate_ids(df: DataFrame, column: str = "final_id", tie: str = "record_number") -> DataFrame:
    """All rows whose ID occurs more than once, sorted by ID."""
    counts = df.groupBy(F.col(column).alias("__id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = counts.where("n > 1").select("__id")
    # Missing IDs equal each other here, as they do when duplicates are marked.
    return join_back(df, repeated, column, "__id", "left_semi", nulls_match=True).orderBy(column, tie)


def ids_per_cluster(df: DataFrame, cluster: str = "cluster_id", column: str = "final_id") -> DataFrame:
    return df.where(F.col(cluster).isNotNull()).groupBy(cluster).agg(
        F.count_distinct(column).alias("unique_ids")
    )


def cluster_conflict(df: DataFrame, cluster: str = "cluster_id", column: str = "final_id") -> DataFrame:
    """``label`` 1 on every row of a cluster that holds more than one ID."""
    bounds = df.groupBy(cluster).agg(
        F.coalesce(F.min(column) != F.max(column), F.lit(False)).alias("__mixed")
    )
    return (
        join_back(df, bounds, cluster, cluster, "left")
        .withColumn("label", F.coalesce(F.col("__mixed"), F.lit(False)).cast("int"))
        .drop("__mixed")
    )


def run_log_row(flagged: DataFrame, run_time: str, column: str = "final_id") -> DataFrame:
    """Run time, number of new IDs, greatest ID."""
    new_id = F.when(F.col("net_new") == 1, F.col(column))
    return flagged.agg(
        F.count_distinct(new_id).alias("ids_created"), F.max(column).alias("max_id")
    ).select(F.lit(run_time).cast("timestamp").alias("run_time"), "ids_created", "max_id")
