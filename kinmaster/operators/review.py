"""Labelling borderline links for review."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.similarity import string_ratio
from kinmaster.functions.text import address_line
from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import first_entries
from kinmaster.operators.reshape import drop_empty_columns, group_by_prefix, order_columns, select_columns


def below(df: DataFrame, column: str, threshold: float = S.REVIEW_THRESHOLD) -> DataFrame:
    return df.where(F.col(column) < threshold)


def at_least(df: DataFrame, column: str, threshold: float = S.REVIEW_THRESHOLD) -> DataFrame:
    return df.where(F.col(column) >= threshold)


def widen_entries(
    df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str], names: Sequence[str],
) -> DataFrame:
    """One row per group with its first entries side by side, prefixed by ``names``.

    Only that many rows per group leave each task. A column the input lacks is
    left out.
    """
    columns = [c for c in columns if c in df.columns]
    first = first_entries(df.where(F.col(key).isNotNull()), key, order, len(names), "__entry")
    row = F.struct(*[F.col(c) for c in columns])
    picked = [F.max(F.when(F.col("__entry") == i + 1, row)).alias(f"__e{i}") for i in range(len(names))]
    wide = first.groupBy(key).agg(*picked, F.count(F.lit(1)).alias("__n"))
    return wide.select(
        key, *[F.col(f"__e{i}.{c}").alias(f"{name}{c}") for i, name in enumerate(names) for c in columns], "__n"
    )


def entry_pairs(df: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The first two entries of each group on one row; single entries have no pair."""
    wide = widen_entries(df, key, columns, order, ("first_", "second_"))
    return wide.where("__n = 2").drop("__n")


def label_of(name: Column, address: Column, name_cut: float = S.NAME_CUT, address_cut: float = S.ADDRESS_CUT) -> Column:
    same_name, same_address = name >= name_cut, address >= address_cut
    return (
        F.when(same_name & same_address, S.LABEL_RELIABLE)
        .when(~same_name & same_address, S.LABEL_SAME_ADDRESS)
        .when(same_name & ~same_address, S.LABEL_SAME_NAME)
        .when(~same_name & ~same_address, S.LABEL_NEITHER)
        .otherwise(S.LABEL_OTHER)
    )


def label_pairs(
    df: DataFrame, order: Sequence[str], key: str = "cluster_id", threshold: float = S.REVIEW_THRESHOLD,
    name_cut: float = S.NAME_CUT, address_cut: float = S.ADDRESS_CUT,
) -> DataFrame:
    """Label and similarities of every borderline cluster with two entries."""
    columns = ["name", "address", "city", "state", "zip"]
    pairs = entry_pairs(below(df, "link_score", threshold), key, order, columns)

    def line(side: str) -> Column:
        return address_line(*[F.col(side + c) for c in columns[1:]])

    scored = pairs.select(
        key,
        string_ratio(F.col("first_name"), F.col("second_name")).alias("name_similarity"),
        string_ratio(line("first_"), line("second_")).alias("address_similarity"),
    )
    return scored.withColumn(
        "label", label_of(F.col("name_similarity"), F.col("address_similarity"), name_cut, address_cut)
    )


def adjust_score(label: Column, score: Column, threshold: float = S.REVIEW_THRESHOLD) -> Column:
    out = score
    for name, value in S.ADJUSTED_SCORE.items():
        out = F.when(label == name, F.lit(threshold if value is None else value)).otherwise(out)
    return out


def attach_labels(
    df: DataFrame, labels: DataFrame, key: str = "cluster_id", threshold: float = S.REVIEW_THRESHOLD
) -> DataFrame:
    """All rows with their cluster's label, similarities and adjusted score.

    The score is adjusted before a missing label becomes ``Other``.
    """
    joined = join_back(df, labels, key, key, "left")
    adjusted = adjust_score(F.col("label"), F.col("link_score"), threshold)
    return joined.withColumn("adjusted_link_score", adjusted).withColumn(
        "label", F.coalesce("label", F.lit(S.LABEL_OTHER))
    )


REVIEW_COLUMNS = (
    "id", "name", "address", "city", "state", "zip", "q_id", "ship_to_number", "source", "source_file",
    "link_score",
)


def review_pivot(
    labelled: DataFrame, order: Sequence[str], key: str = "cluster_id", columns: Sequence[str] = REVIEW_COLUMNS,
    names: Sequence[str] = (S.REVIEW_LEFT_PREFIX, S.REVIEW_RIGHT_PREFIX),
) -> DataFrame:
    """One row per cluster: both entries, then label, similarities and scores.

    A cluster whose rows differ in adjusted score has one row for each.
    """
    wide = widen_entries(labelled, key, columns, order, names).drop("__n")
    marks = ["adjusted_link_score", "label", "name_similarity", "address_similarity"]
    per_cluster = labelled.select(key, *marks).distinct()
    return select_columns(
        wide.join(per_cluster, key), [key, *group_by_prefix([c for c in wide.columns if c != key], names), *marks]
    )


def review_order(names: Sequence[str] = (S.REVIEW_LEFT_PREFIX, S.REVIEW_RIGHT_PREFIX), key: str = "cluster_id") -> list[str]:
    """Final column order of the review table: the second side by name, its file number last."""
    left, right = names
    first = [left + c for c in REVIEW_COLUMNS if c != "link_score"]
    second = [right + c for c in [*sorted(c for c in REVIEW_COLUMNS if c != "source_file"), "source_file"]]
    ends = ["address_similarity", "name_similarity", left + "link_score", "label"]
    return ["adjusted_link_score", key, *first, *second, *ends]


def review_output(pivoted: DataFrame, order: Sequence[str] | None = None, drop_empty: bool = True) -> DataFrame:
    """Final column order, a warning for missing columns, empty columns dropped."""
    ordered = order_columns(pivoted, order or review_order())
    return drop_empty_columns(ordered) if drop_empty else ordered


def apply_overrides(labelled: DataFrame, overrides: DataFrame, key: str = "cluster_id") -> DataFrame:
    """Labels a reviewer changed replace the computed ones."""
    changed = overrides.select(key, F.col("label").alias("__label"))
    return labelled.join(changed, key, "left").withColumn("label", F.coalesce("__label", "label")).drop("__label")
