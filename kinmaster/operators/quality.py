"""Keeping usable records and reporting the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.text import has_digit, is_blank, normalise_link_text


def is_type(column: str, value: str = S.EXCLUDED_TYPE) -> Column:
    return normalise_link_text(F.col(column)) == value


def exclude_type(df: DataFrame, column: str = "record_type", value: str = S.EXCLUDED_TYPE) -> DataFrame:
    """Without the rows of one record type; unchanged if the column is absent."""
    return df.where(~is_type(column, value)) if column in df.columns else df


def excluded_count(df: DataFrame, column: str = "record_type", value: str = S.EXCLUDED_TYPE) -> DataFrame:
    skipped = F.count_if(is_type(column, value)) if column in df.columns else F.lit(0).cast("bigint")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), skipped.alias("skipped"))


def usable(name: str = "name", address: str = "address") -> Column:
    """Cleaned name present; cleaned address has a digit and no question mark."""
    cleaned = normalise_link_text(F.col(address))
    return ~is_blank(normalise_link_text(F.col(name))) & has_digit(cleaned) & ~cleaned.contains("?")


def split_quality(df: DataFrame, rule: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) by a predicate that is never NULL."""
    rule = usable() if rule is None else rule
    return df.where(rule), df.where(~rule)


def require_non_blank(df: DataFrame, column: str) -> DataFrame:
    return df.where(normalise_link_text(F.col(column)) != "")
