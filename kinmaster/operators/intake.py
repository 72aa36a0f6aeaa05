"""Comparing an extract of incoming records with the historical master."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.functions.text import normalise_key, status_of, strip
from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.operators.reshape import rename, to_front, union_all, with_constant

_KEY = "__key"


def is_source(column: str, value: str) -> Column:
    return F.col(column).eqNullSafe(F.lit(value))


def split_by_source(df: DataFrame, column: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Rows of one source and all others; a missing source is among the others."""
    return df.where(is_source(column, value)), df.where(~is_source(column, value))


def with_status(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value)


def _keys(df: DataFrame, key: str, mode: str) -> DataFrame:
    """Distinct normalised keys; repeats are combined before the shuffle."""
    return df.select(normalise_key(F.col(key), mode).alias(_KEY)).distinct()


def _keyed(df: DataFrame, key: str, mode: str) -> DataFrame:
    return df.withColumn(key, normalise_key(F.col(key), mode))


def new_records(extract: DataFrame, master: DataFrame, key: str, mode: str = "compat") -> DataFrame:
    """Extract rows, key normalised, whose key is nowhere in the master (any source)."""
    known = _keys(master, key, mode)
    return join_back(_keyed(extract, key, mode), known, key, _KEY, "left_anti")


def known_with_status(
    extract: DataFrame,
    master: DataFrame,
    key: str,
    status_column: str,
    status: str = S.NOT_FOUND,
    mode: str = "compat",
) -> DataFrame:
    """Extract rows, key normalised, whose key is in the master with a status."""
    known = _keys(with_status(master, status_column, status), key, mode)
    return join_back(_keyed(extract, key, mode), known, key, _KEY, "left_semi")


def unmatched(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows whose code is not among the other table's codes, compared as text."""
    return _by_code(df, other, left_key, right_key, "left_anti")


def matched(df: DataFrame, other: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return _by_code(df, other, left_key, right_key, "left_semi")


def _by_code(df: DataFrame, other: DataFrame, left_key: str, right_key: str, how: str) -> DataFrame:
    codes = other.select(strip(F.col(right_key).cast("string")).alias("__code")).distinct()
    coded = df.withColumn("__own", strip(F.col(left_key).cast("string")))
    # A missing code equals a missing code, as membership in a list has it.
    return join_back(coded, codes, "__own", "__code", how, nulls_match=True).drop("__own")


def _known(master: DataFrame, key: str, status_column: str, status: str, mode: str) -> DataFrame:
    """One row per master key: does any of its rows have the status?"""
    hit = F.coalesce(F.col(status_column) == status, F.lit(False))
    keyed = master.select(normalise_key(F.col(key), mode).alias(_KEY), hit.alias("hit"))
    return keyed.groupBy(_KEY).agg(F.max("hit").alias("__hit"))


def tagged_extract(
    extract: DataFrame, master: DataFrame, key: str, status_column: str,
    status: str = S.NOT_FOUND, mode: str = "compat",
) -> DataFrame:
    """Extract rows with their key, ``is_new`` and ``is_not_found``.

    The master is reduced to one row per key first, so one join answers both.
    """
    known = _known(master, key, status_column, status, mode)
    return _tag(_keyed(extract, key, mode), known, key)


def _tag(keyed: DataFrame, known: DataFrame, key: str) -> DataFrame:
    joined = join_back(keyed, known, key, _KEY, "left")
    flags = {"is_new": F.col("__hit").isNull(), "is_not_found": F.coalesce("__hit", F.lit(False))}
    return joined.withColumns(flags).drop("__hit")


def combined_status(
    extract: DataFrame, master: DataFrame, key: str, status_column: str,
    status: str = S.NOT_FOUND, mode: str = "compat",
) -> DataFrame:
    """New rows and known not-found rows in one table, flagged and with a status."""
    tagged = tagged_extract(extract, master, key, status_column, status, mode)
    return (
        tagged.where(F.col("is_new") | F.col("is_not_found"))
        .withColumn("new_account", F.col("is_new"))
        .withColumn("status", status_of(F.col("is_new")))
        .drop("is_new", "is_not_found")
    )


def intake_counts(
    extract: DataFrame, master: DataFrame, key: str, status_column: str,
    source_column: str, split_value: str, status: str = S.NOT_FOUND, mode: str = "compat",
) -> DataFrame:
    """Per source group: distinct keys on both sides, new and not-found counts."""
    group = F.when(is_source(source_column, split_value), F.lit("split")).otherwise(F.lit("rest"))

    # Rows are counted per key before the join, distinct keys by counting rows.
    per_key = (
        _keyed(extract, key, mode)
        .groupBy(group.alias("source_group"), key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    present = F.col(key).isNotNull()

    def rows_where(flag: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col(flag) & present, F.col("n"))), F.lit(0).cast("bigint"))

    ours = (
        _tag(per_key, _known(master, key, status_column, status, mode), key)
        .groupBy("source_group")
        .agg(
            F.count(key).alias("extract_unique"),
            rows_where("is_new").alias("new_rows"),
            F.count_if(F.col("is_new") & present).alias("new_unique"),
            rows_where("is_not_found").alias("not_found_rows"),
            F.count_if(F.col("is_not_found") & present).alias("not_found_unique"),
        )
    )
    theirs = (
        master.select(group.alias("source_group"), normalise_key(F.col(key), mode).alias(_KEY))
        .groupBy("source_group")
        .agg(F.count_distinct(_KEY).alias("master_unique"))
    )
    counts = ours.join(theirs, "source_group", "full")
    return counts.na.fill(0)


def distinct_count(df: DataFrame, *columns: str, name: str = "n") -> DataFrame:
    """Distinct combinations in which no column is missing."""
    return df.agg(F.count_distinct(*[F.col(c) for c in columns]).alias(name))


def new_by_source(df: DataFrame, source: str, key: str) -> DataFrame:
    """Distinct keys per source, then their sum in a row without a source."""
    per_source = (
        df.where(F.col(source).isNotNull())
        .groupBy(source)
        .agg(F.count_distinct(key).alias("unique_keys"))
    )
    total = per_source.agg(
        F.lit(None).cast("string").alias(source),
        F.coalesce(F.sum("unique_keys"), F.lit(0).cast("bigint")).alias("unique_keys"),
    )
    return per_source.unionByName(total)


def distinct_all_columns(df: DataFrame, by: str, approximate: bool = False) -> DataFrame:
    """Distinct values of every column per group.

    Exact counting expands every row once per column; ``approximate`` makes it
    one pass for wide tables.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return (
        df.where(F.col(by).isNotNull())
        .groupBy(by)
        .agg(*[count(F.col(c)).alias(f"n_{c}") for c in df.columns if c != by])
    )


def distinct_all_columns_total(per_group: DataFrame) -> DataFrame:
    """The per-group distinct counts summed over the groups."""
    columns = [c for c in per_group.columns if c.startswith("n_")]
    return per_group.agg(*[F.sum(c).alias(c) for c in columns])


def group_sizes(df: DataFrame, key: str, name: str = "group_size") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def run_stats(df: DataFrame) -> DataFrame:
    """Rows and columns of a table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns))
    )


def profile(df: DataFrame) -> DataFrame:
    """One row per column: type, values present, rows."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(f.name).alias("column_name"),
                    F.lit(f.dataType.simpleString()).alias("data_type"),
                    F.count(F.col(f"`{f.name}`")).alias("non_null"),
                )
                for f in df.schema.fields
            ]
        ).alias("columns"),
    )
    return counts.select("n_rows", F.inline("columns"))


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def new_accounts_export(new: DataFrame, received: str) -> DataFrame:
    """New rows stamped with the day received (``yyyy-MM-dd``)."""
    return new.withColumn("date_received", F.lit(received).cast("date"))


def append_logbook(
    master: DataFrame, extract: DataFrame, key: str, order: Sequence[str],
    source_column: str, split_value: str, mode: str = "compat",
    renames: dict[str, str] | None = None,
) -> DataFrame:
    """Master rows, then new rows of the split source, then the other new rows,
    with a flag for new rows and dense record numbers as the first column.

    Where the master's rows have a ``record_number`` they keep it, and new rows
    are counted on from the highest."""
    new = new_records(extract, master, key, mode).withColumn(
        "__block", F.when(is_source(source_column, split_value), F.lit(1)).otherwise(F.lit(2))
    )
    if "record_number" in master.columns:
        last = master.agg(F.coalesce(F.max("record_number"), F.lit(0))).first()[0]
        fresh = dense_number(with_constant(new, "new_account", True), ["__block", *order], "record_number", last + 1)
        kept = with_constant(_keyed(master, key, mode), "new_account", False)
        return rename(to_front(union_all(kept, fresh.drop("__block")), ["record_number"]), renames or {})
    old = with_constant(_keyed(master, key, mode), "__block", 0)
    both = union_all(
        with_constant(old, "new_account", False), with_constant(new, "new_account", True)
    )
    numbered = dense_number(both, ["__block", *order], "record_number").drop("__block")
    return rename(to_front(numbered, ["record_number"]), renames or {})
