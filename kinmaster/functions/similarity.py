"""Similarities between two values."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinmaster.functions.text import is_blank


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, one bit per character of ``a``."""
    where: dict[str, int] = {}
    for i, ch in enumerate(a):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for ch in b:
        hit = free & where.get(ch, 0)
        free = ((free + hit) | (free - hit)) & full
    return len(a) - free.bit_count()


def ratio_percent(a: str, b: str) -> int:
    """``2 * LCS / (|a| + |b|)`` as a whole percentage, halves to even."""
    total = len(a) + len(b)
    if total == 0 or a == b:
        return 100
    whole, rest = divmod(200 * common_subsequence(a, b), total)
    return whole + (2 * rest > total or (2 * rest == total and whole % 2 == 1))


@F.pandas_udf(T.DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(a, b):
        if pair[0] is None or pair[1] is None:
            out.append(None)
            continue
        if pair not in known:
            known[pair] = ratio_percent(*pair) / 100.0
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def string_ratio(a: Column, b: Column) -> Column:
    """Case-insensitive similarity in [0, 1] in steps of 0.01; NULL if either is.

    Spark has no longest-common-subsequence function, so this is an Arrow UDF.
    """
    return _ratio(F.lower(a), F.lower(b))


def edit_similarity(a: Column, b: Column) -> Column:
    """``1 - levenshtein / longer length``; two empty values are alike."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two duplicate-free arrays; 0 if either is empty."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(shared > 0, shared / union).otherwise(F.lit(0.0))


def words(col: Column) -> Column:
    """Distinct words of a cleaned value."""
    return F.array_distinct(F.array_remove(F.split(col, " "), ""))


def hashed_words(col: Column) -> Column:
    """Distinct words as sorted 64-bit hashes; empty for a blank value."""
    split = F.array_remove(F.split(F.coalesce(col, F.lit("")), " "), "")
    return F.sort_array(F.array_distinct(F.transform(split, lambda w: F.xxhash64(w))))


def hashed_grams(col: Column, tag: str, size: int = 3) -> Column:
    """Distinct character grams of a short value as hashes, tagged by field.

    The value is padded on both sides so that even one character has grams.
    """
    padded = F.concat(F.lit("^" * (size - 1)), col, F.lit("$"))
    grams = F.transform(
        F.sequence(F.lit(1), F.length(padded) - (size - 1)),
        lambda i: F.xxhash64(F.lit(tag), F.substr(padded, i, F.lit(size))),
    )
    return F.when(is_blank(col), F.array().cast("array<bigint>")).otherwise(
        F.array_distinct(grams)
    )
