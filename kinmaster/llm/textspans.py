"""Where a pattern matches and what stands there, as column expressions whose cost grows with the text alone."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters of a piece of text; a place is read from the pieces around it.
PIECE = 256


def bound(values: Sequence[Column], body: Callable[..., Column]) -> Column:
    """``body`` of the values, each worked out once, also where the body reads them inside a lambda."""
    held = F.array(F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)]))
    return F.element_at(F.transform(held, lambda h: body(*[h[f"v{i}"] for i in range(len(values))])), 1)


def running_sums(numbers: Column) -> Column:
    """Sums of an integer array up to each place, the place included.

    Each round adds what stands 1, 2, 4, ... places before, so n numbers take log2(n) passes and no array grows.
    """
    rounds = F.when(F.size(numbers) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(numbers))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))

    def add(sums: Column, k: Column) -> Column:
        step = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(sums, lambda x, i: x + F.when(i >= step, F.get(sums, i - step)).otherwise(0))

    return F.aggregate(rounds, numbers, add)


def places(text: Column, pattern: str) -> Column:
    """All matches as array<struct<start:int,match:string>>, in code points from 0.

    The leftmost matches that do not overlap. Matches and the pieces between them add
    up to the text, so places are running sums of lengths. The pattern must not match
    the empty text; repeated groups should give nothing back (``++``), as others
    need stack space for every repetition.
    """

    def placed(matches: Column, between: Column) -> Column:
        lengths = F.zip_with(F.slice(between, F.lit(1), F.size(matches)), matches, lambda b, m: F.length(b) + F.length(m))
        return F.zip_with(
            bound([lengths], running_sums), matches, lambda end, m: F.struct((end - F.length(m)).alias("start"), m.alias("match"))
        )

    return bound([F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)], placed)


def pieces(text: Column) -> Column:
    """The text in pieces of ``PIECE`` code points, for ``cut``."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(parts: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` (exclusive) of the text in ``pieces``; only pieces that hold some are read."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    held = F.array_join(F.slice(parts, first + 1, last - first + 1), "")
    return F.when(end > start, F.substring(held, start - first * PIECE + 1, end - start)).otherwise(F.lit(""))
