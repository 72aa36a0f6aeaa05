"""Blocking by an index over similar text: pairs from a cosine on, exactly.

A value is the set of its words or character grams, each weighted by how rare it is.
Of two sets with a cosine of at least ``t`` the rarest common token stands, in both, before the point
from which a set's remaining weights have a norm below ``t``: were it later in one, everything
they share would be too little. So only these prefixes, the rarest tokens, are joined, and no
pair is missed. Weights are whole numbers, hence norms and products exact. Of the pairs that meet, those go on that what their
prefixes share and the rest of the one that ends first allow.

Sets that are equal are one class; pairs are between classes, with a member table beside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmaster.operators.blocking import faced
from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.session import materialise, release

# Weights are log(1 + N / df) in these parts, so they have fewer than these bits.
PARTS = 1000
WEIGHT_BITS = 17
# Codes of so many of the most frequent tokens, which are most of all occurrences, are broadcast: a fixed number of rows.
MOST_FREQUENT = 1 << 15


def token_weight(total: str | Column, df: str | Column) -> Column:
    """Rarity of a token in ``df`` of ``total`` sets, a whole number above 0."""
    total, df = (F.col(c) if isinstance(c, str) else c for c in (total, df))
    return F.floor(F.log(1 + total / df) * PARTS + 0.5).cast("bigint")


def token_classes(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, members) of rows with ``record_id`` and ``tokens`` (an array without repeats).

    ``classes`` has (class_id, tokens, n_members), ``class_id`` being the lowest record of equal sets;
    ``members`` maps every record with a token to its class.
    """
    filled = records.where(F.size("tokens") > 0).select("record_id", F.sort_array("tokens").alias("tokens"))
    named = filled.withColumn("set", F.struct(F.xxhash64("tokens"), F.xxhash64(F.lit(1), "tokens"), F.size("tokens")))
    digests = materialise(named.select("record_id", "set"), "token_sets")
    groups = digests.groupBy("set").agg(F.min("record_id").alias("class_id"), F.count(F.lit(1)).alias("n_members"))
    members = materialise(join_back(digests, groups, "set", "set").select("record_id", "class_id"), "class_members")
    classes = filled.join(groups.select(F.col("class_id").alias("record_id"), "n_members"), "record_id")
    return materialise(classes.withColumnRenamed("record_id", "class_id"), "classes"), members


def weighted_tokens(classes: DataFrame) -> tuple[DataFrame, int]:
    """((class_id, norm, codes), the largest code of a token that only one record has).

    A code is a token's place from the rarest on, with its weight in the last bits: codes in order are
    tokens by rarity, and equal codes are equal tokens. ``norm`` is the sum of squares. Frequencies count records.
    """
    total = classes.agg(F.coalesce(F.sum("n_members"), F.lit(0)).alias("total")).first()["total"]
    exploded = classes.select("class_id", "n_members", F.explode("tokens").alias("token"))
    counts = exploded.groupBy("token").agg(F.sum("n_members").alias("df"))
    placed = dense_number(counts, ["df", "token"], "place")
    code = F.shiftleft("place", WEIGHT_BITS) + token_weight(F.lit(total), "df")
    coded = materialise(placed.select(F.col("token").alias("t"), code.alias("code"), "df"), "token_codes")
    known = coded.agg(F.coalesce(F.max(F.when(F.col("df") == 1, F.col("code"))), F.lit(0).cast("bigint")).alias("lone"), F.count(F.lit(1)).alias("n")).first()
    lone = known["lone"]
    # Places are counted from the rarest token on.
    frequent = F.shiftright("code", WEIGHT_BITS) >= known["n"] - MOST_FREQUENT
    sent = F.broadcast(coded.where(frequent).select("t", "code"))
    tokens, here = exploded.select("class_id", "token"), F.col("token") == F.col("t")
    rows = join_back(tokens.join(sent, here, "left_anti"), coded.where(~frequent).select("t", "code"), "token", "t")
    rows = rows.select("class_id", "code").union(tokens.join(sent, here).select("class_id", "code"))
    ordered = rows.groupBy("class_id").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    return ordered.withColumn("norm", squares(F.col("codes"))), lone


def _square(code: Column) -> Column:
    weight = code.bitwiseAND(F.lit((1 << WEIGHT_BITS) - 1))
    return weight * weight


def squares(codes: Column) -> Column:
    return F.aggregate(codes, F.lit(0).cast("bigint"), lambda s, c: s + _square(c))


def heads_of(weighted: DataFrame, threshold: float) -> DataFrame:
    """(class_id, norm, codes, tail): the rarest tokens of each set, one of which any similar set shares; squares of the others add up to ``tail``.

    Sums run from the frequent end; a token belongs to the prefix if it and what follows reach the threshold.
    """
    # Squares, with room for rounding on the safe side.
    needed = F.col("norm") * (threshold * threshold - 1e-9)
    ends = F.aggregate(
        F.reverse("codes"), F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(0).alias("n")),
        lambda s, c: F.struct(
            (s["sum"] + _square(c)).alias("sum"), (s["n"] + F.when(s["sum"] + _square(c) < needed, 1).otherwise(0)).alias("n")
        ),
        lambda s: s["n"],
    )
    head = weighted.withColumn("codes", F.slice("codes", F.lit(1), F.size("codes") - ends))
    return head.select("class_id", "norm", "codes", (F.col("norm") - squares(F.col("codes"))).alias("tail"))


def prefixes(weighted: DataFrame, threshold: float) -> DataFrame:
    """(class_id, norm, code): the tokens of ``heads_of`` one by one."""
    return heads_of(weighted, threshold).select("class_id", "norm", F.explode("codes").alias("code"))


def similar_sets(records: DataFrame, threshold: float, spent: bool = False) -> tuple[DataFrame, DataFrame]:
    """((left_id, right_id, cosine) between classes, (record_id, class_id)) for all cosines of at least ``threshold``.

    ``records`` has ``record_id`` (unique) and ``tokens``. Cosines are of rarity weights, to
    six decimals; the threshold is held against that value. Equal sets are one class, empty ones are in none. A class is
    named by its lowest record, pairs have the lower one left. Written ``records`` that are ``spent`` are removed once read.
    """
    if not 0.0 < threshold <= 1.0:
        raise ValueError("the threshold must be above 0 and at most 1")
    classes, members = token_classes(records)
    if spent:
        release(records)
    weighted, lone = weighted_tokens(classes)
    weighted = materialise(weighted, "weighted")
    release(classes)
    # A set rounded up to the threshold is let in by half a unit of the sixth decimal.
    least = max(threshold - 5e-7, 1e-9)
    heads = materialise(heads_of(weighted, least), "heads")
    before = F.sum(_square(F.col("code"))).over(Window.partitionBy("class_id").orderBy("code").rowsBetween(Window.unboundedPreceding, -1))
    keys = heads.select("class_id", "norm", F.explode("codes").alias("code"))
    keys = keys.withColumn("left_over", F.col("norm") - F.coalesce(before, F.lit(0)))
    keys = materialise(keys.where(F.col("code") > lone), "prefixes")
    left = keys.select("code", F.col("class_id").alias("left_id"), F.col("norm").alias("ln"), F.col("left_over").alias("lo"))
    right = keys.select("code", F.col("class_id").alias("right_id"), F.col("norm").alias("rn"), F.col("left_over").alias("ro"))
    # Two sets share, from their first common token on, at most what either has left there.
    fits = F.least("lo", "ro") >= F.sqrt("ln") * F.sqrt("rn") * (least - 1e-9)
    once = (F.col("left_id") < F.col("right_id")) & fits
    met = left.join(right, "code").where(once).select("left_id", "right_id").distinct()
    # Where the prefix that ends first ends, all that they share is known, and beyond they share at most that one's tail.
    fronts = heads.select(F.col("class_id").alias("record_id"), "codes", "norm", "tail")
    fronts = faced(met, fronts, fronts, "fronts", lowest=True)
    release(keys)
    ends_first = F.element_at("left_codes", -1) <= F.element_at("right_codes", -1)
    most = squares(F.array_intersect("left_codes", "right_codes")) + F.when(ends_first, F.col("left_tail")).otherwise(F.col("right_tail"))
    reaching = fronts.where(most >= F.sqrt("left_norm") * F.sqrt("right_norm") * (least - 1e-9))
    # A set goes once to each group of pairs, not once for each of its pairs.
    sets = weighted.select(F.col("class_id").alias("record_id"), "codes", "norm")
    both = faced(reaching.select("left_id", "right_id"), sets, sets, lowest=True)
    release(heads)
    release(weighted)
    product = squares(F.array_intersect("left_codes", "right_codes"))
    cosine = F.round(product / (F.sqrt(F.col("left_norm")) * F.sqrt(F.col("right_norm"))), 6)
    return both.select("left_id", "right_id", cosine.alias("cosine")).where(F.col("cosine") >= threshold), members


def index_keys(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(record_id, keys) for ``prepare_records``-like tables: records meet if their classes are equal or similar.

    A class's keys are itself and the classes of lower name it is similar to, so two similar ones share the lower's.
    """
    lower = pairs.select(F.col("right_id").alias("class_id"), F.col("left_id").alias("key"))
    own = members.select("class_id").distinct().withColumn("key", F.col("class_id"))
    keys = own.union(lower).groupBy("class_id").agg(F.collect_set(F.xxhash64(F.lit("index"), "key")).alias("keys"))
    return join_back(members, keys, "class_id", "class_id").select("record_id", "keys")
