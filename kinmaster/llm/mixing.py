"""Mixing sources to target weights by thresholds on a hash (DataFrame functions only).

Each source gets a budget of words. Whole copies of all its documents come first;
what is left of the budget is filled with the documents whose hash lies below a
threshold. The threshold is found from a histogram of words by hash bucket; only
the bucket in which the budget runs out is divided further, so nothing is sorted
and a source with a third of all rows costs as little as any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.session import materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_REPEATS = 2
HASH_BITS = 60
LEVEL_BITS = 12
_BUCKETS = 1 << LEVEL_BITS


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def row_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the id's MD5 (of the text's where the id is null)."""
    name = F.coalesce(doc_id.cast("string"), text, F.lit(""))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(
    sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """(source, source_size, target) from rows with ``source`` and ``size``.

    Sources in code point order, null last, take the weights in turn. Targets
    share ``share`` times all words by weight; one that would pass
    ``max_repeats`` times its source's words stops there, and the excess is
    shared again by weight until none is above.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = dense_number(sources, [F.col("source").isNull(), F.col("source")], "place", 0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    cap = F.col("source_size") * max_repeats
    placed = materialise(
        placed.select("source", "source_size", weight.cast("bigint").alias("weight"), cap.alias("cap")), "sources"
    )
    total = share * (placed.agg(F.sum("source_size")).first()[0] or 0)
    level, at_cap = 0.0, -1
    # Each round caps at least one source more, and all whose cap the level has
    # passed at once, so there are few rounds; a round reads one row per source.
    while True:
        capped = F.lit(at_cap >= 0) & (F.col("cap") <= F.lit(level) * F.col("weight"))
        row = placed.agg(
            F.count_if(capped).alias("n"),
            F.coalesce(F.sum(F.when(capped, F.col("cap"))), F.lit(0)).alias("cap"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0)).alias("weight"),
        ).first()
        if row["n"] == at_cap or not row["weight"]:
            break
        at_cap, level = row["n"], (total - row["cap"]) / row["weight"]
    target = F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight"))
    return placed.select("source", "source_size", target.alias("target"))


def _boundary(histogram: DataFrame) -> DataFrame:
    """Each source's bucket in which the running sum passes ``left``, and what is left before it."""
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum("words").over(before), F.lit(0))
    return (
        histogram.withColumn("before", running)
        .where((F.col("before") <= F.col("left")) & (F.col("before") + F.col("words") > F.col("left")))
        .select(
            "source", F.col("bucket").alias("prefix"), (F.col("left") - F.col("before")).alias("left"),
            "words", "n",
        )
    )


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, whole, below): copies of every document, and the hash bound of one more.

    ``sized`` has ``source``, ``size`` and ``h``. A document gets ``whole``
    copies, and another one if ``h < below``. The document in which the budget
    runs out is taken if that leaves the source nearer to its target.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    budgets = materialise(
        targets.withColumn("whole", whole).withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size")),
        "budgets",
    )
    rows = sized.where("size > 0").select("source", "size", "h")
    edge = budgets.where("source_size > 0").select("source", F.lit(0).cast("bigint").alias("prefix"), F.col("budget").alias("left"))
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        # Rows of the boundary bucket only; at most 4,096 sums per source come out of the shuffle.
        inside = join_back(
            rows, edge.withColumnRenamed("source", "edge_source"), "source", "edge_source", nulls_match=True
        )
        if shift < HASH_BITS - LEVEL_BITS:
            inside = inside.where(F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix"))
        histogram = inside.groupBy("source", F.shiftright("h", shift).alias("bucket")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("left").alias("left")
        )
        edge = materialise(_boundary(histogram), "boundary")
        if edge.where("n > 1").isEmpty() or shift == 0:
            break
        edge = edge.select("source", "prefix", "left")
    # The boundary bucket now holds one document (or rows with one hash).
    start = F.shiftleft(F.col("prefix"), shift)
    end = F.shiftleft(F.col("prefix") + 1, shift)
    below = edge.select(
        F.col("source").alias("edge_source"), F.when(F.col("words") <= 2 * F.col("left"), end).otherwise(start).alias("below")
    )
    joined = budgets.join(below, F.col("source").eqNullSafe(F.col("edge_source")), "left").drop("edge_source")
    return joined.select("source", "source_size", "target", "whole", F.coalesce("below", F.lit(0).cast("bigint")).alias("below"))


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, max_repeats: int = MAX_REPEATS,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``docs`` (columns ``keep``, by default all) with their part in the mix.

    Adds ``mix_size``, ``mix_source_size``, ``mix_target`` and ``mix_copies``
    (0 to ``max_repeats``: how often the mix takes the document). Null texts have
    size 0; a null source is a source, in last place; rows with a null id are
    drawn by their text; rows with one id are drawn together. The draw depends on ids
    only, so reruns agree. No rows give no rows. Where a source ends with its
    budget inside one document, it misses its target by at most half of that.
    """
    columns = list(keep if keep is not None else docs.columns)
    h = row_hash(F.col(id_col), F.col(text_col))
    slim = materialise(
        docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"), h.alias("h")), "sizes"
    )
    plan = materialise(thresholds(slim, source_targets(slim, weights, share, max_repeats)), "mix_plan").select(
        F.col("source").alias("__source"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"),
        F.col("whole").alias("__whole"), F.col("below").alias("__below"),
    )
    rows = docs.select(*columns, F.col(source_col).alias("__s"), word_count(F.col(text_col)).alias("mix_size"), h.alias("__h"))
    copies = F.col("__whole") + F.when(F.col("__h") < F.col("__below"), 1).otherwise(0)
    return (
        join_back(rows, plan, "__s", "__source", nulls_match=True)
        .withColumn("mix_copies", F.least(copies, F.lit(max_repeats)))
        .drop("__s", "__h", "__whole", "__below")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, with the columns of ``docs``."""
    mixed = mix(docs, **options)
    return mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int")))).select(*docs.columns)


def op9_mix(spark, sf_dir: str) -> DataFrame:
    """Each document's size, its source's size and target, and the words the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mixed = mix(docs, keep=["doc_id"])
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"),
    )


OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2 * source_size AS cap,
         CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
-- Sources reach their caps in order of cap per weight; the level is the first that the rest stay below.
o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, place_key) AS k FROM (
    SELECT *, coalesce('0' || source, '1') AS place_key FROM w)),
l AS (
  SELECT *, ((SELECT 1.5 * sum(source_size) FROM s)
             - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM o),
t AS (
  SELECT source, source_size,
         least(CAST(cap AS DOUBLE), CAST(weight AS DOUBLE) * (SELECT lev FROM l WHERE lev * weight < cap ORDER BY k LIMIT 1)) AS target
  FROM w),
b AS (
  SELECT source, source_size, target,
         CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
c AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.whole, d.h,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS atom
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN upto - atom + upto <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
