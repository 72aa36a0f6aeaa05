"""Components of a similarity graph without comparing all pairs of a crowded list.

Lists say who may be similar: two nodes can only be linked if some list has both.
A family of near copies shares many long lists, and to compare all its pairs
would grow with its square. Since only the components are wanted, lists are
narrowed: every member is compared with a few hubs of the list, and only what is
then still in different components is compared pair by pair. A link is thus
either inside one component already or is looked at, so none is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster.operators.clustering import connected_components
from kinmaster.operators.joins import join_back
from kinmaster.session import materialise

HUB_ROUNDS = 4


def with_hub(lists: DataFrame, salt: int, ratio: float) -> DataFrame:
    """(left_id, right_id): each list's hub with its other members of fitting size, distinct.

    The hub is drawn by a hash of the node, so the many lists of one family
    have few hubs, others in each round.
    """
    draw = F.struct(F.xxhash64("node", F.lit(salt)).alias("d"), F.col("node"))
    hubs = lists.groupBy("key").agg(F.min_by(F.struct("node", "size"), draw).alias("hub"))
    pairs = join_back(lists, hubs, "key", "key").where((F.col("hub.node") != F.col("node")) & _fits("hub.size", "size", ratio))
    return _ordered(pairs.select(F.col("hub.node").alias("a"), F.col("node").alias("b")))


def _fits(a: str, b: str, ratio: float) -> Column:
    """Sets of sizes further apart than ``ratio`` cannot be similar."""
    return F.least(a, b) >= F.lit(ratio) * F.greatest(a, b) - 1e-9


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")).distinct()


def divided(lists: DataFrame, components: DataFrame) -> DataFrame:
    """Members of lists in several components, with their component and the list's main one."""
    placed = lists.join(components, F.col("node") == F.col("record_id")).select(*lists.columns, "component")
    main = (
        placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1").select("key", "main")
    )
    return join_back(placed, main, "key", "key")


def apart(rest: DataFrame, ratio: float, may: Column | None = None) -> DataFrame:
    """(left_id, right_id) of what is outside its list's main component with everyone of the list in another one.

    ``may`` says more of a pair that can be a link; the columns of its one side are called ``own_``.
    """
    outside = rest.where("component <> main").select(*[F.col(c).alias(f"own_{c}") for c in rest.columns])
    # Two outside meet once.
    once = (F.col("component") == F.col("main")) | (F.col("own_node") < F.col("node"))
    pair = (F.col("own_key") == F.col("key")) & (F.col("own_component") != F.col("component")) & once & _fits("own_size", "size", ratio)
    if may is not None:
        pair = pair & may
    return _ordered(outside.join(rest, pair).select(F.col("own_node").alias("a"), F.col("node").alias("b")))


def component_links(
    lists: DataFrame, confirm: Callable[[DataFrame], DataFrame], ratio: float = 0.0, rounds: int = HUB_ROUNDS
) -> DataFrame:
    """Confirmed (left_id, right_id) with the same components as all confirmed pairs of a list.

    ``lists`` has rows (key, node, size), distinct; ``confirm`` keeps those of the
    pairs it is given that are links, which never have sizes further apart than
    ``ratio``. Lists of one node make no pairs.
    """
    spark = lists.sparkSession
    links = spark.createDataFrame([], "left_id bigint, right_id bigint")
    nodes = lists.select(F.col("node").alias("record_id")).distinct()
    rest = lists
    for salt in range(rounds):
        found = materialise(confirm(with_hub(rest.select("key", "node", "size"), salt, ratio)).select("left_id", "right_id"), "links")
        links = materialise(links.union(found).distinct(), "links") if salt else found
        components = materialise(connected_components(nodes, links), "components")
        rest = materialise(divided(rest.select("key", "node", "size"), components), "divided")
        if rest.isEmpty():
            return links
    more = confirm(apart(rest, ratio)).select("left_id", "right_id")
    return materialise(links.union(more).distinct(), "links")
