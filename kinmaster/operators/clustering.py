"""From scored pairs to clusters."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.operators.blocking import (
    BLOCK_LIMIT,
    FREQUENT,
    TILED,
    as_right,
    block_members,
    compare,
    met,
    only,
    pairs_in_tiles,
    pairs_within,
    sign_members,
    similar_in_blocks,
    sketch_members,
    sketches,
    split_blocks,
)
from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.operators.pair_model import PairModel, with_self_score
from kinmaster.operators.records import collapse_copies
from kinmaster.operators.reshape import to_front
from kinmaster.operators.tiles import links_across
from kinmaster.schema import FieldSpec
from kinmaster.session import materialise

MAX_ROUNDS = 100
# How often every member of a large block is compared with another of its members
# before what is left apart is compared pair by pair.
HUB_ROUNDS = 3


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(record_id, component): the lowest record id reachable from each record.

    Alternates large-star and small-star steps (Kiveris et al. 2014): each links
    a node's neighbours to the lowest of them, until every node points at the
    lowest of its component. Minima are combined before the shuffle, and the
    join back splits a node with very many edges, so a hub is never gathered in
    one task. Every round is written, which keeps the plan short and lets lost
    tasks be redone.
    """
    pair = [F.greatest("left_id", "right_id").alias("u"), F.least("left_id", "right_id").alias("v")]
    links = materialise(edges.where("left_id <> right_id").select(*pair).distinct(), "links")
    for _ in range(MAX_ROUNDS):
        if _settled(links):
            break
        links = materialise(_small_star(_large_star(links)), "links")
    else:
        raise RuntimeError(f"components not found in {MAX_ROUNDS} rounds")
    return nodes.select("record_id").join(
        links.select(F.col("u").alias("record_id"), "v"), "record_id", "left"
    ).select("record_id", F.coalesce("v", "record_id").alias("component"))


def _settled(links: DataFrame) -> bool:
    """Does every node point at one other that points nowhere itself?

    Links always run from a higher to a lower id, so that is then the lowest.
    """
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("in")).union(
        links.select("v", F.lit(0), F.lit(1))
    )
    counts = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("in").alias("in"))
    return counts.where("out > 1 OR (out = 1 AND in = 1)").isEmpty()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return join_back(both, lowest, "u", "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    lowest = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = join_back(down, lowest, "u", "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(lowest.select("u", F.col("m").alias("v"))).distinct()


def _star(groups: DataFrame, key: str, salt: int | None = None) -> DataFrame:
    """(left_id, right_id), low id first: each group's hub with every other one.

    The hub is the lowest record, or with a ``salt`` one drawn by hash, another in each group.
    """
    drawn = F.col("record_id") if salt is None else F.struct(F.xxhash64("record_id", key, F.lit(salt)), F.col("record_id"))
    hubs = groups.groupBy(key).agg(F.min_by("record_id", drawn).alias("hub"))
    pairs = join_back(groups, hubs, key, key).where("hub <> record_id")
    low, high = F.least("hub", "record_id").alias("left_id"), F.greatest("hub", "record_id").alias("right_id")
    # Pairs are grouped by their hub, which is long.
    return pairs.groupBy(low, high).agg(F.min(F.xxhash64("hub")).alias("key"))


def _narrow(
    blocks: DataFrame, links: DataFrame, match: Callable[[DataFrame], DataFrame], nodes: DataFrame,
    records: DataFrame, fields: Sequence[FieldSpec], score: float, model: PairModel | None = None,
) -> DataFrame:
    """``links`` and more, until no two records of a block that match are in different components.

    ``blocks`` are members of blocks that ``links`` leave in several components.
    Hubs first; what they leave apart meets the block's other components in chunks,
    and only a link for each two components that match comes out.
    """
    for salt in range(HUB_ROUNDS):
        links = materialise(links.unionByName(match(_star(blocks.select("key", "record_id"), "key", salt))), "matches")
        blocks = _split(blocks.select("key", "record_id"), "key", materialise(connected_components(nodes, links), "components"))
        if blocks.isEmpty():
            return links
    return links.unionByName(match(links_across(blocks, records, fields, score, model=model)))


def _approach(
    blocks: DataFrame, links: DataFrame, match: Callable[[DataFrame], DataFrame], nodes: DataFrame, threshold: float
) -> DataFrame:
    """``links`` and more, until no two records of a block that match are in different components.

    ``blocks`` are members with sketches. Every record outside a block's main component meets first the lowest record of
    another component that its sketch allows, which ties families of near copies; what that leaves apart meets all such records.
    """
    lowest = F.min_by(F.struct("left_id", "right_id", "key"), "right_id").alias("pair")
    for first in (True, True, False):
        parts = _split(blocks, "key", materialise(connected_components(nodes, links), "components"))
        if parts.isEmpty():
            return links
        blocks = parts.drop("component", "main")
        near = pairs_in_tiles(parts.where("component <> main"), as_right(parts), threshold, F.col("component") != F.col("r_component"))
        if first:
            near = near.groupBy("left_id").agg(lowest).select("pair.*")
        near = met(near, F.least("left_id", "right_id"), F.greatest("left_id", "right_id"))
        links = materialise(links.unionByName(match(near)), "matches")
    return links


def _split(groups: DataFrame, key: str, components: DataFrame) -> DataFrame:
    """Members of the groups in several components, with theirs and the main one."""
    placed = groups.join(components, "record_id")
    main = (
        placed.groupBy(key, "component")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(key)
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("parts"))
        .where("parts > 1")
        .select(key, "main")
    )
    return materialise(join_back(placed, main, key, key), "split")


def spanning_links(
    records: DataFrame, fields: Sequence[FieldSpec], threshold: float | None, score: float,
    frequent: int = FREQUENT, limit: int = BLOCK_LIMIT, model: PairModel | None = None, tiled: int = TILED,
) -> DataFrame:
    """Scored links with the same components as all matching pairs.

    A match is a candidate pair with a score of at least ``score``. Small blocks
    are compared pair by pair. A large block is narrowed down in steps, each
    only for what the one before left in several components: every record
    against the block's first record; those outside the block's main component against
    a record their sketches allow, then against all of them. In blocks of more than ``TILED``
    records signatures take the place of sketches: every record against the first one with
    the same signature; those outside a signature's main component against the
    others with it. A match is thus either inside one component already or is
    looked at, so no connection is lost, while a family of near copies costs a
    few comparisons per record. Without a threshold there are no signatures:
    hubs drawn by hash narrow the blocks instead.
    """
    small, large = split_blocks(materialise(block_members(records), "members"), limit)
    if threshold:
        sketched = materialise(sketches(records), "sketches")
        small = sketch_members(small, sketched)
    pairs = pairs_within(small, threshold)
    large = materialise(large, "large_blocks")
    has_large = not large.isEmpty()
    if has_large:
        pairs = met(pairs.unionByName(_star(large, "key")), "left_id", "right_id")

    def match(candidates: DataFrame) -> DataFrame:
        scored = compare(candidates, records, records, fields, threshold, model).where(F.col("score") >= score)
        # Without a threshold nobody reads the similarity: tokens then stay out of the joins.
        return materialise(scored.select("left_id", "right_id", *(["similarity"] if threshold else []), "score"), "matches")

    links = match(pairs)
    if not has_large:
        return links
    concerned = large.select("record_id").distinct()
    components = materialise(connected_components(concerned, links), "components")
    blocks = _split(large, "key", components).select("key", "record_id", "n_tokens")
    if blocks.isEmpty():
        return links
    group = F.struct("key", "sig", "single").alias("group")
    if not threshold:
        return _narrow(blocks, links, match, concerned, records, fields, score, model)
    # From here on only records of large blocks meet.
    records = only(records, concerned)
    medium, huge = split_blocks(sketch_members(blocks, sketched), tiled)
    links = _approach(materialise(medium, "blocks"), links, match, concerned, threshold)
    huge = materialise(huge, "huge_blocks")
    if huge.isEmpty():
        return links
    components = materialise(connected_components(concerned, links), "components")
    signed = materialise(sign_members(huge, records, threshold, frequent).select("*", group), "signatures")
    sizes = signed.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    if not sizes.isEmpty():
        crowded = join_back(signed, sizes, "group", "group")
        links = materialise(links.unionByName(match(_star(crowded, "group"))), "matches")
        components = materialise(connected_components(concerned, links), "components")
    apart = _split(signed, "group", components).drop("group")
    more = similar_in_blocks(
        apart.where("component <> main"), as_right(apart), threshold, F.col("component") != F.col("r_component")
    )
    return links.unionByName(match(more))


def cluster_records(
    records: DataFrame, fields: Sequence[FieldSpec], threshold: float | None, score: float = S.DEDUPE_THRESHOLD,
    frequent: int = FREQUENT, limit: int = BLOCK_LIMIT, model: PairModel | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clusters, representatives, copies) of prepared records.

    ``clusters`` gives every record the lowest record id of its cluster as
    ``component``; a record that matches nothing is its own cluster. With a ``model`` its
    probability decides instead of the fixed weights.
    """
    records = with_self_score(records, fields, model)
    reps, copies = collapse_copies(records, fields)
    links = spanning_links(reps, fields, threshold, score, frequent, limit, model)
    components = connected_components(reps, links)
    linked = links.select(F.explode(F.array("left_id", "right_id")).alias("rep_id")).distinct()
    # Copies stay together if they match each other or a common other record.
    together = reps.select(F.col("record_id").alias("rep_id"), "self_score").join(
        linked.withColumn("linked", F.lit(True)), "rep_id", "left"
    ).select("rep_id", ((F.col("self_score") >= score) | F.col("linked").isNotNull()).alias("together"))
    by_rep = components.withColumnRenamed("record_id", "rep_id").join(together, "rep_id")
    clusters = join_back(copies, by_rep, "rep_id", "rep_id").select(
        "record_id", F.when(F.col("together"), F.col("component")).otherwise(F.col("record_id")).alias("component")
    )
    return clusters, reps, copies


def number_clusters(clusters: DataFrame, start: int = 0) -> DataFrame:
    """``cluster_id`` counted from ``start`` in order of the clusters' lowest record."""
    numbered = dense_number(clusters.select("component").distinct(), ["component"], "cluster_id", start)
    return join_back(clusters, numbered, "component", "component")


def cluster_count(clusters: DataFrame, column: str = "cluster_id") -> DataFrame:
    return clusters.agg(F.count_distinct(column).alias("n_clusters"))


def cluster_confidence(clusters: DataFrame, scored: DataFrame, copies: DataFrame, reps: DataFrame) -> DataFrame:
    """``1 - sqrt(sum((1 - score)^2) / (n - 1))`` over a record's cluster mates.

    A mate it was not paired with counts as distance 1; a lone record has 1.0.
    ``scored`` holds pairs of representatives, so copies are counted by number
    and never paired up.
    """
    of_reps = copies.join(clusters, "record_id")
    sizes = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    weight = reps.select(F.col("record_id").alias("rep_id"), "n_copies", "self_score")
    member = of_reps.where("record_id = rep_id").join(weight, "rep_id").select(
        "rep_id", "component", "n_copies", "self_score"
    )
    both = scored.select("left_id", "right_id", "score").union(
        scored.select(F.col("right_id").alias("left_id"), F.col("left_id").alias("right_id"), "score")
    )
    mate = member.select(
        F.col("rep_id").alias("right_id"), F.col("component").alias("mate_component"), F.col("n_copies").alias("mates")
    )
    paired = (
        join_back(join_back(both.withColumnRenamed("left_id", "rep_id"), member.select("rep_id", "component"), "rep_id", "rep_id"),
                  mate.withColumnRenamed("right_id", "mate_id"), "right_id", "mate_id")
        .where("component = mate_component")
        .groupBy("rep_id")
        .agg(
            F.sum(F.col("mates") * (1 - F.col("score")) * (1 - F.col("score"))).alias("distance"),
            F.sum("mates").alias("seen"),
        )
    )
    copies_apart = (1 - F.col("self_score")) * (1 - F.col("self_score")) * (F.col("n_copies") - 1)
    unseen = F.col("size") - F.col("n_copies") - F.coalesce("seen", F.lit(0))
    total = F.coalesce("distance", F.lit(0.0)) + copies_apart + unseen
    confidence = 1 - F.sqrt(total / F.greatest(F.col("size") - 1, F.lit(1)))
    per_rep = join_back(member.join(paired, "rep_id", "left"), sizes, "component", "component").select(
        "rep_id", confidence.alias("confidence_score")
    )
    alone = F.col("size") == 1
    rows = join_back(join_back(of_reps, per_rep, "rep_id", "rep_id"), sizes, "component", "component")
    return rows.select(
        "record_id",
        "component",
        F.when(alone, F.lit(1.0)).otherwise(F.round("confidence_score", 6)).alias("confidence_score"),
    )


def representative_confidence(
    clusters: DataFrame, reps: DataFrame, copies: DataFrame, fields: Sequence[FieldSpec], model: PairModel | None = None
) -> DataFrame:
    """The same measure taken with the cluster's lowest record alone.

    Two records leave ``1 - sqrt((1 - score)^2)``, the score itself. One
    comparison per record, however large a cluster grows.
    """
    rep_of = copies.select(F.col("record_id").alias("component"), F.col("rep_id").alias("left_id"))
    members = join_back(copies.join(clusters, "record_id"), rep_of, "component", "component")
    pairs = members.select("left_id", F.col("rep_id").alias("right_id")).where("left_id <> right_id").distinct()
    scored = compare(pairs, reps, reps, fields, 0.0, model).select(F.struct("left_id", F.col("right_id").alias("rep_id")).alias("pair"), "score")
    own = reps.select(F.col("record_id").alias("rep_id"), "self_score")
    confidence = (
        F.when(F.col("record_id") == F.col("component"), F.lit(1.0))
        .when(F.col("left_id") == F.col("rep_id"), F.col("self_score"))
        .otherwise(F.col("score"))
    )
    return (
        join_back(join_back(members.withColumn("pair", F.struct("left_id", "rep_id")), scored, "pair", "pair", "left"), own, "rep_id", "rep_id")
        .select("record_id", "component", confidence.alias("confidence_score"))
    )


def attach_clusters(df: DataFrame, clusters: DataFrame, record_id: str) -> DataFrame:
    """Input rows that are in the cluster table, with its columns."""
    return df.join(clusters.withColumnRenamed("record_id", record_id), record_id)


def cluster_output(df: DataFrame, clusters: DataFrame, record_id: str) -> DataFrame:
    """Cluster number and confidence first, then the input columns."""
    numbered = number_clusters(clusters).drop("component")
    return to_front(attach_clusters(df, numbered, record_id), ["cluster_id", "confidence_score"])
