"""Near-duplicate documents by an inverted join over MinHash coordinates.

Every distinct text has a signature of minima, one per coordinate, and is posted
under each (coordinate, value). Texts similar enough agree in at least
``MATCHES`` of the coordinates, so they meet in some list even if each skips its
``MATCHES - 1`` most frequent ones: only the prefix, the rarer rest, is joined. The
agreements of a pair are counted, those with enough are compared by their whole
sets. Which order the coordinates have decides the cost alone, not the result.

Only components are wanted, so a list's members meet its hub first. Members of a list that
hubs leave in several components skip it where a bound forbids a link: shingles that no
other component has cannot be common. What is left is merged on the prefix of the
rarest shingles, which is exact too, instead of pair by pair in the list.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmaster.llm.narrowing import apart, divided
from kinmaster.llm.wordbytes import MIX_1, MIX_2, chunks, mix, separator_table, word_hashes
from kinmaster.operators.clustering import connected_components
from kinmaster.operators.joins import join_back
from kinmaster.session import materialise

SHINGLE = 5
SIMILARITY = 0.8
# At a similarity of 0.8, 36 of 64 coordinates agree but for about 4 of a million pairs; the
# chance of a miss falls quickly above that.
COORDINATES = 64
MATCHES = 36
TABLE = separator_table(b"\t\n\x0b\x0c\r ")
_BLOCK = 2048


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of runs of ``size`` words; of the whole sequence if that is shorter."""
    n = len(words)
    if not n:
        return words
    width = min(size, n)
    value = np.full(n - width + 1, width, dtype=np.uint64)
    for k in range(width):
        value = mix(value * MIX_2 + words[k:n - width + 1 + k])
    return np.unique(value)


class Signer:
    """Minima of a set under ``n`` hash functions (64 bits each)."""

    def __init__(self, n: int = COORDINATES):
        seeds = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * MIX_1)
        self.xor, self.factor = seeds[:n, None], seeds[n:, None] | np.uint64(1)

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        least = None
        for i in range(0, len(hashes), _BLOCK):
            values = ((hashes[None, i:i + _BLOCK] ^ self.xor) * self.factor).min(axis=1)
            least = values if least is None else np.minimum(least, values)
        return least


def _sets(batch, text_col: str, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets) of some rows at a time: the sets of a whole batch are several times its texts."""
    for first, parts in chunks(t.as_py() for t in batch.column(text_col)):
        hashes, counts = word_hashes(parts, TABLE)
        ends = np.cumsum(counts)
        yield first, [shingle_hashes(hashes[end - count:end], size) for end, count in zip(ends.tolist(), counts.tolist(), strict=True)]


def _name(shingles: np.ndarray) -> tuple[np.int64, np.int64]:
    """128 bits that name a set."""
    a = np.sum(mix(shingles + MIX_1), dtype=np.uint64)
    return a.astype(np.int64), np.bitwise_xor.reduce(mix(shingles * MIX_2), initial=np.uint64(0)).astype(np.int64)


def sketch(docs: DataFrame, shingle: int = SHINGLE, coordinates: int = COORDINATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_a, set_b, signature): ``set_a, set_b`` name the set (128 bits)."""
    import pyarrow as pa

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(coordinates)
        for batch in batches:
            for first, sets in _sets(batch, text_col, shingle):
                names = [_name(s) for s in sets]
                signatures = [signer.sign(s).astype(np.int64) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array([n[0] for n in names], pa.int64()),
                     pa.array([n[1] for n in names], pa.int64()), pa.array(signatures, pa.list_(pa.int64()))],
                    ["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return docs.select(F.col(id_col).cast("bigint").alias(id_col), text_col).mapInArrow(
        sign, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, signature array<bigint>"
    )


def whole_sets(docs: DataFrame, shingle: int, text_col: str) -> DataFrame:
    """(set_a, set_b, shingles): the name and the whole set of each row."""
    import pyarrow as pa

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets in _sets(batch, text_col, shingle):
                names = [_name(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()),
                     pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))],
                    ["set_a", "set_b", "shingles"],
                )

    return docs.select(text_col).mapInArrow(read, "set_a bigint, set_b bigint, shingles array<bigint>")


def posting_lists(signed: DataFrame, coordinates: int = COORDINATES, matches: int = MATCHES) -> DataFrame:
    """(key, node, size, alone) for the prefix of each signature, lists of at least two nodes.

    ``signed`` has ``node``, ``size`` and ``signature``. Values that nobody else has come first
    in a node's order, so a node with enough of them is in no list at all; ``alone`` is their number.
    """
    sizes = signed.select(F.col("node").alias("sized"), "size")
    values = signed.select("node", F.posexplode("signature").alias("at", "value"))
    posted = values.select("node", F.xxhash64("at", "value").alias("key"))
    shared = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    found = join_back(posted, shared, "key", "key")
    by_node = found.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("entries"))
    alone = coordinates - F.size("entries")
    keep = coordinates - matches + 1 - alone
    few = by_node.where(keep > 0).join(sizes, F.col("node") == F.col("sized"))
    prefix = few.select("node", "size", alone.alias("alone"), F.explode(F.slice("entries", F.lit(1), keep)).alias("entry"))
    return prefix.select(F.col("entry.key").alias("key"), "node", "size", "alone")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("left_id"), F.greatest("a", "b").alias("right_id")).distinct()


def hub_pairs(members: DataFrame, rank: str, ratio: float) -> DataFrame:
    """(left_id, right_id): every member of a list with its hub, the one of lowest ``rank``.

    The best placed node of a family is the hub of nearly all its lists, so the pairs are few.
    """
    hubs = members.groupBy("key").agg(F.min(F.struct(rank, "node", "size", "component")).alias("hub"))
    fits = F.least("hub.size", "size") >= F.lit(ratio) * F.greatest("hub.size", "size") - 1e-9
    pairs = join_back(members, hubs, "key", "key").where((F.col("hub.component") != F.col("component")) & fits)
    return _ordered(pairs.select(F.col("hub.node").alias("a"), F.col("node").alias("b")))


def common_shingles(members: DataFrame, known: DataFrame) -> DataFrame:
    """(holder, shingle, n) of the members' shingles that several components have; ``n`` members have it."""
    nodes = members.select(F.col("node").alias("holder"), "component").distinct()
    held = known.join(nodes, F.col("node") == F.col("holder")).select("holder", "component", F.explode("shingles").alias("shingle"))
    counted = held.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi")
    ).where("lo < hi").select("shingle", "n")
    return join_back(held.select("holder", "shingle"), counted, "shingle", "shingle")


def open_members(members: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """(key, node, size, component, most, least): members that may have a link to another component of the list.

    Two sets of ``a`` and ``b`` shingles with ``c`` in common are similar if
    ``(100 + percent) * c >= percent * (a + b)``. ``c`` is at most what of either is common
    to several components, so a member's partners have at most ``most`` shingles; ``least`` are those
    of its smallest one.
    """
    counts = common.groupBy("holder").agg(F.count(F.lit(1)).alias("shared"))
    most = F.floor((100 + percent) * F.col("shared") / percent + 1e-9) - F.col("size")
    placed = join_back(members, counts, "node", "holder").select("key", "node", "size", "component", most.alias("most")).where("most > 0")
    # The best of each list and, for its own component, the best of the others.
    first = placed.groupBy("key").agg(
        F.max(F.struct("most", "component")).alias("wide"), F.min(F.struct("size", "component")).alias("small")
    )
    both = materialise(join_back(placed, first, "key", "key"), "placed")
    other = both.groupBy("key").agg(
        F.max(F.when(F.col("component") != F.col("wide.component"), F.col("most"))).alias("next_most"),
        F.min(F.when(F.col("component") != F.col("small.component"), F.col("size"))).alias("next_size"),
    ).where("next_most IS NOT NULL")
    widest = F.when(F.col("component") != F.col("wide.component"), F.col("wide.most")).otherwise(F.col("next_most"))
    least = F.when(F.col("component") != F.col("small.component"), F.col("small.size")).otherwise(F.col("next_size"))
    return (
        join_back(both, other, "key", "key").where((F.col("size") <= widest) & (least <= F.col("most")))
        .select("key", "node", "size", "component", "most", least.alias("least"))
    )


def rarest_shingles(members: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """(key, node, size, left) lists of shingles: two similar sets of different components share one.

    ``o`` shingles are common to similar sets, so they share one of the first ``a - o + 1`` of each in
    any order of all shingles: first those that one component alone has (they need no list), then the rarest.
    ``left`` is how many of the set's come from this one on: of the first that two sets share, at least ``o``.
    """
    nodes = members.groupBy("node", "size").agg(F.min("least").alias("least"))
    entries = join_back(common, nodes.select("node"), "holder", "node", "left_semi").groupBy("holder").agg(
        F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("entries")
    )
    overlap = F.ceil(percent * (F.col("size") + F.col("least")) / (100 + percent) - 1e-9)
    # a - o + 1 in all, of which a - size(entries) need no list.
    keep = F.greatest(F.size("entries") - overlap + 1, F.lit(0)).cast("int")
    prefix = entries.join(nodes, F.col("holder") == F.col("node")).select(
        "node", "size", F.size("entries").alias("all"), F.posexplode(F.slice("entries", F.lit(1), keep)).alias("at", "entry")
    )
    return prefix.select(F.col("entry.shingle").alias("key"), "node", "size", (F.col("all") - F.col("at")).alias("left"))


def collision_links(
    lists: DataFrame, known: DataFrame, confirm: Callable[[DataFrame], DataFrame], similarity: float
) -> DataFrame:
    """Confirmed (left_id, right_id) with the same components as all confirmed pairs that meet in ``lists``.

    ``known`` has the whole set (node, shingles) of every node of the lists.
    """
    percent = round(100 * similarity)
    nodes = lists.select(F.col("node").alias("record_id")).distinct()
    links = materialise(confirm(hub_pairs(lists.withColumn("component", F.col("node")), "alone", similarity)), "links")

    def left_open() -> tuple[DataFrame, DataFrame, DataFrame]:
        components = materialise(connected_components(nodes, links), "components")
        rest = materialise(divided(lists.select("key", "node", "size"), components).drop("main"), "divided")
        common = materialise(common_shingles(rest, known), "common")
        return materialise(open_members(rest, common, percent), "open"), common, components

    members, _, _ = left_open()
    if members.isEmpty():
        return links
    found = confirm(hub_pairs(members.withColumn("rank", F.col("size") - F.col("most")), "rank", similarity))
    links = materialise(links.union(found).distinct(), "links")
    members, common, components = left_open()
    merged = materialise(divided(rarest_shingles(members, common, percent), components), "merged")
    enough = (100 + percent) * F.least("own_left", "left") >= percent * (F.col("own_size") + F.col("size"))
    more = confirm(apart(merged, similarity, enough))
    return materialise(links.union(more).distinct(), "links")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, coordinates: int = COORDINATES,
    matches: int = MATCHES, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Rows are linked if their sets of ``shingle``-word runs have a Jaccard
    similarity of at least ``similarity``; words are divided by ASCII white space,
    A-Z small. A text of fewer words is one run; one of no words (or null) has an
    empty set and no links. ``component_id`` is the smallest id that can be reached
    over links, ``kept`` whether that is the row's own. Rows with a null id are
    linked with nothing and kept (their component is null); rows with one id are
    one document, whose texts are linked (its ids must be numbers). Other columns are not looked at.
    """
    sketched = materialise(sketch(docs, shingle, coordinates, id_col, text_col), "sketches")
    linkable = sketched.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Equal sets are one node. Its number is written, so it stays the same.
    sets = ["set_a", "set_b", "n_shingles"]
    distinct = linkable.groupBy(*sets).agg(F.min("doc_id").alias("lowest"), F.first("signature").alias("signature"))
    nodes = materialise(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    lists = materialise(posting_lists(nodes.select("node", F.col("n_shingles").alias("size"), "signature"), coordinates, matches), "lists")
    wanted = nodes.join(lists.select(F.col("node").alias("listed")).distinct(), F.col("node") == F.col("listed"), "left_semi")
    sources = wanted.select(F.col("lowest").alias("__lowest"))
    texts = docs.select(id_col, text_col).join(sources, F.col(id_col).cast("bigint") == F.col("__lowest"), "left_semi")
    read = whole_sets(texts, shingle, text_col).select("shingles", F.struct("set_a", "set_b", F.size("shingles").cast("bigint").alias("n")).alias("read"))
    named = wanted.select(F.struct("set_a", "set_b", F.col("n_shingles").alias("n")).alias("name"), "node", F.col("n_shingles").alias("size"), "signature")
    known = materialise(
        read.join(named, F.col("read") == F.col("name")).select("node", "size", "signature", "shingles").dropDuplicates(["node"]), "sets"
    )

    def confirm(pairs: DataFrame) -> DataFrame:
        def side(name: str, *columns: str) -> DataFrame:
            return known.select(F.col("node").alias(f"{name}_id"), *[F.col(c).alias(f"{name}_{c}") for c in columns])

        agree = F.size(F.filter(F.zip_with("left_signature", "right_signature", lambda x, y: x == y), lambda same: same))
        small, large = F.least("left_size", "right_size"), F.greatest("left_size", "right_size")
        likely = (
            pairs.join(side("left", "signature", "size"), "left_id").join(side("right", "signature", "size"), "right_id")
            .where((100 * small >= round(100 * similarity) * large) & (agree >= matches)).select("left_id", "right_id")
        )
        both = likely.join(side("left", "shingles"), "left_id").join(side("right", "shingles"), "right_id")
        common = F.size(F.array_intersect("left_shingles", "right_shingles"))
        union = F.size("left_shingles") + F.size("right_shingles") - common
        return both.where(100 * common >= round(100 * similarity) * union).select("left_id", "right_id")

    links = collision_links(lists, known, confirm, similarity)
    # Sets of one id are one document: links tie them together.
    of_rows = linkable.select("doc_id", F.struct(*sets).alias("own_set"))
    repeated = of_rows.groupBy("doc_id").agg(F.min("own_set").alias("one"), F.max("own_set").alias("two")).where("one < two")
    several = join_back(of_rows, repeated.select("doc_id", "one"), "doc_id", "doc_id").where("one < own_set").select("one", "own_set").distinct()
    node_of = nodes.select(F.struct(*sets).alias("set_key"), "node")
    tied = (
        several.join(node_of.select(F.col("set_key").alias("one"), F.col("node").alias("left_id")), "one")
        .join(node_of.select(F.col("set_key").alias("own_set"), F.col("node").alias("right_id")), "own_set")
    )
    links = links.union(tied.select("left_id", "right_id"))
    components = materialise(
        connected_components(links.select(F.explode(F.array("left_id", "right_id")).alias("record_id")).distinct(), links), "components"
    )
    linked = components.join(nodes.select("node", "lowest"), F.col("record_id") == F.col("node")).select("record_id", "component", "lowest")
    lowest = linked.groupBy("component").agg(F.min("lowest").alias("component_id"))
    by_node = join_back(linked.select("record_id", "component"), lowest, "component", "component").select("record_id", "component_id")
    placed = nodes.join(by_node, F.col("node") == F.col("record_id"), "left").select(
        F.struct(*sets).alias("set_key"), F.coalesce("component_id", "lowest").alias("component_id")
    )
    rows = sketched.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.struct(*sets)).alias("own_set"))
    joined = join_back(rows, placed, "own_set", "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id"))
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows that have a near duplicate of smaller id; same columns.

    Rows with a null id stay; rows that repeat an id stay or go together.
    """
    gone = near_duplicates(docs, id_col=id_col, **options).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col) == F.col("__gone"), "left_anti")


def op8_near_dup(spark, sf_dir: str) -> DataFrame:
    """Set size, component and decision of every document; sets of four-word runs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=4)
