"""Approximate nearest neighbours by shifted Hilbert orderings.

Vectors are projected to a few dimensions, shifted, and ordered along a Hilbert
curve; several projections and shifts give several orderings. Spark range-partitions
each, and a query is compared with the rows in a window around its own place in every
ordering. Candidates of all windows are merged and ranked by their exact cosine.

How wide a window must be depends on the data. It is measured: the exact neighbours
of a bounded sample of queries are found by a scan, and the window is made as wide as
most of them need in their best ordering.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinmaster.operators.numbering import dense_number
from kinmaster.session import materialise

K = 5
ORDERINGS = 8
DIMENSIONS = 3
CURVE_BITS = 10
BLOCK = 2048
# Bounds of what is measured: queries, and vectors from which scale and middle are taken.
SAMPLE_QUERIES = 64
SAMPLE_VECTORS = 4096
TARGET_RECALL = 0.97
QUERIES_AT_ONCE = 2048
SEED = 7


def usable(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates (Skilling's method)."""
    x = cells.astype(np.uint64).T.copy()
    n, one = len(x), np.uint64(1)
    for shift in range(bits - 1, 0, -1):
        q, low = np.uint64(1 << shift), np.uint64((1 << shift) - 1)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for shift in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint64(shift)) & one, np.uint64((1 << shift) - 1), np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for shift in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(shift)) & one)
    return key.astype(np.int64)


class Orderings:
    """Projections and shifts, fitted to the middle and scale of a sample."""

    def __init__(self, sample: np.ndarray, n: int = ORDERINGS, dimensions: int = DIMENSIONS, bits: int = CURVE_BITS):
        rng = np.random.default_rng(SEED)
        unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
        width = sample.shape[1]
        self.middle, self.bits = unit.mean(axis=0), bits
        # Orthogonal directions as long as there are enough, so that orderings differ.
        directions: list[np.ndarray] = []
        while len(directions) < n * dimensions:
            q, _ = np.linalg.qr(rng.standard_normal((width, width)))
            directions.extend(q.T)
        self.directions = np.array(directions[: n * dimensions]).reshape(n, dimensions, width)
        spread = ((unit - self.middle) @ self.directions.reshape(-1, width).T).std(axis=0)
        self.scale = np.where(spread > 0, spread, 1.0).reshape(n, dimensions)
        self.shift = rng.uniform(-0.5, 0.5, (n, dimensions))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, orderings) places of unit vectors."""
        out = np.empty((len(vectors), len(self.directions)), dtype=np.int64)
        for c, d in enumerate(self.directions):
            place = (vectors - self.middle) @ d.T / self.scale[c] + self.shift[c]
            # The normal distribution function spreads the middle, where most are, over the cells.
            share = 0.5 * (1 + np.tanh(0.8 * place))
            cells = np.clip((share * (1 << self.bits)).astype(np.int64), 0, (1 << self.bits) - 1)
            out[:, c] = hilbert_keys(cells, self.bits)
        return out


def _unit(column) -> np.ndarray:
    vectors = np.array(column.to_list(), dtype=np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _nearest(queries: np.ndarray, rows: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, row numbers, cosines) of the ``n`` nearest, some queries at a time."""
    n = min(n, len(rows))
    for first in range(0, len(queries), 512):
        scores = queries[first:first + 512] @ rows.T
        best = np.argpartition(-scores, n - 1, axis=1)[:, :n]
        for i, b in enumerate(best):
            yield first + i, b, scores[i, b]


def exact_neighbours(nodes: DataFrame, sample: list[tuple[int, np.ndarray]], n: int) -> DataFrame:
    """(query, node, score): the ``n`` nearest nodes of each sampled query, from a scan of all nodes."""
    import pandas as pd

    shared = nodes.sparkSession.sparkContext.broadcast(([i for i, _ in sample], np.array([v for _, v in sample])))

    def scan(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, queries = shared.value
        for frame in frames:
            if len(frame):
                own, ids = _unit(frame["vector"]), frame["node"].to_numpy()
                found = [(names[q], ids[b], s) for q, rows, scores in _nearest(queries, own, n) for b, s in zip(rows, scores, strict=True)]
                yield pd.DataFrame(found, columns=["query", "node", "score"])

    found = nodes.select("node", "vector").mapInPandas(scan, "query bigint, node bigint, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "node")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= n).drop("n")


def place(nodes: DataFrame, orderings: Orderings) -> DataFrame:
    """(curve, node, position): places 0, 1, ... of all nodes in each ordering."""
    import pandas as pd

    shared = nodes.sparkSession.sparkContext.broadcast(orderings)

    def keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                found = shared.value.keys(_unit(frame["vector"]))
                curves = np.tile(np.arange(found.shape[1], dtype=np.int32), len(found))
                yield pd.DataFrame({"curve": curves, "node": np.repeat(frame["node"].to_numpy(), found.shape[1]), "key": found.reshape(-1)})

    keyed = nodes.select("node", "vector").mapInPandas(keys, "curve int, node bigint, key bigint")
    numbered = dense_number(keyed, ["curve", "key", "node"], "number", 0)
    total = nodes.count()
    return numbered.select("curve", "node", (F.col("number") - F.col("curve") * F.lit(total)).alias("position"))


def window_width(places: DataFrame, exact: DataFrame, target: float) -> int:
    """Half the rows a window needs so that ``target`` of the exact neighbours are in one of a query's windows."""
    own = places.select(F.col("node").alias("query"), "curve", F.col("position").alias("own"))
    gaps = (
        exact.join(places, "node").join(own, ["query", "curve"])
        .groupBy("query", "node").agg(F.min(F.abs(F.col("position") - F.col("own"))).alias("gap")).collect()
    )
    ordered = sorted(r["gap"] for r in gaps)
    return int(ordered[min(len(ordered) - 1, math.ceil(target * len(ordered)) - 1)]) + 1 if ordered else 1


def nearest_neighbours(
    table: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
    orderings: int = ORDERINGS, target_recall: float = TARGET_RECALL, block: int = BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row, the ``k`` other rows of largest cosine found.

    Rows whose vector is not ``usable`` or whose id is null take no part, nor do
    vectors of another length than most. Rows that repeat an id count once. Scores are computed from the vectors as given,
    in double precision; ties go to the smaller id. A query with fewer than ``k`` others gets all. Equal vectors are one
    node, of which the ``k + 1`` smallest ids are kept: more can never be among the ``k`` nearest.
    """
    import pandas as pd

    spark = table.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = table.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    rows = rows.where(usable(F.col("vector")) & F.col("id").isNotNull()).withColumn("width", F.size("vector"))
    widths = rows.groupBy("width").count().orderBy(F.desc("count"), "width").first()
    if widths is None:
        return empty
    rows = rows.where(F.col("width") == widths["width"]).drop("width")
    same = Window.partitionBy("vector").orderBy("id")
    few = rows.select("id", "vector").withColumn("n", F.dense_rank().over(same)).where(F.col("n") <= k + 1)
    grouped = few.groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    nodes = materialise(grouped.select(F.element_at("ids", 1).alias("node"), "ids", "vector"), "nodes")
    node_of = nodes.select("node", F.col("vector").alias("v"))
    asked = materialise(
        rows.where("asks").select("id", "vector").dropDuplicates(["id"]).join(node_of, F.col("vector") == F.col("v")).select("id", "node", "vector"),
        "queries",
    )
    queries = asked.groupBy("node").agg(F.first("vector").alias("vector"))

    drawn = queries.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_QUERIES).collect()
    if not drawn:
        return empty
    sample = [(r["node"], np.array(r["vector"]) / np.linalg.norm(r["vector"])) for r in drawn]
    some = nodes.orderBy(F.xxhash64("node"), "node").limit(SAMPLE_VECTORS).select("vector").collect()
    places = materialise(place(nodes, Orderings(np.array([r["vector"] for r in some]), orderings)), "places")
    exact = materialise(exact_neighbours(nodes, sample, k + 1), "exact")
    width = window_width(places, exact, target_recall)

    # Blocks of consecutive places; a query goes to every block that its window touches.
    located = places.withColumn("block", F.floor(F.col("position") / block).cast("int"))
    members = located.join(nodes.select("node", "vector"), "node")
    n_queries, n_nodes = queries.count(), nodes.count()
    per_block = n_queries * min(1.0, (2.0 * width + block) / n_nodes)
    splits = max(1, math.ceil(per_block / QUERIES_AT_ONCE))
    members = members.withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))) if splits > 1 else members.withColumn("split", F.lit(0))
    top = (n_nodes - 1) // block
    first = F.greatest(F.floor((F.col("position") - width) / block), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("position") + width) / block), F.lit(top)).cast("int")
    sent = (
        places.join(queries, "node").withColumn("block", F.explode(F.sequence(first, last)))
        .withColumn("split", F.pmod(F.xxhash64("node"), F.lit(splits)).cast("int"))
        .select(*[F.col(c).alias(f"q_{c}") for c in ("curve", "block", "split", "node", "vector")])
    )
    keep = k + 4

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query", "node", "score"]
        if not len(left) or not len(right):
            return pd.DataFrame({"query": [], "node": [], "score": []}, columns=columns)
        names, ids = left["q_node"].to_numpy(), right["node"].to_numpy()
        found = [(names[q], ids[b], s) for q, near, scores in _nearest(_unit(left["q_vector"]), _unit(right["vector"]), keep)
                 for b, s in zip(near, scores, strict=True)]
        return pd.DataFrame(found, columns=columns)

    group = ["curve", "block", "split"]
    found = sent.groupBy(*[f"q_{c}" for c in group]).cogroup(members.select(*group, "node", "vector").groupBy(*group)).applyInPandas(
        compare, "query bigint, node bigint, score double"
    )
    # One pair may be found in several orderings.
    merged = found.groupBy("query", "node").agg(F.max("score").alias("near"))
    nearest = Window.partitionBy("query").orderBy(F.desc("near"), "node")
    short = merged.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= keep).select("query", F.col("node").alias("other"))

    candidates = short.join(asked.select(F.col("node").alias("query"), F.col("id").alias("query_id"), F.col("vector").alias("a")), "query").join(
        nodes.select(F.col("node").alias("other"), "ids", F.col("vector").alias("b")), "other"
    )
    scored = candidates.select("query_id", F.explode("ids").alias("vec_id"), cosine(F.col("a"), F.col("b")).alias("score")).where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)

    def length(v: Column) -> Column:
        return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))

    return dot / (length(a) * length(b))


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    """The five nearest rows found for every row whose id is divisible by 50."""
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(table, F.col("vec_id") % 50 == 0)
