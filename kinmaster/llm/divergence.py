"""How far the sources of a language differ in their words: joint tables by matrix products.

Every (source, count) that occurs is a level, and has an indicator column over a language's
kept terms: one where the term occurs so often in the source. The product of that matrix
with its own transpose counts, for any two sources, the terms with one count here and another
there: all joint tables at once. What two sources differ by depends on counts alone, so it
is priced by joint table, an entry at a time, and not by term.

The product is taken in blocks: terms are dealt to rows of blocks by hash, sources to
tiles, and a task multiplies the columns of two tiles over one block of terms, strip by strip. A block's
matrix is bounded by ``BLOCK_TERMS`` and ``TILE`` whatever the number of terms, rows or sources, and as
tables of blocks only need adding, blocks are priced where they are.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinmaster.operators.joins import join_back
from kinmaster.operators.numbering import dense_number
from kinmaster.session import materialise, spread

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
BLOCK_TERMS = 2048
TILE = 32
STRIP = 1024
REMEMBERED = 200_000
# Bytes outside terms to blanks, A-Z to a-z.
_OUTSIDE = [*range(0x00, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TABLE = bytes(32 if c in _OUTSIDE else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


# --- counts -----------------------------------------------------------------------


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a null term for each (lang, source) there is."""
    import pyarrow as pa

    names = ["lang", "source", "term", "n", "docs"]
    types = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]

    def tell(group: tuple[str, str], found: Counter, inside: Counter) -> pa.RecordBatch:
        terms = [None, *found]
        columns = [[group[0]] * len(terms), [group[1]] * len(terms), terms, [0, *found.values()], [0, *(inside[t] for t in found)]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        held = 0
        for batch in batches:
            groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
            for group, text in zip(groups, batch.column("text"), strict=True):
                found, inside = counts.setdefault(group, (Counter(), Counter()))
                terms = text.as_py().translate(_TABLE).split()
                held -= len(found)
                found.update(terms)
                inside.update(set(terms))
                held += len(found)
                if held > REMEMBERED:
                    yield from (tell(g, *c) for g, c in counts.items())
                    counts, held = {}, 0
        yield from (tell(g, *c) for g, c in counts.items())

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column), F.lit(""))

    texts = spread(docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source"), filled(text_col).cast("binary").alias("text")))
    found = texts.mapInArrow(take, "lang string, source string, term binary, n bigint, docs bigint")
    summed = found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return summed.withColumn("term", F.col("term").cast("string"))


def share(count: str, total: str, kept: str) -> Column:
    """``1 + floor(SCALE * (count + 2) / (total + 2 * kept))``, exactly."""
    over = f"(cast({total} AS DECIMAL(19,0)) + 2 * cast({kept} AS DECIMAL(19,0)))"
    return F.expr(f"1 + (cast({SCALE} AS DECIMAL(10,0)) * (cast({count} AS DECIMAL(19,0)) + 2)) div nullif({over}, 0)")


def distance(p: str, q: str) -> Column:
    """``floor((p - q) ** 2 / (p + q))`` of two shares; below 2 ** 63 as shares are at most ``SCALE + 1``."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


class Profiles:
    """Counts of kept terms with their sizes, as written tables.

    ``groups``: (lang, source, total, kept, lang_total, zero), ``zero`` being the share of a term with count 0;
    ``entries``: (lang, source, term, n, p, q) for counts above 0, ``p`` the source's share and ``q`` the language's.
    """

    def __init__(self, docs: DataFrame, min_docs: int = MIN_DOCS, **columns):
        counts = materialise(term_counts(docs, **columns), "term_counts")
        terms = counts.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        kept = materialise(terms.where(F.col("docs") >= min_docs).select("lang", "term", "lang_n"), "kept_terms")
        counted = counts.where("term IS NOT NULL").join(kept, ["lang", "term"])
        sizes = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
        none = F.lit(0).cast("bigint")
        groups = (
            counts.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
            .select("lang", "source", *[F.coalesce(F.col(c), none).alias(c) for c in ("total", "kept", "lang_total")])
            .withColumn("zero", share("0", "total", "kept"))
        )
        self.groups = materialise(groups, "groups")
        entries = counted.join(self.groups, ["lang", "source"]).select(
            "lang", "source", "term", "n", share("n", "total", "kept").alias("p"), share("lang_n", "lang_total", "kept").alias("q")
        )
        self.kept = kept
        self.entries = materialise(entries, "entries")


# --- joint tables --------------------------------------------------------------------


def _strips(levels: np.ndarray, strip: int) -> Iterator[np.ndarray]:
    for first in range(0, len(levels), strip):
        yield levels[first:first + strip]


def _columns(numbers: np.ndarray, level: np.ndarray, n_terms: int, levels: np.ndarray) -> np.ndarray:
    """Indicator columns of a strip of ``levels`` over the terms of a block."""
    on = np.flatnonzero((level >= levels[0]) & (level <= levels[-1]))
    out = np.zeros((n_terms, len(levels)), dtype=np.float32)
    out[numbers[on], level[on] - levels[0]] = 1
    return out


def block_table(sources: list, terms: list, counts: np.ndarray, n_terms: int, roster: list, other: list, strip: int = STRIP):
    """Joint counts of a block: (left, left count, right, right count, number of terms) as arrays.

    ``sources``, ``terms`` and ``counts`` hold the counts above zero, ``roster`` and ``other`` all sources of
    the two tiles; each pair is told once, the lesser source left. Sums of at most
    ``n_terms`` ones are exact in 32-bit floats up to 2 ** 24 terms.
    """
    number = {t: i for i, t in enumerate(dict.fromkeys(terms))}
    rows = np.array([number[t] for t in terms], dtype=np.int64)
    everyone = sorted(set(roster) | set(other), key=lambda s: s.encode())
    place = {s: i for i, s in enumerate(everyone)}
    table = np.zeros((len(everyone), len(number)), dtype=np.int64)
    table[[place[s] for s in sources], rows] = counts
    # Terms of the block that are in neither tile have count 0 everywhere here.
    absent = n_terms - len(number)
    level_of, owner, value = np.zeros_like(table), [], []
    for i, line in enumerate(table):
        found, inverse = np.unique(np.append(line, 0) if absent else line, return_inverse=True)
        level_of[i] = inverse[: len(line)] + len(owner)
        owner += [i] * len(found)
        value += found.tolist()
    owner, value = np.array(owner, dtype=np.int64), np.array(value, dtype=np.int64)
    across = np.tile(np.arange(len(number)), len(everyone))
    left_side = np.isin(everyone, roster)[owner]
    right_side = np.isin(everyone, other)[owner]
    out = []
    flat = level_of.reshape(-1)
    for a in _strips(np.arange(len(owner)), strip):
        left = _columns(across, flat, len(number), a)
        for b in _strips(np.arange(a[0], len(owner)), strip):
            joint = left.T @ _columns(across, flat, len(number), b)
            i, j = np.nonzero(joint)
            x, y, n = a[i], b[j], joint[i, j].astype(np.int64)
            # Pairs within one tile, or across the two: every pair belongs to one pair of tiles.
            fits = (owner[x] < owner[y]) & ((left_side[x] & right_side[y]) | (right_side[x] & left_side[y]))
            out.append((x[fits], y[fits], n[fits]))
    x, y, n = (np.concatenate(c) for c in zip(*out, strict=True))
    if absent:
        zeros = {int(o): k for k, (o, v) in enumerate(zip(owner, value, strict=True)) if v == 0}
        pairs = [(zeros[i], zeros[j]) for i in range(len(everyone)) for j in range(i + 1, len(everyone))
                 if (everyone[i] in roster and everyone[j] in other) or (everyone[i] in other and everyone[j] in roster)]
        if pairs:
            more = np.array(pairs, dtype=np.int64)
            x, y, n = np.concatenate((x, more[:, 0])), np.concatenate((y, more[:, 1])), np.concatenate((n, np.full(len(pairs), absent)))
    return [everyone[i] for i in owner[x]], value[x], [everyone[i] for i in owner[y]], value[y], n


def block_tables(profiles: Profiles, block_terms: int = BLOCK_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, left, left_n, right, right_n, n_terms): joint tables of blocks of terms, to be added up.

    Of each two sources of a language the lesser one is left.
    """
    import pyarrow as pa

    placed = dense_number(profiles.groups, ["lang", "source"], "place", 0)
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    tiles = placed.join(first, "lang").withColumn("tile", F.expr(f"(place - first) div {tile}"))
    tiles = materialise(tiles.select("lang", "source", "kept", "tile"), "tiles")
    n_tiles = tiles.groupBy("lang").agg((F.max("tile") + 1).alias("n_tiles"))
    n_blocks = F.expr(f"greatest(1, (kept + {block_terms - 1}) div {block_terms})")
    meets = "explode(transform(sequence(0, n_tiles - 1), t -> struct(least(t, tile) AS a, greatest(t, tile) AS b))) AS meet"
    block = F.pmod(F.xxhash64("term"), n_blocks).alias("block")
    # Every block has all sources of its tiles, and knows how many terms it has.
    sized = profiles.kept.join(tiles.select("lang", "kept").distinct(), "lang").select("lang", block).groupBy("lang", "block").agg(F.count(F.lit(1)).alias("n_terms"))
    roster = tiles.join(n_tiles, "lang").join(sized, "lang").selectExpr(
        "lang", "block", meets, "source", "tile", "cast(NULL AS STRING) AS term", "n_terms AS n"
    )
    tiled = join_back(
        profiles.entries.select("term", "n", F.struct("lang", "source").alias("own")),
        tiles.join(n_tiles, "lang").select(F.struct("lang", "source").alias("key"), "lang", "source", "tile", "kept", "n_tiles"), "own", "key",
    )
    cells = tiled.select("lang", block, F.expr(meets), "source", "tile", "term", "n")
    keys = ["lang", "block", "meet"]
    schema = "lang string, left string, left_n bigint, right string, right_n bigint, n_terms bigint"

    def multiply(table: pa.Table) -> pa.Table:
        lang, meet = table.column("lang")[0].as_py(), table.column("meet")[0].as_py()
        sources, terms, tiles_of = (table.column(c).to_pylist() for c in ("source", "term", "tile"))
        n = table.column("n").to_numpy()
        here = [i for i, t in enumerate(terms) if t is None]
        there = [i for i, t in enumerate(terms) if t is not None]
        found = block_table(
            [sources[i] for i in there], [terms[i] for i in there], n[there], int(n[here[0]]),
            [sources[i] for i in here if tiles_of[i] == meet["a"]], [sources[i] for i in here if tiles_of[i] == meet["b"]],
        )
        columns = [[lang] * len(found[0]), *found]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in schema.split(", ")])

    return roster.unionByName(cells).groupBy(*keys).applyInArrow(multiply, schema)


def joint_tables(profiles: Profiles, block_terms: int = BLOCK_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, left, left_n, right, right_n, n_terms): kept terms with each pair of counts, for each two sources."""
    keys = ["lang", "left", "left_n", "right", "right_n"]
    return block_tables(profiles, block_terms, tile).groupBy(*keys).agg(F.sum("n_terms").alias("n_terms"))


# --- results -----------------------------------------------------------------------


def pair_values(profiles: Profiles, block_terms: int = BLOCK_TERMS, tile: int = TILE) -> DataFrame:
    """(lang, source, item, value): the sum of distances over all kept terms, for each source and each other one."""
    def side(name: str) -> DataFrame:
        return profiles.groups.select(F.struct("lang", "source").alias(f"{name}_key"), F.col("total").alias(f"{name}_total"), F.col("kept").alias(f"{name}_kept"))

    joint = block_tables(profiles, block_terms, tile).withColumns({"l": F.struct("lang", "left"), "r": F.struct("lang", "right")})
    priced = join_back(join_back(joint, side("left"), "l", "left_key"), side("right"), "r", "right_key")
    shares = priced.withColumns({"p": share("left_n", "left_total", "left_kept"), "q": share("right_n", "right_total", "right_kept")})
    values = shares.groupBy("lang", "left", "right").agg(F.sum(F.col("n_terms") * distance("p", "q")).alias("value"))
    both = values.select("lang", F.col("left").alias("source"), F.col("right").alias("item"), "value").union(
        values.select("lang", "right", "left", "value")
    )
    # Languages without kept terms have no block; their sources differ by nothing.
    empty = profiles.groups.where("kept = 0").select("lang", "source")
    nothing = empty.join(empty.withColumnRenamed("source", "item"), "lang").where("source <> item")
    return both.union(nothing.select("lang", "source", "item", F.lit(0).cast("bigint")))


def term_values(profiles: Profiles) -> DataFrame:
    """(lang, source, item, value): kept terms that a source has more of than its language."""
    return profiles.entries.where("p > q").select("lang", "source", F.col("term").alias("item"), distance("p", "q").alias("value"))


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_terms: int = BLOCK_TERMS, tile: int = TILE, **columns
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from others (``pair``) and by which terms (``term``).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z small; those in fewer than ``min_docs``
    documents of a language are left out. Null texts, languages and sources are empty ones; a source without terms is a source.
    Repeated rows count as often as they come. Ranks are by value, then by the item's bytes. An empty table has
    no rows. Other columns are not looked at; ``lang_col``, ``source_col``, ``text_col`` name the three that are.
    """
    profiles = Profiles(docs, min_docs, **columns)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_values(profiles, block_terms, tile).withColumn("rank", F.row_number().over(order))
    terms = term_values(profiles).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_terms)
    shown = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).select(shown).union(terms.withColumn("part", F.lit("term")).select(shown))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of sources of each language of all documents, and each source's ten most telling terms."""
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "source", "text"))


OP13_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce("source", '') AS source,
    regexp_extract_all(coalesce("text", ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), t AS (
  SELECT i, lang, source, translate(unnest(terms), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d
), c AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT i) AS docs FROM t GROUP BY ALL
), kept AS MATERIALIZED (
  SELECT lang, term, sum(n) AS lang_n FROM c GROUP BY ALL HAVING sum(docs) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), grid AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, lang_n
  FROM g JOIN kept ON kept.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
), sized AS (
  SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total,
    count(*) OVER (PARTITION BY lang, source) AS v FROM grid
), p AS MATERIALIZED (
  SELECT lang, source, term, n, (1 + 1000000000::HUGEINT * (n + 2) // (total + 2 * v)::HUGEINT) AS p,
    (1 + 1000000000::HUGEINT * (lang_n + 2) // (lang_total + 2 * v)::HUGEINT) AS q FROM sized
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), everything AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q
)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INT AS rank
FROM everything QUALIFY part = 'pair' OR rank <= 10
"""
