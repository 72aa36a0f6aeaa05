"""Phrases whose words stand together more often than chance, by best-first growth with bounds.

A phrase of several words is scored at its weakest cut: ``1000 * a * n / (l * r)`` with
``a`` its own count, ``l`` and ``r`` those of its two parts. As ``r`` is at least ``a``, no phrase
that begins with a word of count ``f`` scores above ``1000 * n / f``: prefix counts bound the
scores of all that grows from them. So the frontier of first words is expanded from the
rarest on, in a few batches; each batch grows prefixes word by word as long as they are
frequent. When the bound of every first word that is left lies below a language's last
wanted score, the language is settled and its other words, the most frequent ones that
make up most of the text, are never expanded.

Grown phrases are bounded more closely by their last cut, whose counts are known, and looked at
in order of that bound: the best of each language first, then those of the rest that may
still reach the floor these set.

Texts become arrays of 64-bit word codes once. What may be counted in a pass is told to
the tasks by bitmaps over hashes: of fixed size however many words and phrases there
are, without a wrong no, and a wrong yes costs a count that is thrown away. Counts are
taken inside tasks first and added up by whole phrases, never by hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinmaster.llm.wordbytes import MIX_2, mix, separator_table
from kinmaster.session import materialise, scratch_path, spread

MIN_COUNT = 100
TOP = 2000
LONGEST = 5
# First words are expanded in this many batches: those of at most a 4096th of all words, of a 64th, the rest.
SHARES = (4096, 64, 1)
BITMAP_BITS = 24
CHUNK_WORDS = 2_000_000
REMEMBERED = 200_000
# Groups of a length that a task adds up before it tells them.
HELD_GROUPS = 500_000
BREAK = b"\xff"
_PIECES = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(0xFF if c in _PIECES else t for c, t in enumerate(separator_table(b"\t ")))


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A-Z small, and a ``BREAK`` (no byte of any text) where a piece ends."""
    return text.translate(_TABLE).replace(BREAK, b" \xff ").split()


# --- words ------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, f) of rows with ``lang`` and ``text`` (binary)."""
    import pyarrow as pa

    def tell(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, found in counts.items() for word, n in found.items() if word != BREAK]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()), strict=True)], ["lang", "word", "f"])

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                counts.setdefault(lang, Counter()).update(tokens(text.as_py()))
                if len(counts[lang]) > REMEMBERED:
                    yield tell({lang: counts.pop(lang)})
        yield tell(counts)

    found = texts.mapInArrow(take, "lang string, word binary, f bigint")
    return found.groupBy("lang", "word").agg(F.sum("f").alias("f")).select("lang", F.col("word").cast("string").alias("word"), "f")


def code_of(salt: int) -> Column:
    return F.xxhash64(F.lit(str(salt)), "lang", "word")


def coded_words(words: DataFrame) -> tuple[DataFrame, int]:
    """(words with ``code``, the salt): no two words of any language have one code, none has 0."""
    for salt in count():
        coded = words.withColumn("code", code_of(salt))
        if coded.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR code = 0").isEmpty():
            return coded, salt
    raise AssertionError


class _Codes(dict):
    """Codes of one language's words as met: as ``code_of``, 0 for breaks and words that are not wanted."""

    def __init__(self, lang: str, salt: int, wanted: bytes):
        import xxhash

        self.hash, self.wanted, self.mask = xxhash.xxh64_intdigest, wanted, len(wanted) * 8 - 1
        self.seed = self.hash(lang.encode(), self.hash(str(salt).encode(), 42))

    def __missing__(self, word: bytes) -> int:
        code = 0 if word == BREAK else self.hash(word, self.seed)
        slot = code & self.mask
        # The test of ``has``, for one word.
        if not self.wanted[slot >> 3] >> (slot & 7) & 1:
            code = 0
        code = self[word] = code - (1 << 64) if code >> 63 else code
        return code


def code_texts(texts: DataFrame, salt: int, wanted: np.ndarray) -> DataFrame:
    """(codes): an array of word codes per text, 0 where a phrase cannot go on, and at the end."""
    import pyarrow as pa

    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, _Codes] = {}
        bits = shared.value.tobytes()
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for first in range(0, batch.num_rows, 200):
                rows = []
                for lang, text in zip(langs[first:first + 200], batch.column("text").slice(first, 200), strict=True):
                    codes = known.get(lang)
                    if codes is None or len(codes) > REMEMBERED:
                        codes = known[lang] = _Codes(lang, salt, bits)
                    found = np.array([*map(codes.__getitem__, tokens(text.as_py())), 0], dtype=np.int64)
                    # One break says as much as several.
                    rows.append(found[(found != 0) | (np.append(found[1:], 1) != 0)])
                limits = np.cumsum([0, *map(len, rows)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(limits, np.concatenate(rows))], ["codes"])

    return texts.mapInArrow(encode, "codes array<bigint>")


# --- bitmaps -----------------------------------------------------------------------


def has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes.view(np.uint64) & np.uint64(len(bitmap) * 8 - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1


def longer_hash(hashes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Hashes of phrases with one more word; that of one word is its code."""
    return mix(hashes.view(np.uint64) * MIX_2 + codes.view(np.uint64))


def bitmap_of(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bitmap over the hashes of ``p`` (arrays of codes): ``2 ** bits`` bits, all that comes to the driver."""
    import pyarrow as pa

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = batch.column("p")
            values, limits = arrays.values.to_numpy(), arrays.offsets.to_numpy()
            sizes = np.diff(limits)
            hashes = values[limits[:-1]].view(np.uint64).copy()
            for k in range(1, int(sizes.max(initial=0))):
                on = np.flatnonzero(sizes > k)
                hashes[on] = longer_hash(hashes[on], values[limits[:-1][on] + k])
            yield pa.RecordBatch.from_arrays([pa.array((hashes & np.uint64((1 << bits) - 1)).astype(np.int64))], ["slot"])

    found = phrases.select("p").mapInArrow(slots, "slot bigint").groupBy(F.shiftright("slot", 6).alias("at"))
    words = found.agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS INT)))").alias("set")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
    bitmap[words.column("at").to_numpy()] = words.column("set").to_numpy()
    return bitmap.view(np.uint8)


# --- counting ----------------------------------------------------------------------


def _flat(batches: Iterator, most: int = CHUNK_WORDS) -> Iterator[np.ndarray]:
    """Codes of many texts in a row, with breaks around; a text is never cut."""
    pad = np.zeros(LONGEST + 1, dtype=np.int64)
    for batch in batches:
        arrays = batch.column("codes")
        values, limits = arrays.values.to_numpy(), arrays.offsets.to_numpy()
        first = 0
        while first < len(limits) - 1:
            last = max(int(np.searchsorted(limits, limits[first] + most, "right")) - 1, first + 1)
            yield np.concatenate((pad[:1], values[limits[first]:limits[last]], pad))
            first = last


def _groups(codes: np.ndarray, at: np.ndarray, hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, group starts in it, phrases of the groups) of the phrases that begin at ``at``.

    Neighbours in order of hash are one group if all their words agree.
    """
    order = np.argsort(hashes)
    rows = codes[at[order][:, None] + np.arange(length)]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    starts = np.flatnonzero(new)
    return order, starts, rows[starts]


class _Held:
    """Groups of one length that a task has found so far: their sums, and extremes of the words around."""

    def __init__(self) -> None:
        self.rows: np.ndarray | None = None
        self.sizes = self.around = np.empty(0)

    def add(self, rows: np.ndarray, sizes: np.ndarray, around: np.ndarray) -> None:
        """``around``: a line each of least and largest words before and after."""
        if self.rows is not None:
            rows = np.concatenate((self.rows, rows))
            sizes = np.concatenate((self.sizes, sizes))
            around = np.concatenate((self.around, around), axis=1)
        hashes = rows[:, 0].view(np.uint64)
        for k in range(1, rows.shape[1]):
            hashes = longer_hash(hashes, np.ascontiguousarray(rows[:, k]))
        order, starts, self.rows = _groups(rows.reshape(-1), np.arange(len(rows)) * rows.shape[1], hashes, rows.shape[1])
        self.sizes = np.add.reduceat(sizes[order], starts)
        self.around = np.stack([(np.minimum, np.maximum)[i % 2].reduceat(line[order], starts) for i, line in enumerate(around)])


def _lists(rows: np.ndarray):
    import pyarrow as pa

    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, rows.shape[1], dtype=np.int32), rows.reshape(-1))


def grow(codes: DataFrame, length: int, heads: np.ndarray, prefixes: np.ndarray | None, min_count: int) -> DataFrame:
    """(p, a) of the phrases of ``length`` words that occur ``min_count`` times.

    Only first words in ``heads`` and, above two words, phrases whose words but the
    last are in ``prefixes`` are looked at, and by chance others.
    """
    import pyarrow as pa

    shared = codes.sparkSession.sparkContext.broadcast((heads, prefixes))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_words, before = shared.value
        for v in _flat(batches):
            at = np.flatnonzero((v != 0) & has(first_words, v))
            hashes = v[at].view(np.uint64)
            for k in range(1, length):
                if k > 1 and k == length - 1:
                    on = has(before, hashes)
                    at, hashes = at[on], hashes[on]
                on = v[at + k] != 0
                at, hashes = at[on], hashes[on]
                hashes = longer_hash(hashes, v[at + k])
            if len(at):
                _, starts, rows = _groups(v, at, hashes, length)
                sizes = np.diff(starts, append=len(at))
                yield pa.RecordBatch.from_arrays([_lists(rows), pa.array(sizes.astype(np.int64))], ["p", "a"])

    found = codes.mapInArrow(take, "p array<bigint>, a bigint")
    return found.groupBy("p").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)


def survey(codes: DataFrame, wanted: DataFrame, longest: int, bits: int) -> DataFrame:
    """(p, a, before_low, before_high, after_low, after_high) of the phrases ``p`` of ``wanted``.

    The last four are the least and largest codes of the words around (0 where there is none).
    """
    import pyarrow as pa

    heads = bitmap_of(wanted.select(F.slice("p", 1, 1).alias("p")).distinct(), bits)
    shared = codes.sparkSession.sparkContext.broadcast((heads, bitmap_of(wanted, bits)))
    names = ["before_low", "before_high", "after_low", "after_high"]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_words, phrases = shared.value
        held = [_Held() for _ in range(longest)]

        def tell(k: int) -> pa.RecordBatch:
            found, held[k] = held[k], _Held()
            return pa.RecordBatch.from_arrays([_lists(found.rows), pa.array(found.sizes), *map(pa.array, found.around)], ["p", "a", *names])

        for v in _flat(batches):
            at = np.flatnonzero((v != 0) & has(first_words, v))
            hashes = v[at].view(np.uint64)
            for k in range(1, longest):
                on = v[at + k] != 0
                at, hashes = at[on], hashes[on]
                hashes = longer_hash(hashes, v[at + k])
                on = np.flatnonzero(has(phrases, hashes))
                if not len(on):
                    continue
                order, starts, rows = _groups(v, at[on], hashes[on], k + 1)
                place = at[on][order]
                sizes = np.diff(starts, append=len(place)).astype(np.int64)
                around = [f.reduceat(v[place + d], starts) for d in (-1, k + 1) for f in (np.minimum, np.maximum)]
                held[k].add(rows, sizes, np.stack(around))
                if len(held[k].sizes) > HELD_GROUPS:
                    yield tell(k)
        yield from (tell(k) for k in range(longest) if held[k].rows is not None)

    found = codes.mapInArrow(take, "p array<bigint>, a bigint, " + ", ".join(f"{n} bigint" for n in names))
    ends = [(F.min if n.endswith("low") else F.max)(n).alias(n) for n in names]
    return found.groupBy("p").agg(F.sum("a").alias("a"), *ends).join(wanted.select("p").distinct(), "p", "left_semi")


# --- scores ------------------------------------------------------------------------

# Exact: the products pass 64 bits.
_SCORE = "(cast(1000 AS DECIMAL(4,0)) * cast(a AS DECIMAL(17,0)) * cast(n AS DECIMAL(17,0))) div (cast(l AS DECIMAL(18,0)) * cast(r AS DECIMAL(18,0)))"


def _named(counts: DataFrame, phrase: str, value: str) -> DataFrame:
    return counts.select(F.col("p").alias(phrase), F.col("a").alias(value))


def scored(candidates: DataFrame, counts: DataFrame, surveyed: DataFrame, longest: int) -> DataFrame:
    """(lang, p, a, l, r, n, score) of the candidates that no longer phrase takes with it.

    A longer phrase that occurs as often exists if all of a phrase's occurrences have the same word before or
    after them.
    """
    cuts = candidates.select("lang", "n", "p", "a", F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
    parts = cuts.select("*", F.expr("slice(p, 1, k)").alias("left"), F.expr("slice(p, k + 1, size(p))").alias("right"))
    valued = parts.join(_named(counts, "left", "l"), "left").join(_named(counts, "right", "r"), "right").withColumn("score", F.expr(_SCORE))
    best = valued.groupBy("lang", "n", "p", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    same_before = (F.col("before_low") == F.col("before_high")) & (F.col("before_low") != 0)
    same_after = (F.col("after_low") == F.col("after_high")) & (F.col("after_low") != 0)
    stand = surveyed.where((F.size("p") == longest) | ~(same_before | same_after)).select("p")
    return best.join(stand, "p", "left_semi").select("lang", "p", "a", "cut.l", "cut.r", "n", "cut.score")


def floors(survivors: DataFrame, top: int) -> DataFrame:
    """(lang, floor): the score of each language's ``top``-th survivor, where there is one."""
    window = Window.partitionBy("lang").orderBy(F.desc("score"))
    ranked = survivors.select("lang", "score").withColumn("place", F.row_number().over(window)).where(F.col("place") <= top)
    return ranked.where(F.col("place") == top).select("lang", F.col("score").alias("floor"))


def mine_phrases(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, longest: int = LONGEST, shares: Sequence[int] = SHARES,
    bits: int = BITMAP_BITS, lang_col: str = "lang", text_col: str = "text",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best ``top`` phrases of 2 to ``longest`` words.

    A text is divided at ``[.,;:!?]`` and line ends into pieces, these at blanks and tabs into words,
    A-Z small. Phrases lie within a piece and occur ``min_count`` times in their language, overlaps counted; one
    inside a longer one that occurs as often is left out. Equal scores stand by count, then by the phrase's bytes; of
    equally weak cuts the first is shown. A null language is ``und``, a null or empty text has no
    words, and so has an empty table; repeated rows count as often as they come; other columns are not
    looked at. ``bits`` (of a bitmap; three at a time in a task) may be raised for very many phrases.
    """
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"phrases have 2 to {LONGEST} words")
    spark = docs.sparkSession
    texts = spread(docs.select(F.coalesce(lang_col, F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")))
    words = materialise(word_counts(texts), "words")
    totals = materialise(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    coded, salt = coded_words(words)
    frequent = materialise(coded.where(F.col("f") >= min_count).select("lang", "word", "f", "code", F.array("code").alias("p")), "frequent")
    path = scratch_path(spark, "codes")
    code_texts(texts, salt, bitmap_of(frequent, bits)).write.option("compression", "zstd").parquet(path)
    codes = spark.read.schema("codes array<bigint>").parquet(path)

    heads_of = frequent.join(totals, "lang")
    bound = F.expr("(cast(1000 AS DECIMAL(4,0)) * cast(n AS DECIMAL(17,0))) div f")
    survivors = spark.createDataFrame([], "lang string, p array<bigint>, a bigint, l bigint, r bigint, n bigint, score bigint")
    floor = spark.createDataFrame([], "lang string, floor bigint")
    done = None
    for share in shares:
        # The frontier: first words not expanded yet, of languages whose last wanted score they may reach.
        window = F.col("f") * share <= F.col("n") if done is None else (F.col("f") * share <= F.col("n")) & (F.col("f") * done > F.col("n"))
        done = share
        heads = heads_of.where(window).join(floor, "lang", "left").where(F.col("floor").isNull() | (bound >= F.col("floor")))
        heads = materialise(heads.select("lang", "n", "floor", "code", "p", "f"), "heads")
        if heads.isEmpty():
            continue
        first_words, prefixes, levels = bitmap_of(heads, bits), None, []
        for length in range(2, longest + 1):
            # By chance others are counted too; they come again, or never.
            own = heads.select(F.col("code").alias("head"))
            level = grow(codes, length, first_words, prefixes, min_count).join(own, F.get("p", F.lit(0)) == F.col("head"), "left_semi")
            levels.append(materialise(level, "level"))
            if levels[-1].isEmpty():
                break
            prefixes = bitmap_of(levels[-1], bits)
        grown = levels[0]
        for level in levels[1:]:
            grown = grown.union(level)
        single = frequent.select("p", F.col("f").alias("a"))
        # The cut before the last word needs no other counts: what it leaves below the floor is out.
        start = heads.select(F.col("code").alias("head"), "lang", "n", "floor")
        known = grown.union(single)
        likely = (
            grown.join(start, F.get("p", F.lit(0)) == F.col("head"))
            .withColumns({"prefix": F.expr("slice(p, 1, size(p) - 1)"), "last": F.expr("slice(p, size(p), 1)")})
            .join(_named(known, "prefix", "l"), "prefix").join(_named(single, "last", "r"), "last")
            .withColumn("bound", F.expr(_SCORE)).where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
            .select("lang", "n", "p", "a", "bound")
        )
        # Best bounds first: what they settle leaves few of the others to look at.
        likely = materialise(likely, "candidates")
        cuts = floors(likely.select("lang", F.col("bound").alias("score")), 2 * top).withColumnRenamed("floor", "cut")
        ranked = likely.join(cuts, "lang", "left").withColumn("first", F.col("cut").isNull() | (F.col("bound") >= F.col("cut")))
        for part in ("first", "NOT first"):
            open_ones = ranked.where(part).join(floor, "lang", "left").where(F.col("floor").isNull() | (F.col("bound") >= F.col("floor")))
            candidates = materialise(open_ones.select("lang", "n", "p", "a"), "batch")
            if candidates.isEmpty():
                continue
            tails = F.expr("transform(sequence(0, size(p) - 2), k -> slice(p, k + 1, size(p)))")
            wanted = materialise(candidates.select(F.explode(tails).alias("p")).distinct(), "wanted")
            surveyed = materialise(survey(codes, wanted, longest, bits), "surveyed")
            counts = known.union(surveyed.select("p", "a")).distinct()
            survivors = materialise(survivors.union(scored(candidates, counts, surveyed, longest)), "survivors")
            floor = materialise(floors(survivors, top), "floors")

    kept = survivors.join(floor, "lang", "left").where(F.col("floor").isNull() | (F.col("score") >= F.col("floor"))).drop("floor")
    kept = kept.withColumn("row", F.struct("p", "a", "l", "r", "n", "score"))
    spelt = (
        kept.select("lang", "row", F.posexplode("p").alias("at", "code")).join(frequent.select("code", "word"), "code")
        .groupBy("lang", "row").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select("lang", F.array_join("words.word", " ").alias("phrase"), "row.*")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelt.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of each language of all documents."""
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0b\x0c\r]')) AS piece
  FROM documents
), w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') AS w FROM pieces
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS p
  FROM w, (SELECT unnest(range(1, 6)) AS m)
), f AS MATERIALIZED (
  SELECT lang, m, p, count(*) AS f FROM grams GROUP BY ALL
), n AS MATERIALIZED (
  SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang
), common AS MATERIALIZED (
  SELECT * FROM f WHERE f >= 100
), cuts AS MATERIALIZED (
  SELECT lang, m, p, f AS a, k, array_to_string(string_split(p, ' ')[1:k], ' ') AS x, array_to_string(string_split(p, ' ')[k + 1:m], ' ') AS y
  FROM common, (SELECT unnest(range(1, 5)) AS k) WHERE k < m
), scores AS (
  SELECT cuts.*, x.f AS l, y.f AS r, n, 1000::HUGEINT * a * n // (x.f::HUGEINT * y.f) AS score
  FROM cuts JOIN n ON n.lang = cuts.lang
  JOIN common x ON x.lang = cuts.lang AND x.p = cuts.x
  JOIN common y ON y.lang = cuts.lang AND y.p = cuts.y
), best AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inside AS (
  SELECT lang, a, x AS p FROM cuts WHERE k = m - 1 UNION SELECT lang, a, y FROM cuts WHERE k = 1
)
SELECT best.lang, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, best.a DESC, encode(best.p)) AS rank, best.p AS phrase, best.a, l, r,
  n::BIGINT AS n, score::BIGINT AS score
FROM best ANTI JOIN inside ON best.lang = inside.lang AND best.p = inside.p AND best.a = inside.a
QUALIFY rank <= 2000
"""
