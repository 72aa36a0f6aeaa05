"""Removing benchmark passages by a generalised suffix automaton over the test items.

Texts are streamed through the automaton word by word; it knows the longest run
of words ending here that also occurs in some item. Runs of at least a window are
hits. Words and word pairs that no item has break every run, so most of a text is
passed over by look-ups over whole arrays and only the runs between are streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinmaster.llm.wordbytes import chunks, separator_table
from kinmaster.session import materialise

WINDOW = 13
MAX_COVERAGE = 0.05
# Words of items in one automaton (about 300 bytes of memory a word). More items
# make more automata, and texts are streamed through each.
SHARD_WORDS = 400_000
# ASCII bytes other than digits and letters divide words; all others belong to them.
SEPARATORS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
TABLE = separator_table(SEPARATORS)


def words_of(data: bytes) -> list[bytes]:
    return data.translate(TABLE).split()


class SuffixAutomaton:
    """Of several word sequences; every state stands for runs of words with the same places."""

    def __init__(self, items: Sequence[tuple[object, Sequence[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            if ids:
                coded.append((name, ids))
        for _, ids in coded:
            last = 0
            for word in ids:
                last = self._extend(last, word)
        self.shortest = min((min(len(ids), window) for _, ids in coded), default=0)
        pairs = {a * len(self.vocabulary) + b for _, ids in coded for a, b in zip(ids, ids[1:], strict=False)}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)
        # Items by the state in which one of their windows ends; windows of one
        # length in one state are the same words.
        self.windows: dict[int, dict[int, set]] = {}
        for name, ids in coded:
            size = min(len(ids), window)
            state, matched = 0, 0
            for word in ids:
                state, matched = self._step(state, matched, word)
                if matched >= size:
                    at = self._shrink(state, size)
                    self.windows.setdefault(at, {}).setdefault(size, set()).add(name)
        self.found = [None] * len(self.link)

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            known = self.next[last][word]
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, word, known)
        current = self._state(self.length[last] + 1, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = current
            last = self.link[last]
        if last < 0:
            self.link[current] = 0
        else:
            known = self.next[last][word]
            same = self.length[known] == self.length[last] + 1
            self.link[current] = known if same else self._clone(last, word, known)
        return current

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.link.append(0)
        self.length.append(length)
        return len(self.link) - 1

    def _clone(self, last: int, word: int, known: int) -> int:
        copy = self._state(self.length[last] + 1, dict(self.next[known]))
        self.link[copy] = self.link[known]
        self.link[known] = copy
        while last >= 0 and self.next[last].get(word) == known:
            self.next[last][word] = copy
            last = self.link[last]
        return copy

    def _step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """The longest run ending with ``word`` that some item has."""
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        to = self.next[state].get(word)
        return (to, matched + 1) if to is not None else (0, 0)

    def _shrink(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a run in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def _ends_here(self, state: int) -> list[tuple[int, frozenset]]:
        """(window length, items) of the windows that end where a run in ``state`` does."""
        if self.found[state] is None:
            found, at = [], state
            while at > 0:
                found += [(size, frozenset(names)) for size, names in self.windows.get(at, {}).items()]
                at = self.link[at]
            self.found[state] = found
        return self.found[state]

    def hits(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set]:
        """([start, end) of merged runs of hit words, names of the items hit)."""
        spans: list[tuple[int, int]] = []
        names: set = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, names
        ids = np.fromiter(map(self.vocabulary.get, words, _MINUS), dtype=np.int64, count=len(words))
        for start, end in self._runs(ids):
            state, matched = 0, 0
            for i, word in enumerate(ids[start:end].tolist(), start):
                state, matched = self._step(state, matched, word)
                if matched < self.shortest:
                    continue
                for size, items in self._ends_here(state):
                    if size > matched:
                        continue
                    names |= items
                    first = i + 1 - size
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return spans, names

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches that may hold a window: known words whose neighbours are pairs of some item."""
        known = np.concatenate(([False], ids >= 0, [False]))
        if self.shortest > 1 and len(self.pairs):
            codes = ids[:-1] * len(self.vocabulary) + ids[1:]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            joined = (self.pairs[at] == codes) & (ids[:-1] >= 0) & (ids[1:] >= 0)
            edges = np.flatnonzero(np.diff(np.concatenate(([False], joined, [False])).astype(np.int8)))
            for start, end in edges.reshape(-1, 2).tolist():
                if end + 1 - start >= self.shortest:
                    yield start, end + 1
            return
        edges = np.flatnonzero(np.diff(known.astype(np.int8)))
        yield from edges.reshape(-1, 2).tolist()


class _Minus:
    """An endless supply of -1 as the default of ``dict.get`` in ``map``."""

    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MINUS = _Minus()


def item_shards(items: DataFrame, id_col: str, text_col: str, limit: int = SHARD_WORDS) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The items in lists of about ``limit`` words, one list in the driver at a time; an item is never divided."""
    shard, size = [], 0
    for row in items.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        words = words_of(row[1].encode("utf-8", "replace"))
        if not words:
            continue
        if shard and size + len(words) > limit:
            yield shard
            shard, size = [], 0
        shard.append((row[0], words))
        size += len(words)
    if shard:
        yield shard


def find_contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text", shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` without its text, with ``n_words``, ``item_ids`` and ``hit_spans``.

    ``hit_spans`` are [start, end) in words of the text, merged and ordered;
    ``item_ids`` the distinct ids (as strings) of items with a window in it,
    sorted. A null text has no words. Items without words are never hit; a null
    item id counts as the item ``null``. Rows with equal ids are judged each by
    itself. All other columns pass through unless they have one of those names.
    """
    import pyarrow as pa

    added = ("n_words", "item_ids", "hit_spans")
    docs = docs.drop(*added, "__row")
    others = [c for c in docs.columns if c != text_col]
    span_type = "array<struct<start:bigint,end:bigint>>"
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != text_col]
    schema = ", ".join([*fields, "n_words bigint", "item_ids array<string>", f"hit_spans {span_type}"])
    arrow_spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def streamed(source: DataFrame, shard: list) -> DataFrame:
        model = docs.sparkSession.sparkContext.broadcast(shard)

        def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            automaton = SuffixAutomaton(model.value, window)
            for batch in batches:
                n_words, item_ids, spans = [], [], []
                for _, parts in chunks(_texts(batch.column(text_col))):
                    for data in parts:
                        words = words_of(data)
                        found, names = automaton.hits(words)
                        n_words.append(len(words))
                        item_ids.append(sorted("null" if n is None else str(n) for n in names))
                        spans.append([{"start": s, "end": e} for s, e in found])
                kept = [batch.column(c) for c in others]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(n_words, pa.int64()), pa.array(item_ids, pa.list_(pa.string())), pa.array(spans, arrow_spans)],
                    [*others, *added],
                )

        return source.mapInArrow(stream, schema)

    shards = item_shards(items, item_id_col, item_text_col, shard_words)
    first = next(shards, [])
    second = next(shards, None)
    if second is None:
        return streamed(docs, first)
    # Several automata: the hits of each are written, then merged by row.
    rows = materialise(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    fields.append("__row bigint")
    others.append("__row")
    schema = ", ".join([*fields, "n_words bigint", "item_ids array<string>", f"hit_spans {span_type}"])
    merged = materialise(streamed(rows, first), "hits")
    shard: list | None = second
    while shard is not None:
        more = streamed(rows.select(text_col, *others), shard).select(
            F.col("__row").alias("__r"), F.col("item_ids").alias("__items"), F.col("hit_spans").alias("__spans")
        ).where("size(__spans) > 0")
        both = merged.join(more, F.col("__row") == F.col("__r"), "left")
        merged = materialise(both.withColumns({
            "item_ids": F.sort_array(F.array_union("item_ids", F.coalesce("__items", F.array().cast("array<string>")))),
            "hit_spans": _merged(F.concat("hit_spans", F.coalesce("__spans", F.array().cast(span_type)))),
        }).drop("__r", "__items", "__spans"), "hits")
        shard = next(shards, None)
    return merged.drop("__row")


def _merged(spans):
    """Overlapping or touching [start, end) spans as one."""
    return F.aggregate(
        F.array_sort(spans), F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
            F.concat(
                F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))),
                F.array(F.struct(
                    F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")
                )),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )


def _texts(column) -> Iterator[str | None]:
    return (value.as_py() for value in column)


def n_hit():
    return F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda acc, s: acc + s["end"] - s["start"])


def clean_text(text: str | None, spans: Sequence[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between those words."""
    if not spans or text is None:
        return text
    data = text.encode("utf-8", "replace")
    step = np.diff(np.frombuffer(b" " + data.translate(TABLE) + b" ", dtype=np.uint8) != 32)
    starts, ends = np.flatnonzero(step)[::2], np.flatnonzero(step)[1::2]
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at:starts[first]])
        at = ends[last - 1]
    return b"".join([*kept, data[at:]]).decode("utf-8", "replace")


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, max_coverage: float = MAX_COVERAGE,
    id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """``docs`` without test passages, with the same columns.

    A document of whose words at least ``max_coverage`` are hit goes; from the
    others the hit words are cut out, and ``n_chars``, if there, is set anew.
    Documents without a hit are unchanged.
    """
    import pandas as pd

    copy = docs.withColumn("__text", F.col(text_col))
    found = find_contamination(copy.withColumnRenamed("__text", "__kept"), items, window, id_col, text_col, **options)
    found = found.withColumn("__hit", n_hit())
    stays = (F.col("__hit") == 0) | (F.col("__hit") < max_coverage * F.col("n_words"))

    def cut_texts(texts, spans):
        cut = [clean_text(t, [(s["start"], s["end"]) for s in p]) for t, p in zip(texts, spans, strict=True)]
        return pd.Series(cut, dtype=object)

    cut = F.pandas_udf(cut_texts, "string", F.PandasUDFType.SCALAR)

    kept = found.where(stays).withColumnRenamed("__kept", text_col)
    clean = kept.where("__hit = 0")
    dirty = kept.where("__hit > 0").withColumn(text_col, cut(text_col, "hit_spans"))
    if "n_chars" in docs.columns:
        dirty = dirty.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return clean.select(*docs.columns).unionByName(dirty.select(*docs.columns))


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, and whether it counts as contaminated."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, items).withColumn("n_hit", n_hit())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def brute_force(texts: Sequence[str | None], items: Sequence[tuple[object, str | None]], window: int = WINDOW) -> list[tuple]:
    """(n_words, n_hit, n_items, items_sha256, contaminated) by comparing every window with every place."""
    out = []
    coded = [(name, words_of((t or "").encode())) for name, t in items]
    for text in texts:
        words = words_of((text or "").encode())
        hit, names = set(), set()
        for name, item in coded:
            size = min(window, len(item))
            for i in range(len(item) - size + 1) if size else ():
                for j in range(len(words) - size + 1):
                    if words[j:j + size] == item[i:i + size]:
                        hit.update(range(j, j + size))
                        names.add(str(name))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((len(words), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return out
