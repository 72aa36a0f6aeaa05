"""Token ids in a compact file: canonical length-limited Huffman codes in blocks.

Texts become ids by a public tokenizer. One code is built from the counts of all
ids. Documents are ordered by id over range partitions; a part of the file holds
the codes of consecutive documents as one bit stream, cut into blocks of
``BLOCK`` ids, and the bit offset of every block (its checkpoint). Any block can
be read on its own, so many are decoded at once, one table look-up an id.

Layout: ``code`` (one row: length of each id's code; canonical, so nothing else
is needed) and ``parts`` (Parquet: part number, rank in it, documents' ids and id counts,
checkpoints and bits). Streams are tables that only Spark reads and writes.
"""

from __future__ import annotations

import heapq
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinmaster.session import materialise, scratch_path

END_ID = 2
BLOCK = 256
MAX_BITS = 16
TOKENIZER = "byte_bpe_50k.json"
# Documents whose ids are coded as one row of a part: about so many ids.
ROW_IDS = 1 << 19
# Ids whose codes are laid into the stream at once.
STEP_IDS = 1 << 15
# Token ids of this many distinct pieces of text, and of as many older ones, are remembered by a Python worker, if a
# piece has at most that many characters: about 90 MB in all, 150 bytes a piece.
REMEMBERED = 300_000
LONGEST_REMEMBERED = 64
# Rows a worker encodes together, and the bytes of text from which it takes fewer; a longer text goes in parts.
ROWS_AT_ONCE = 400
BYTES_AT_ONCE = 1 << 22


class _Known(dict):
    """Ids by piece; a piece that is missing is noted and stands for itself until it is filled in.

    When it is full it becomes the older half and begins anew; pieces seen again are taken from there.
    """

    def __init__(self) -> None:
        super().__init__()
        self.missing: set[str] = set()
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes | str:
        ids = self.older.get(piece)
        if ids is None:
            self.missing.add(piece)
            return piece
        self[piece] = ids
        return ids

    def turn(self) -> None:
        self.older = dict(self)
        self.clear()


class PieceEncoder:
    """Ids of whole texts from a tokenizer of the ``tokenizers`` library.

    A byte-level tokenizer divides a text before it merges, and always between a
    character and a blank that follows. Texts are cut there, each distinct piece is
    encoded by the library once, and the pieces' ids are put together: the same ids
    as for the whole text. Tokenizers that divide otherwise get whole texts.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        divides = parts.get("pre_tokenizer") or {}
        self.by_piece = (
            divides.get("type") == "ByteLevel" and divides.get("use_regex", True) and not divides.get("add_prefix_space")
            and not parts.get("normalizer") and not any(t.get("lstrip") or t.get("rstrip") for t in parts.get("added_tokens", []))
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        top = max(vocabulary.values(), default=0)
        self.dtype = id_type(top)
        added = {t["id"]: len(t["content"].encode()) for t in parts.get("added_tokens", [])}
        # Words and marks are divided alike by every such tokenizer, unless it has added tokens of letters.
        self.by_word = self.by_piece and not any(t["content"].strip().isalpha() for t in parts.get("added_tokens", []))
        # A byte-level token has one character for each byte it stands for.
        self.n_bytes = np.zeros(top + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = added.get(i, len(token))
        self.known = _Known()
        self.model = self.tokenizer.model

    def _encode(self, texts: Sequence[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]

    def _part(self, part: str) -> bytes:
        """Ids of what the tokenizer does not divide, straight from its model."""
        ids = self.known.get(part)
        if ids is None:
            name = part.replace(" ", _BYTE_NAMES[32]) if part.isascii() and part[-1] != "\n" else "".join([_BYTE_NAMES[b] for b in part.encode()])
            ids = self.known[part] = array(self.dtype.char, [t.id for t in self.model.tokenize(name)]).tobytes()
        return ids

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces that begin with a blank, many in one text, and tell their ids apart by bytes."""
        step = 4096
        for first in range(0, len(pieces), step):
            some = pieces[first:first + step]
            text = "".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            ends = np.cumsum([len(p.encode("utf-8", "replace")) for p in some])
            reached = np.cumsum(self.n_bytes[ids])
            last = np.searchsorted(reached, ends)
            if len(ids) and (last[-1] >= len(ids) or not np.array_equal(reached[last], ends)):
                self.known.update(zip(some, self._encode(some), strict=True))
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            stops = ((last + 1) * width).tolist()
            self.known.update(zip(some, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=True))

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Each text's ids as little-endian unsigned integers of ``dtype``; null counts as empty."""
        if not self.by_piece:
            return self._encode([t or "" for t in texts])
        return [b"".join(self._pieced(list(_parts(t)))) if t and len(t) > BYTES_AT_ONCE else ids
                for t, ids in zip(texts, self._pieced([t if t and len(t) <= BYTES_AT_ONCE else "" for t in texts]), strict=True)]

    def _pieced(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBERED:
            self.known.turn()
        pieces = [_pieces(t) for t in texts]
        found = list(map(self.known.__getitem__, chain.from_iterable(pieces)))
        new = list(self.known.missing)
        self.known.missing.clear()
        # A blank and a word can be encoded beside others; what begins otherwise is encoded by itself.
        rest = []
        for piece in new:
            parts = _WORDS.fullmatch(piece) if self.by_word else None
            if not parts:
                rest.append(piece)
            elif parts.end(1) == len(piece):
                self._part(piece)
            else:
                self.known[piece] = b"".join([self._part(p) for p in parts.groups() if p])
        plain = [p for p in rest if len(p) > 1 and p[0] == " " and not p[1].isspace() and not p[-1].isspace()]
        odd = list(set(rest).difference(plain))
        self._learn(plain)
        self.known.update(zip(odd, self._encode(odd), strict=True))
        known, ends = self.known, list(accumulate(map(len, pieces)))
        found = [ids if ids.__class__ is bytes else known[ids] for ids in found]
        for piece in new:
            if len(piece) > LONGEST_REMEMBERED:
                del known[piece]
        return [b"".join(found[first:end]) for first, end in zip([0, *ends], ends, strict=False)]


def id_type(top: int) -> np.dtype:
    return np.dtype("<u2" if top < 1 << 16 else "<u4")


# Letters of the Latin, Greek and Cyrillic scripts; a word of them, marks, and a word with marks on the next line. Byte-level
# tokenizers divide such a piece exactly between these groups.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02af\u0391-\u03a1\u03a3-\u03f5\u0400-\u0481\u048a-\u052f"
_WORDS = re.compile(rf"( ?[{_LETTERS}]+)([.,;:!?]*)(?:(\n)([{_LETTERS}]+)([.,;:!?]*))?")
# The character by which a byte-level vocabulary names a byte: itself where that can be seen, else the next from 256 on.
_HIDDEN = [*range(0x21), *range(0x7F, 0xA1), 0xAD]
_BYTE_NAMES = [chr(256 + _HIDDEN.index(b)) if b in _HIDDEN else chr(b) for b in range(256)]
# A blank before other white space or the end.
_LOOSE = re.compile(r" (?:\s|\Z)")
_BETWEEN = re.compile(r"\S(?= \S)")


def _pieces(text: str) -> list[str]:
    """The text cut before blanks that follow something else than white space."""
    if not text:
        return []
    first, *rest = text.replace(" ", "\0 ").split("\0") if "\0" not in text else _cut(text)
    out = [first, *rest] if first else rest
    return _joined(out) if _LOOSE.search(text) else out


def _parts(text: str) -> Iterator[str]:
    """A long text cut where pieces begin: before a blank between what is no white space."""
    begin = 0
    for at in _BETWEEN.finditer(text):
        if at.end() - begin > BYTES_AT_ONCE // 4:
            yield text[begin:at.end()]
            begin = at.end()
    yield text[begin:]


def _cut(text: str) -> list[str]:
    first, *rest = text.split(" ")
    return [first, *(" " + word for word in rest)]


def _joined(pieces: list[str]) -> list[str]:
    """A blank between other white space stays with what is before it."""
    out: list[str] = []
    for piece in pieces:
        if out and piece[0] == " " and (piece == " " or piece[1].isspace()) and out[-1][-1].isspace():
            out[-1] += piece
        else:
            out.append(piece)
    return out


def code_lengths(counts: dict[int, int], max_bits: int = MAX_BITS) -> dict[int, int]:
    """Length of each id's code: Huffman's, or the best within ``max_bits`` (package-merge)."""
    ids = sorted((i for i, n in counts.items() if n > 0), key=lambda i: (counts[i], i))
    if len(ids) <= 1:
        return dict.fromkeys(ids, 1)
    if len(ids) > 1 << max_bits:
        raise ValueError(f"{len(ids)} ids need codes of more than {max_bits} bits")
    heap = [(counts[i], k) for k, i in enumerate(ids)]
    parent, fresh = {}, len(ids)
    heapq.heapify(heap)
    while len(heap) > 1:
        (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
        parent[x] = parent[y] = fresh
        heapq.heappush(heap, (a + b, fresh))
        fresh += 1
    depth = {fresh - 1: 0}
    for node in range(fresh - 2, -1, -1):
        depth[node] = depth[parent[node]] + 1
    if max(depth[k] for k in range(len(ids))) <= max_bits:
        return {i: depth[k] for k, i in enumerate(ids)}
    return _package_merge(ids, np.array([counts[i] for i in ids], dtype=np.float64), max_bits)


def _package_merge(ids: list[int], weights: np.ndarray, max_bits: int) -> dict[int, int]:
    """Larmore and Hirschberg: ``max_bits`` rounds of pairing; an id's length is how often it is taken."""
    n = len(ids)
    rounds, packages = [], np.empty(0)
    for _ in range(max_bits):
        merged = np.concatenate((weights, packages))
        order = np.argsort(merged, kind="stable")
        rounds.append(order)
        values = merged[order]
        packages = values[0:len(values) // 2 * 2:2] + values[1::2][:len(values) // 2]
    lengths = np.zeros(n, dtype=np.int64)
    take = 2 * (n - 1)
    for order in reversed(rounds):
        chosen = order[:take]
        leaves = chosen[chosen < n]
        lengths[leaves] += 1
        take = 2 * (len(chosen) - len(leaves))
    return {i: int(b) for i, b in zip(ids, lengths, strict=True)}


class Code:
    """Canonical codes: by length, then by id; the decoding table has an entry for every 16 bits."""

    def __init__(self, lengths: dict[int, int]):
        ordered = sorted((b, i) for i, b in lengths.items())
        self.symbols = np.array([i for _, i in ordered], dtype=np.uint32)
        bits = np.array([b for b, _ in ordered], dtype=np.int64)
        size = int(self.symbols.max()) + 1 if len(ordered) else 1
        self.bits = np.zeros(size, dtype=np.int64)
        self.codes = np.zeros(size, dtype=np.uint64)
        self.width = int(bits.max()) if len(bits) else 1
        spans = 1 << (self.width - bits)
        firsts = np.cumsum(spans) - spans
        self.bits[self.symbols] = bits
        self.codes[self.symbols] = (firsts >> (self.width - bits)).astype(np.uint64)
        self.table_symbol = np.zeros(1 << self.width, dtype=np.uint32)
        self.table_bits = np.ones(1 << self.width, dtype=np.int64)
        filled = int(spans.sum())
        self.table_symbol[:filled] = np.repeat(self.symbols, spans)
        self.table_bits[:filled] = np.repeat(bits, spans)

    def encode(self, ids: np.ndarray, block: int = BLOCK) -> tuple[bytes, np.ndarray]:
        """(bit stream, bit offset at which each block of ids begins)."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        total = int(ends[-1]) if len(ids) else 0
        words = np.zeros(total // 32 + 3, dtype=np.uint64)
        # A code begins in one 32-bit word and may reach into the next. Codes
        # of one word have different bits, so their sum is their union; every
        # word has one, as codes are no longer than 16 bits. Some ids at a time: their arrays stay in the cache.
        for i in range(0, len(ids), STEP_IDS):
            some = slice(i, i + STEP_IDS)
            shift = (64 - (starts[some] & 31) - bits[some]).astype(np.uint64)
            at = starts[some] >> 5
            placed = self.codes[ids[some]] << shift
            first = np.flatnonzero(np.diff(at, prepend=-1))
            sums = np.add.reduceat(placed, first)
            words[at[first]] |= sums >> np.uint64(32)
            words[at[first] + 1] |= sums & np.uint64(0xFFFFFFFF)
        data = words.astype(">u4").tobytes()[: (total + 7) // 8]
        return data, starts[::block].astype(np.int64)

    def decode(self, data: bytes, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
        """The ``n`` ids of a stream; all blocks advance together, one id a step."""
        out = np.zeros((len(offsets), block), dtype=np.uint32)
        buffer = np.frombuffer(data + b"\0" * 8, dtype=np.uint8).astype(np.uint32)
        # 32 bits from each byte on, so that a look-up is one access.
        window = (buffer[:-3] << 24) | (buffer[1:-2] << 16) | (buffer[2:-1] << 8) | buffer[3:]
        at = offsets.astype(np.int64).copy()
        last = len(window) - 1
        for step in range(min(block, n)):
            left = 32 - self.width - (at & 7)
            peek = (window[np.minimum(at >> 3, last)] >> left.astype(np.uint32)) & np.uint32((1 << self.width) - 1)
            out[:, step] = self.table_symbol[peek]
            at += self.table_bits[peek]
        return out.reshape(-1)[:n]


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder_for(path: str) -> PieceEncoder:
    """One encoder per Python worker, with what it remembers."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def tokenise(docs: DataFrame, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, n_tokens): ids of each whole text and ``end_id``, unsigned 32-bit integers under zstandard."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(path)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        wide = encoder.dtype != np.dtype("<u2")
        for batch in batches:
            names, texts = batch.column(id_col), batch.column(text_col)
            # Some hundred rows at a time, so that a task never holds the ids of all.
            for first, n in _groups(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                ids = [x + end for x in encoder.encode(texts.slice(first, n).to_pylist())]
                sizes = [len(x) // (4 if wide else 2) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [names.slice(first, n), pa.array([squeeze(x, wide) for x in ids], pa.binary()), pa.array(sizes, pa.int64())],
                    ["doc_id", "ids", "n_tokens"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(encode, f"doc_id {kind}, ids binary, n_tokens bigint")


def _groups(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """(first row, number of rows): consecutive rows of at most ``BYTES_AT_ONCE``, or one row."""
    first = held = 0
    for i, size in enumerate(sizes):
        if i > first and (i - first == ROWS_AT_ONCE or held + size > BYTES_AT_ONCE):
            yield first, i - first
            first, held = i, 0
        held += size
    if len(sizes) > first:
        yield first, len(sizes) - first


def squeeze(ids: bytes, wide: bool) -> bytes:
    """Ids for their way through shuffles: width mark, then zstandard."""
    return bytes([4 if wide else 2]) + zstandard.ZstdCompressor(level=1).compress(ids)


def unsqueeze(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=f"<u{data[0]}")


def vocabulary_counts(documents: Iterable[np.ndarray]) -> np.ndarray:
    """How often each id from 0 on occurs; many documents at once, as every count is as long as the vocabulary."""
    total = np.zeros(0, dtype=np.int64)

    def with_counts(some: list[np.ndarray]) -> np.ndarray:
        seen = np.bincount(np.concatenate(some))
        longest = max(len(seen), len(total))
        return np.pad(total, (0, longest - len(total))) + np.pad(seen, (0, longest - len(seen)))

    some, held = [], 0
    for ids in documents:
        some.append(ids)
        held += len(ids)
        if held >= ROW_IDS or len(some) >= ROW_IDS:
            total, some, held = with_counts(some), [], 0
    return with_counts(some) if some else total


def id_counts(tokens: DataFrame) -> dict[int, int]:
    """How often each id occurs; one row per id comes to the driver, at most the vocabulary."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = vocabulary_counts(unsqueeze(ids.as_py()) for batch in batches for ids in batch.column("ids"))
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int64()), pa.array(total[there], pa.int64())], ["id", "n"])

    rows = tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r["id"]: r["n"] for r in rows}


def write_ids(tokens: DataFrame, path: str, max_bits: int = MAX_BITS, block: int = BLOCK) -> None:
    """Write a token file at ``path`` from rows with ``doc_id``, ``ids`` and ``n_tokens``.

    Documents are stored by ascending ``doc_id``, null first, those with equal
    ids by their content. ``tokens`` is read several times: pass a written table.
    """
    import pyarrow as pa

    spark = tokens.sparkSession
    lengths = code_lengths(id_counts(tokens), max_bits)
    code_rows = [(i, b) for i, b in sorted(lengths.items())]
    spark.createDataFrame(code_rows, "id bigint, bits int").coalesce(1).write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths)
    kind = tokens.schema["doc_id"].dataType.simpleString()
    arrow_kind = pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, rank = Code(shared.value), 0
        names: list = []
        parts: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            data, offsets = code.encode(ids, block)
            values = [
                [rank], [names], [[len(p) for p in parts]], [offsets.tolist()], [data], [len(ids)],
            ]
            types = [pa.int64(), pa.list_(arrow_kind), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)],
                                              ["rank", "doc_ids", "n_tokens", "checkpoints", "bits", "n"])

        for batch in batches:
            for name, ids in zip(batch.column("doc_id"), batch.column("ids"), strict=True):
                names.append(name.as_py())
                parts.append(unsqueeze(ids.as_py()))
                size += len(parts[-1])
                if size >= ROW_IDS:
                    yield row()
                    names, parts, size, rank = [], [], 0, rank + 1
        if parts:
            yield row()

    schema = f"rank bigint, doc_ids array<{kind}>, n_tokens array<bigint>, checkpoints array<bigint>, bits binary, n bigint"
    ordered = tokens.select("doc_id", "ids", F.xxhash64("ids").alias("h")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    ordered.mapInArrow(pack, schema).withColumn("part", F.spark_partition_id()).write.parquet(f"{path}/parts")


def read_ids(spark: SparkSession, path: str, block: int = BLOCK, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids, ids_crc32) of a token file, decoded from its blocks.

    ``ids`` are little-endian unsigned 32-bit integers (null unless ``with_ids``).
    ``start`` counts the ids of all documents before. Every row of a part is
    decoded by itself; the running sum goes over one number a row of the file.
    """
    import pyarrow as pa

    lengths = {r["id"]: r["bits"] for r in spark.read.parquet(f"{path}/code").collect()}
    shared = spark.sparkContext.broadcast(lengths)
    parts = spark.read.parquet(f"{path}/parts")
    # Sums over parts (as many as the file had range partitions), then inside each.
    sizes = parts.groupBy("part").agg(F.sum("n").alias("part_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(F.col("part").alias("p"), F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("part_begin"))
    inside = Window.partitionBy("part").orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    begins = parts.select("part", "rank", "n").withColumn("begin", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    begins = begins.join(first, F.col("part") == F.col("p")).select(
        F.col("part").alias("p"), F.col("rank").alias("r"), (F.col("begin") + F.col("part_begin")).alias("begin")
    )
    rows = parts.join(begins, (F.col("part") == F.col("p")) & (F.col("rank") == F.col("r")))
    kind = parts.schema["doc_ids"].dataType.elementType.simpleString()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(shared.value)
        for batch in batches:
            for k in range(batch.num_rows):
                get = lambda c, k=k: batch.column(c)[k]
                sizes = get("n_tokens").values.to_numpy()
                ids = code.decode(get("bits").as_py(), get("checkpoints").values.to_numpy(), get("n").as_py(), block).astype("<u4")
                ends = np.cumsum(sizes)
                raw = ids.tobytes()
                texts = [raw[4 * (e - s):4 * e] for e, s in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    get("doc_ids").values, pa.array(get("begin").as_py() + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array(texts if with_ids else [None] * len(texts), pa.binary()), pa.array([zlib.crc32(t) for t in texts], pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids", "ids_crc32"])

    return rows.select("doc_ids", "n_tokens", "checkpoints", "bits", "begin", "n").mapInArrow(
        unpack, f"doc_id {kind}, start bigint, n_tokens bigint, ids binary, ids_crc32 bigint"
    )


def token_file(docs: DataFrame, tokenizer: str, path: str | None = None) -> str:
    """Encode the texts of ``docs`` into a token file and return its path.

    Nothing is lost of null or empty texts: they hold the end id alone. Without
    documents the file has none. Columns other than ``doc_id`` and ``text`` are
    not stored. Rows with equal ids are documents each.
    """
    path = path or scratch_path(docs.sparkSession, "token_file")
    write_ids(materialise(tokenise(docs, tokenizer), "tokens"), path)
    return path


def encoded(docs: DataFrame) -> DataFrame:
    """What the token file of ``docs`` holds, read back from it."""
    import public_tokenizers

    path = token_file(docs, public_tokenizers.path(TOKENIZER))
    return read_ids(docs.sparkSession, path, with_ids=False).drop("ids")


def op1_huffman(spark, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, from a file written and read back."""
    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
