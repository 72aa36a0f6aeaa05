"""Language identification by compression with one zstandard dictionary per language.

A dictionary is raw text of a language. A text belongs to the language whose
dictionary makes it smallest; where the two smallest are nearly as large the text
is rejected. Texts are compressed whole, in pieces: were a long text compressed in
one go, its own beginning would soon help more than any dictionary.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bounds of the sample from which the dictionaries are made: rows per language, characters of each.
SAMPLE_ROWS = 32
SAMPLE_CHARS = 600
PIECE_BYTES = 2048
LEVEL = 5
# Texts whose second best language is nearer than this share of the size are rejected.
MIN_MARGIN = 0.002
SHARPNESS = 40.0
UNKNOWN = "und"

# Letters are all that is compared: A-Z become small, every other ASCII byte a blank.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def learnable(doc_id: Column) -> Column:
    """Rows that may be learnt from: crc32 of the id as text, modulo 4, is not 2."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) != 2


def dictionaries(labelled: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> dict[str, bytes]:
    """One raw dictionary per value of ``lang`` from rows with ``text`` and ``lang``.

    At most ``rows`` rows per language come to the driver, the first by the hash of
    their text (equal texts count once), and of each at most ``chars`` characters
    from a place that the hash gives. Null languages and texts without words are
    not learnt from. The first rows of each language are found before the shuffle.
    """
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    h = F.xxhash64("text")
    start = F.pmod(h, F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    piece = F.substring(F.col("text"), start.cast("int"), F.lit(chars))
    hashed = usable.select("lang", h.alias("h"), piece.alias("piece")).dropDuplicates(["lang", "h"])
    hashed.createOrReplaceTempView("__language_sample")
    try:
        sample = labelled.sparkSession.sql(
            "SELECT lang, h, piece FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY h) AS n "
            f"FROM __language_sample) WHERE n <= {int(rows)}"
        ).collect()
    finally:
        labelled.sparkSession.catalog.dropTempView("__language_sample")
    texts: dict[str, list[bytes]] = {}
    for row in sorted(sample, key=lambda r: (r["lang"], r["h"])):
        texts.setdefault(row["lang"], []).append(_plain((row["piece"] or "").lower().encode("utf-8", "replace")))
    return {lang: b" ".join(parts) for lang, parts in texts.items()}


def _plain(data: bytes) -> bytes:
    return b" ".join(data.translate(_LETTERS).split())


class Classifier:
    """Compressors for a set of dictionaries; built once per task."""

    def __init__(self, texts: dict[str, bytes], level: int = LEVEL):
        self.langs = sorted(texts)
        self.compress = []
        for lang in self.langs:
            data = zstandard.ZstdCompressionDict(texts[lang] or b" ", dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            data.precompute_compress(level=level)
            self.compress.append(zstandard.ZstdCompressor(
                dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False,
            ).compress)

    def sizes(self, data: bytes) -> list[int]:
        """Bytes of the text under each language."""
        pieces = [data[i:i + PIECE_BYTES] for i in range(0, len(data), PIECE_BYTES)]
        return [sum(map(len, map(compress, pieces))) for compress in self.compress]

    def predict(self, data: bytes) -> tuple[str, float, float]:
        """(language, score, margin); the first by name where sizes are equal."""
        sizes = self.sizes(_plain(data))
        best = min(range(len(sizes)), key=sizes.__getitem__)
        least = max(sizes[best], 1)
        score = 1.0 / sum(math.exp(-SHARPNESS * (s - sizes[best]) / least) for s in sizes)
        others = sizes[:best] + sizes[best + 1:]
        margin = (min(others) - sizes[best]) / max(min(others), 1) if others else 1.0
        return self.langs[best], score, margin


def identify(docs: DataFrame, texts: dict[str, bytes], text_col: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score``, ``lang_margin`` and ``lang_rejected``.

    Columns of those names are replaced; all others pass through. Null texts and
    texts without a letter (or nothing learnt) are ``und`` with score 0 and are
    rejected; so are texts whose margin is below ``min_margin``, which keep the
    nearest language as their prediction. Ties go to the first language by name.
    """
    import pyarrow as pa

    added = ("lang_pred", "lang_score", "lang_margin", "lang_rejected")
    docs = docs.drop(*added)
    models = docs.sparkSession.sparkContext.broadcast(texts)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [
        "lang_pred string", "lang_score double", "lang_margin double", "lang_rejected boolean"])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Classifier(models.value) if models.value else None
        for batch in batches:
            found = []
            for text in batch.column(text_col):
                text = text.as_py()
                if model is None or not text or not any(c.isalpha() for c in text):
                    found.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                lang, score, margin = model.predict(text.lower().encode("utf-8", "replace"))
                found.append((lang, score, margin, margin < min_margin))
            columns = [pa.array(x, t) for x, t in zip(
                zip(*found) if found else ([], [], [], []), (pa.string(), pa.float64(), pa.float64(), pa.bool_()), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, *added])

    return docs.mapInArrow(classify, schema)


def keep_identified(docs: DataFrame, **options) -> DataFrame:
    """Rows whose language can be told, with the columns of ``docs``; learns from all labelled rows."""
    return identify(docs, dictionaries(docs), **options).where(~F.col("lang_rejected")).select(*docs.columns)


def op4_language(spark, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learnt from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = dictionaries(docs.where(learnable(F.col("doc_id"))).select("text", "lang"))
    found = identify(docs.select("doc_id", "text"), texts)
    return found.select(
        "doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
        F.col("lang_margin").alias("margin"), F.col("lang_rejected").alias("rejected"),
    )
