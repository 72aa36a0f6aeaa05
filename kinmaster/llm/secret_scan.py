"""Secrets in text: a random forest tells them from what only looks like one (DataFrame functions and Spark ML).

A pattern proposes runs of token characters. Each is described by its length and
kinds of characters, how usual its character pairs are in the corpus, how much of it
dictionary words cover, where the text comes from and the words around it. A forest
trained on labelled findings gives the share of trees that call it a secret.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster.llm.textspans import places
from kinmaster.operators.joins import join_back
from kinmaster.session import materialise

_T = "A-Za-z0-9_+/~-"
# A run of 16 with a digit, or one of 8 in quotes after an equals sign or colon.
PATTERN = rf"(?<![{_T}])(?:(?=[A-Za-z_+/~-]{{0,256}}[0-9])[{_T}]{{16,}}+={{0,2}}+|(?<=[=:]\x20?[\x22'])[{_T}]{{8,}}+={{0,2}}+)"
BEFORE_CHARS, AFTER_CHARS = 40, 20
# Words of which one near a value speaks for or against a secret; parameters of the features.
KEY_WORDS = ("api", "apikey", "auth", "bearer", "credential", "key", "passwd", "password", "private", "pwd", "secret", "token")
OTHER_WORDS = ("build", "checksum", "commit", "digest", "etag", "example", "hash", "id", "md5", "number", "placeholder", "revision", "sample", "sha1", "sha256", "test", "uuid", "version")
# A word is in the dictionary if it makes up this share of the corpus, and occurs this often.
WORD_SHARE, WORD_COUNT = 2e-6, 3
MIN_WORD, MAX_WORD = 4, 10
# Bound of the labelled findings that are made where none are given: so many documents lend their words.
SAMPLE_ROWS = 1500
TREES, DEPTH, SEED = 40, 8, 11

VALUE_FEATURES = (
    "length", "digits", "uppers", "symbols", "distinct", "changes", "hex", "log_pair", "coverage",
)
CONTEXT_FEATURES = ("assigned", "quoted", "key_word", "other_word", "path_code", "path_test")
FEATURES = VALUE_FEATURES + CONTEXT_FEATURES


def _share(value: Column, pattern: str) -> Column:
    return F.regexp_count(value, F.lit(pattern)) / F.greatest(F.length(value), F.lit(1))


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(doc_id, start, end, value, before, after, path) of every match; null texts have none."""
    text = F.col(text_col)
    some = F.when(text.rlike(PATTERN), places(text, PATTERN))
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    found = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), path.alias("path"), F.explode(some).alias("m"))
    end = F.col("m.start") + F.length("m.match")
    first = F.greatest(F.col("m.start") - BEFORE_CHARS, F.lit(0))
    return found.select(
        "doc_id", F.col("m.start").alias("start"), end.alias("end"), F.col("m.match").alias("value"),
        F.substring("text", first + 1, F.col("m.start") - first).alias("before"),
        F.substring("text", end + 1, F.lit(AFTER_CHARS)).alias("after"), "path",
    )


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts, A-Z and other letters small."""
    words = F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word")
    return docs.select(words).where("word <> ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def corpus_statistics(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs: pair, log_share; dictionary: word) of all texts.

    There are at most as many pairs as characters squared; the dictionary has at
    most ``1 / WORD_SHARE`` words.
    """
    counts = materialise(word_counts(docs, text_col).where(F.col("n") >= WORD_COUNT), "words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    known = counts.where((F.col("n") >= WORD_SHARE * total) & F.length("word").between(MIN_WORD, MAX_WORD)).select("word")
    pairs = counts.select(F.explode(_pairs(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = materialise(pairs, "pairs")
    letters = pairs.agg(F.sum("n")).first()[0] or 1
    return pairs.select("pair", F.log(F.col("n") / letters).alias("log_share")), known


def _pairs(value: Column) -> Column:
    low = F.lower(value)
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(low) - 1, F.lit(1))), lambda i: F.substring(low, i, F.lit(2)))


def value_features(values: DataFrame, pairs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(value and its features) for distinct ``value``."""
    rare = -16.0
    split = values.select("value", F.explode(_pairs(F.col("value"))).alias("pair")).join(pairs, "pair", "left")
    usual = split.groupBy("value").agg(F.avg(F.coalesce("log_share", F.lit(rare))).alias("log_pair"))
    low = F.lower("value")
    # Every piece of a word's length, with the places it would cover.
    at = F.explode(F.sequence(F.lit(1), F.length(low))).alias("at")
    sizes = F.explode(F.sequence(F.lit(MIN_WORD), F.lit(MAX_WORD))).alias("size")
    pieces = values.select("value", at).select("value", "at", sizes).where(F.col("at") + F.col("size") - 1 <= F.length("value"))
    pieces = pieces.withColumn("word", F.substring(low, F.col("at"), F.col("size"))).where(F.col("word").rlike(r"^\p{L}+$"))
    covered = pieces.join(dictionary, "word").groupBy("value", "at").agg(F.max("size").alias("size"))
    places_covered = covered.select("value", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("size") - 1)).alias("p")).distinct()
    coverage = places_covered.groupBy("value").agg(F.count(F.lit(1)).alias("covered"))
    chars = F.array_distinct(F.filter(F.split("value", ""), lambda c: c != ""))
    return (
        values.join(usual, "value").join(coverage, "value", "left")
        .select(
            "value", F.log(F.length("value")).alias("length"), _share(F.col("value"), "[0-9]").alias("digits"),
            _share(F.col("value"), "[A-Z]").alias("uppers"), _share(F.col("value"), "[^A-Za-z0-9]").alias("symbols"),
            (F.size(chars) / F.least(F.length("value"), F.lit(32))).alias("distinct"),
            _share(F.col("value"), "[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])|[a-z](?=[A-Z])").alias("changes"),
            F.col("value").rlike("^(?:[0-9a-f]+|[0-9A-F]+)$").cast("double").alias("hex"), "log_pair",
            (F.coalesce("covered", F.lit(0)) / F.length("value")).alias("coverage"),
        )
    )


def with_features(found: DataFrame, pairs: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Candidates with all features; those of a value are worked out once."""
    def near(words: Sequence[str]) -> Column:
        return F.concat_ws(" ", F.lower("before"), F.lower("after")).rlike(rf"(?<![a-z0-9])(?:{'|'.join(words)})(?![a-z0-9])").cast("double")

    described = value_features(found.select("value").distinct(), pairs, dictionary).withColumnRenamed("value", "__value")
    return join_back(found, described, "value", "__value").withColumns({
        "assigned": F.col("before").rlike(r"[=:]\s?[\x22']?$").cast("double"),
        "quoted": (F.col("before").rlike(r"[\x22']$") & F.col("after").rlike(r"^[\x22']")).cast("double"),
        "key_word": near(KEY_WORDS),
        "other_word": near(OTHER_WORDS),
        "path_code": F.lower("path").rlike(r"\.(?:env|ya?ml|json|py|js|java|rb|go|cfg|conf|ini|sh|tf|properties)\b|config|deploy").cast("double"),
        "path_test": F.lower("path").rlike("test|example|sample|doc|fixture|mock").cast("double"),
    })


def made_findings(docs: DataFrame, rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Labelled findings where none are given: candidates with ``secret`` (0 or 1).

    Values of known nature are set among the words of ``rows`` documents, drawn by
    the hash of their id. Secrets are random values of usual shapes under a key's
    name; the others are random values that are called digests, ids or revisions,
    numbers, dictionary words run together, and stand-ins for a secret.
    """
    h = F.sha2(F.concat(F.lit("finding-"), F.col("id")), 512)
    parts = F.filter(F.split(F.col("text"), r"\s+"), lambda w: w != "")
    drawn = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    drawn = drawn.where(F.size(parts) >= 12).dropDuplicates(["id"]).orderBy(F.xxhash64("id"), "id").limit(rows)
    drawn = drawn.select("id", h.alias("h"), F.slice(parts, F.lit(1), F.lit(200)).alias("w")).withColumn("r", F.conv(F.substring("h", 1, 6), 16, 10).cast("int"))

    def pick(words: Sequence[str], salt: int) -> Column:
        return F.element_at(F.array(*[F.lit(w) for w in words]), (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(len(words))) + 1).cast("int"))

    def drawn_word(k: int) -> Column:
        return F.regexp_replace(F.element_at("w", (F.pmod(F.col("r") + k, F.size("w")) + 1).cast("int")), "[^A-Za-z]", "")

    b64 = F.regexp_replace(F.base64(F.unhex(F.substring("h", 1, 60))), "[=]", "")
    key = pick(("token", "api_key", "secret", "auth token", "password", "private key", "client secret", "access key"), 1)
    other = pick(("commit", "sha1", "md5", "revision", "build id", "etag", "checksum", "uuid", "version"), 2)
    tail = pick((" = \"", ": \"", " = '", "=", ": ", " "), 3)
    close = F.when(tail.contains('"'), F.lit('"')).when(tail.contains("'"), F.lit("'")).otherwise(F.lit(""))
    uuid = F.concat_ws("-", F.substring("h", 1, 8), F.substring("h", 9, 4), F.substring("h", 13, 4), F.substring("h", 17, 4), F.substring("h", 21, 12))
    # Written once, as every shape below uses these.
    drawn = materialise(drawn.select(
        "id", "h", b64.alias("b64"), key.alias("key"), other.alias("other"), tail.alias("tail"), close.alias("close"), uuid.alias("uuid"),
        *[drawn_word(k).alias(f"w{k}") for k in range(1, 12)],
    ), "drawn")
    b64, key, other, tail, close, uuid = (F.col(c) for c in ("b64", "key", "other", "tail", "close", "uuid"))

    def word(k: int) -> Column:
        return F.col(f"w{k}")

    kinds = [
        (1, key, F.substring("h", 1, 40)), (1, key, F.substring("h", 1, 32)), (1, key, F.substring("h", 1, 64)), (1, key, b64),
        (1, key, F.concat(F.lit("AKIA"), F.upper(F.translate(F.substring(b64, 1, 16), "+/", "XY")))),
        (1, key, F.concat(F.lit("ghp_"), F.translate(F.substring(b64, 1, 36), "+/", "ab"))), (1, key, F.upper(F.substring("h", 1, 40))),
        (0, other, F.substring("h", 1, 40)), (0, other, F.substring("h", 1, 32)), (0, other, uuid), (0, word(5), uuid),
        (0, word(6), F.substring(F.translate("h", "abcdef", "123456"), 1, 18)),
        (0, key, F.concat_ws("_", word(1), word(2), word(3), F.lit("2"))), (0, key, F.concat(word(1), word(2), word(3), F.lit("1"))),
        (0, key, F.concat(F.lit("your-"), F.regexp_replace(key, " ", "-"), F.lit("-goes-here-1"))), (0, key, F.lit("xxxxxxxxxxxxxxxx00")),
        (0, word(4), F.concat_ws("-", word(1), word(2), word(3), word(7), F.substring("h", 1, 3))),
    ]
    made = F.array(*[
        F.struct(F.lit(label).alias("secret"), F.concat_ws("", word(8), F.lit(" "), word(9), F.lit(" "), name, tail).alias("before"),
                 value.alias("value"), F.concat(close, F.lit(" "), word(10), F.lit(" "), word(11)).alias("after"))
        for label, name, value in kinds
    ])
    rows_made = drawn.select("id", F.explode(made).alias("m")).select(
        "m.secret", F.substring("m.before", -BEFORE_CHARS, BEFORE_CHARS).alias("before"), "m.value", F.substring("m.after", 1, AFTER_CHARS).alias("after"),
        F.element_at(F.array(*[F.lit(p) for p in ("", "src/config.py", "docs/readme.md", "deploy/app.yaml", "tests/data.json")]),
                     (F.pmod(F.xxhash64("id", "m.value"), F.lit(5)) + 1).cast("int")).alias("path"),
    )
    return rows_made.where(F.length("value") >= 8)


def train(findings: DataFrame, pairs: DataFrame, dictionary: DataFrame) -> RandomForestClassificationModel:
    """The forest from labelled findings (candidates with ``secret``)."""
    rows = materialise(with_features(findings, pairs, dictionary).select("secret", *FEATURES), "findings")
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows)
    forest = RandomForestClassifier(labelCol="secret", featuresCol="features", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
    return forest.fit(vectors)


def scan(
    docs: DataFrame, findings: DataFrame | None = None, cut: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
    path_col: str | None = "source",
) -> DataFrame:
    """(doc_id, start, end, value, score, secret): every candidate and whether the forest calls it a secret.

    ``findings`` are labelled ones (value, before, after, path, secret); without
    them ``made_findings`` of ``docs`` serve. Statistics come from all texts. Null
    texts and empty tables have no candidates; a null path is an empty one; rows
    that repeat an id are scanned each. Places are in code points, end exclusive.
    """
    pairs, dictionary = corpus_statistics(docs, text_col)
    dictionary = materialise(dictionary, "dictionary")
    found = materialise(candidates(docs, id_col, text_col, path_col), "candidates")
    made = findings if findings is not None else materialise(made_findings(docs, id_col=id_col, text_col=text_col), "made")
    columns = ["doc_id", "start", "end", "value"]
    if made.select("secret").distinct().count() < 2:
        return found.select(*columns, F.lit(0.0).alias("score"), F.lit(False).alias("secret"))
    model = train(made, pairs, dictionary)
    described = with_features(found, pairs, dictionary)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(described)
    score = F.round(vector_to_array(F.col("probability"))[1], 6)
    return model.transform(vectors).select(*columns, score.alias("score")).withColumn("secret", F.col("score") >= cut)


def op5_secrets(spark, sf_dir: str) -> DataFrame:
    """Every candidate of every document with its score; values as digests."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return scan(docs).select("doc_id", "start", "end", F.sha2(F.col("value").cast("binary"), 256).alias("value_sha256"), "score", "secret")
