"""Records made ready for matching, their features and the fixed score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster.functions.similarity import edit_similarity, hashed_grams, hashed_words, jaccard
from kinmaster.functions.text import is_blank
from kinmaster.operators.joins import in_buckets, join_back
from kinmaster.schema import FieldSpec
from kinmaster.session import materialise


def _word_column(field: FieldSpec) -> str:
    return f"words_{field.name}"


def _present(column: Column) -> Column:
    return ~is_blank(column)


def hashed_keys(rules: Mapping[str, Column]) -> Column:
    """All rules' keys of a record as distinct hashes."""

    def hashed_rule(rule: str, keys: Column) -> Column:
        return F.transform(F.filter(keys, lambda k: ~is_blank(k)), lambda k: F.xxhash64(F.lit(rule), k))

    hashed = [hashed_rule(rule, keys) for rule, keys in rules.items()]
    return F.array_distinct(F.concat(*[F.coalesce(h, F.array().cast("array<bigint>")) for h in hashed]))


def prepare_records(
    df: DataFrame, record_id: str, fields: Sequence[FieldSpec], rules: Mapping[str, Column], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per record: id, compared values, tokens, blocking keys, self score.

    Values of ``text`` fields are reduced to hashed words (the whole value is
    read); the other fields keep their cleaned value. The result is written
    once, since blocking, scoring and clustering all read it.
    """
    texts = [f for f in fields if f.kind == "text"]
    columns = [F.col(record_id).alias("record_id"), *[F.col(c) for c in keep]]
    columns += [F.col(f.name) for f in fields if f.kind != "text"]
    columns += [hashed_words(F.col(f.name)).alias(_word_column(f)) for f in texts]
    columns += [hashed_keys(rules).alias("keys")]
    sets = [F.col(_word_column(f)) for f in texts]
    sets += [hashed_grams(F.col(f.name), f.name) for f in fields if f.kind == "string"]
    tokens = sets[0] if len(sets) == 1 else F.array_distinct(F.concat(*sets))
    prepared = df.select(*columns).withColumn("tokens", tokens).withColumn("self_score", self_score(fields))
    if len(sets) == 1 and texts:
        # The words of a lone text are the tokens: keep and shuffle them once.
        prepared = prepared.drop(_word_column(texts[0]))
    return materialise(prepared, "records")


def with_words(df: DataFrame, fields: Sequence[FieldSpec], side: str = "") -> DataFrame:
    """The words of a lone text under their own name again."""
    names = [_word_column(f) for f in fields if f.kind == "text"]
    return df.withColumns({side + n: F.col(side + "tokens") for n in names if side + n not in df.columns})


def field_present(field: FieldSpec, side: str = "") -> Column:
    if field.kind == "text":
        return F.size(F.col(side + _word_column(field))) > 0
    return _present(F.col(side + field.name))


def self_score(fields: Sequence[FieldSpec]) -> Column:
    """Score of a record against an exact copy of itself."""
    gained = sum((F.when(field_present(f), F.lit(f.weight)).otherwise(F.lit(0.0)) for f in fields), F.lit(0.0))
    counted = sum(
        (
            F.when(field_present(f), F.lit(f.weight)).otherwise(F.lit(0.0 if f.has_missing else f.weight))
            for f in fields
        ),
        F.lit(0.0),
    )
    return F.when(counted > 0, F.round(gained / counted, 6)).otherwise(F.lit(0.0))


def collapse_copies(records: DataFrame, fields: Sequence[FieldSpec]) -> tuple[DataFrame, DataFrame]:
    """(representatives, copies): records the scorer cannot tell apart become one.

    ``copies`` maps every record to its representative, the lowest id among
    those alike; representatives carry the number of records they stand for.
    Records without any token have nothing to match on and stand alone.
    """
    compared = [_word_column(f) if f.kind == "text" else f.name for f in fields]
    values = [*compared, "sorted_keys"]
    # 128 bits over all values; hashing skips NULLs, so where they are counts too.
    flat = [c for v in values for c in (F.col(v), F.col(v).isNull())]
    alone = F.when((F.size("tokens") == 0) | (F.size("keys") == 0), F.col("record_id"))
    digest = F.struct(
        F.xxhash64(F.lit(0), *flat).alias("a"), F.xxhash64(F.lit(1), *flat).alias("b"), alone.alias("alone")
    )
    records = records.withColumn("sorted_keys", F.sort_array("keys"))
    digests = with_words(records, fields).select("record_id", digest.alias("digest"))
    digests = materialise(digests, "digests")
    records = records.drop("sorted_keys")
    groups = digests.groupBy("digest").agg(
        F.min("record_id").alias("rep_id"), F.count(F.lit(1)).alias("n_copies")
    )
    groups = materialise(groups, "copy_groups")
    copies = materialise(join_back(digests, groups, "digest", "digest").select("record_id", "rep_id"), "copies")
    # Records are long: only those that have copies, or may have, are shuffled.
    several = groups.where("n_copies > 1").select("digest")
    concerned = materialise(join_back(digests, several, "digest", "digest", "left_semi").select("record_id"), "copied")
    counts = groups.where("n_copies > 1").select(F.col("rep_id").alias("record_id"), "n_copies")
    dropped = copies.where("record_id <> rep_id").select("record_id")
    near = in_buckets(records, "record_id", concerned)
    reps = in_buckets(records, "record_id", concerned, "left_anti").withColumn("n_copies", F.lit(1).cast("bigint")).unionByName(
        near.join(dropped, "record_id", "left_anti").join(counts, "record_id", "left")
        .withColumn("n_copies", F.coalesce("n_copies", F.lit(1).cast("bigint")))
    )
    return materialise(reps, "representatives"), copies


def feature_columns(fields: Sequence[FieldSpec], left: str = "left_", right: str = "right_") -> dict[str, Column]:
    """``sim_<field>`` and ``missing_<field>`` for a row holding both records."""
    out: dict[str, Column] = {}
    for f in fields:
        if f.kind == "text":
            value = jaccard(F.col(left + _word_column(f)), F.col(right + _word_column(f)))
        elif f.kind == "string":
            value = edit_similarity(F.col(left + f.name), F.col(right + f.name))
        else:
            value = F.col(left + f.name).eqNullSafe(F.col(right + f.name)).cast("double")
        both = field_present(f, left) & field_present(f, right)
        out[f"sim_{f.name}"] = F.when(both, F.round(value, 6)).otherwise(F.lit(0.0))
        out[f"missing_{f.name}"] = F.when(both, F.lit(0)).otherwise(F.lit(1))
    return out


def fixed_score(fields: Sequence[FieldSpec]) -> Column:
    """Weighted mean of the field similarities, six decimals.

    A field that may be missing and is, on either side, is left out.
    """
    gained = sum((F.col(f"sim_{f.name}") * f.weight for f in fields), F.lit(0.0))
    counted = sum(
        (F.lit(f.weight) * (1 - F.col(f"missing_{f.name}")) if f.has_missing else F.lit(f.weight) for f in fields),
        F.lit(0.0),
    )
    return F.when(counted > 0, F.round(gained / counted, 6)).otherwise(F.lit(0.0))
