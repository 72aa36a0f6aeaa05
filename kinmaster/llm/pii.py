"""Personal data in text: patterns propose, checksums confirm, context words weigh (DataFrame functions only).

A kind of data has a pattern, a check of the text it matched, a score to begin
with and words that raise it when they stand near. Matches of one kind are the
leftmost ones that do not overlap; one that fails its check is dropped and not
tried again from another place.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinmaster.llm.textspans import bound, cut, pieces, places

SPAN = "struct<start:int,kind_rank:int,kind:string,end:int,score:double>"
CONTEXT_CHARS = 60
CONTEXT_BONUS = 0.2


@dataclass(frozen=True)
class Kind:
    """``pattern`` is a Java expression; repetitions give nothing back, so a text is passed once."""

    name: str
    pattern: str
    hint: str  # a cheap expression that every text with a match satisfies
    check: Callable[[Column], Column]
    score: float
    words: Sequence[str] = field(default=())


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The last digit is 1; from there every second one counts double, with its digits summed."""
    at = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(at, F.lit(0), lambda acc, i: acc + _luhn_digit(F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int"), i))
    return (F.length(digits) > 0) & (total % 10 == 0)


def _luhn_digit(digit: Column, place: Column) -> Column:
    double = digit * 2
    return F.when(place % 2 == 1, digit).when(double > 9, double - 9).otherwise(double)


def mod_97(text: Column) -> Column:
    """ISO 7064 as in account numbers: first four characters last, letters as 10 to 35, remainder 1."""
    plain = F.upper(F.regexp_replace(text, "[^A-Za-z0-9]", ""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(acc: Column, i: Column) -> Column:
        c = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(c < 58, acc * 10 + c - 48).otherwise(acc * 100 + c - 55) % 97

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(turned), F.lit(1))), F.lit(0), step) == 1


def _card(match: Column) -> Column:
    digits = digits_of(match)
    return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)


def _phone(match: Column) -> Column:
    return F.length(digits_of(match)).between(10, 15)


def _ip(match: Column) -> Column:
    """Every part at most 255, however many zeros it begins with."""
    return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(r"^(?:\d{0,2}|1\d\d|2[0-4]\d|25[0-5])$"))


def _iban(match: Column) -> Column:
    plain = F.regexp_replace(match, " ", "")
    return F.when(F.length(plain).between(15, 34), mod_97(plain)).otherwise(False)


def _us_number(match: Column) -> Column:
    return ~match.rlike(r"^(?:000|666|9)") & ~match.rlike(r"-00-") & ~match.rlike(r"-0000$")


def _always(match: Column) -> Column:
    return F.lit(True)


# What a span must have: fixed values. ``\G`` lets a match begin where the last one ended.
BASE_KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", _always, 0.9,
         ("mail", "contact", "write", "address")),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", _ip, 0.6, ("ip", "host", "server", "address", "login")),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"(?:[0-9][\x20-]?){13}[0-9]", _card, 0.7, ("card", "credit", "visa", "payment", "debit", "pay")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _phone, 0.6, ("phone", "call", "tel", "mobile", "fax", "contact")),
)
# What the method adds; a parameter.
MORE_KINDS = (
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]", _iban, 0.9,
         ("iban", "bank", "account", "transfer", "konto", "compte", "cuenta")),
    Kind("us_ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _us_number, 0.4, ("ssn", "social", "security")),
)


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """Checked spans of one kind, in code points, end exclusive; texts without its hint are not searched."""
    def weighed(parts: Column, size: Column, s: Column) -> Column:
        end = s["start"] + F.length(s["match"])
        before = cut(parts, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)), s["start"])
        after = cut(parts, end, F.least(end + CONTEXT_CHARS, size))
        near = F.lower(F.concat(before, F.lit(" "), after))
        words = "|".join(kind.words)
        bonus = F.when(near.rlike(rf"(?<![a-z])(?:{words})(?![a-z])"), CONTEXT_BONUS).otherwise(0.0) if words else F.lit(0.0)
        return F.struct(
            s["start"].alias("start"), F.lit(rank).alias("kind_rank"), F.lit(kind.name).alias("kind"), end.alias("end"),
            F.least(F.lit(1.0), F.lit(kind.score) + bonus).alias("score"),
        )

    checked = F.filter(places(text, kind.pattern), lambda s: kind.check(s["match"]))
    spans = bound([pieces(text), F.length(text)], lambda parts, size: F.transform(checked, lambda s: weighed(parts, size, s)))
    return F.when(text.rlike(kind.hint), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def find_pii(
    docs: DataFrame, more: Sequence[Kind] = MORE_KINDS, min_score: float = 0.5, text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans`` (arrays of start, kind, end and score).

    ``base_spans`` are all checked spans of the base kinds; ``spans`` also those
    of further kinds that reach ``min_score`` with their context. Both by start, then
    by kind as listed. Spans of different kinds may overlap. A null text counts as
    empty: no spans. Columns of the two names are replaced, others pass through.
    """
    text = F.col("__text")
    rows = docs.drop("base_spans", "spans").withColumn("__text", F.coalesce(F.col(text_col), F.lit("")))
    base = F.array_sort(F.concat(*[spans_of(text, k, i) for i, k in enumerate(BASE_KINDS)]))
    added = [F.filter(spans_of(text, k, i), lambda s: s["score"] >= min_score) for i, k in enumerate(more, len(BASE_KINDS))]
    rows = rows.withColumn("base_spans", base)
    if added:
        rows = rows.withColumn("__more", F.concat(*added))
        merged = F.when(F.size("__more") == 0, F.col("base_spans")).otherwise(F.array_sort(F.concat("base_spans", "__more")))
    else:
        merged = F.col("base_spans")
    return rows.withColumn("spans", merged).drop("__text", "__more")


def redact(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span in the text replaced by its kind in angle brackets.

    A span that begins inside an earlier one is covered by that. Null texts stay null.
    """
    found = find_pii(docs, text_col=text_col, **options)
    text = F.col(text_col)

    def joined(shown: Column, parts: Column) -> Column:
        ends = F.concat(F.array(F.lit(0)), F.transform(shown, lambda s: s["end"]))
        return bound([ends], lambda ends: F.concat(
            F.array_join(F.transform(shown, lambda s, i: F.concat(cut(parts, F.get(ends, i), s["start"]), F.lit("<"), s["kind"], F.lit(">"))), ""),
            cut(parts, F.element_at(ends, -1), F.length(text)),
        ))

    hidden = F.when(F.size("spans") > 0, bound([_apart(F.col("spans")), pieces(text)], joined)).otherwise(text)
    return found.withColumn(text_col, hidden).select(*docs.columns)


def _apart(spans: Column) -> Column:
    """Spans, in order, without those that begin inside one that is kept.

    The spans are gone through in groups of about the square root of their number, so no long array grows one by one.
    """
    nothing = F.array().cast(f"array<{SPAN}>")

    def take(acc: Column, s: Column) -> Column:
        longer = F.struct(s["end"].alias("at"), F.concat(acc["found"], F.array(s)).alias("found"))
        return F.when(s["start"] >= acc["at"], longer).otherwise(acc)

    def group(acc: Column, part: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), nothing.alias("found"))
        return bound([F.aggregate(part, begin, take)], lambda done: F.struct(
            done["at"].alias("at"), F.concat(acc["found"], F.array(done["found"])).alias("found")))

    def groups(spans: Column, size: Column) -> Column:
        firsts = F.sequence(F.lit(1), F.greatest(F.size(spans), F.lit(1)), size)
        return F.transform(firsts, lambda i: F.slice(spans, i, size))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{SPAN}>>").alias("found"))
    parts = bound([spans, F.ceil(F.sqrt(F.size(spans) + 1)).cast("int")], groups)
    return F.flatten(F.aggregate(parts, start, group)["found"])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    """Counts, digest and spans of the personal data in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_pii(docs)
    counts = [_count(F.col("base_spans"), k.name).alias(f"n_{k.name}") for k in BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(_joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"), F.array_min(F.transform("spans", lambda s: s["score"])).alias("least_score"),
    )
