"""PII, URL rules, secrets and language: rules, edge cases and brute force."""

import re
import time
import zlib

import pytest
from pyspark.sql import functions as F

from kinmaster.llm import language, pii, secret_scan, url_rules

SF = "/root/testdata/sf0.01"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, "ip", m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, "card", m.end()))
    found += [(m.start(), 3, "phone", m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(found)


HARD = [
    None, "", "a@b.c_d@e.f", "a@b", "x@y.z.", "@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "256.1.1.1", "000255.1.1.001", "1.2.3",
    "4111 1111 1111 1111", "4111-1111-1111-1111 4111111111111112", "12345678901234567890123", "+1 (017) 555-5036", "+1",
    "+49 30 1234567 +49301234567", "é😀 me@host.org 10.0.0.1 é", "+1 2(", "a" * 50000, "1" * 30000, "a.b." * 9000 + "@x.y" + ".z" * 9000,
    "5 " * 20000, "+" * 5000 + "1234567890", "mail me: a@b.co, card 4111111111111111", "a@b.c" * 300,
]


def test_base_spans_equal_brute_force(spark):
    texts = HARD + [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    rows = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    for r in pii.find_pii(rows.repartition(8)).select("doc_id", "base_spans").collect():
        assert [(s["start"], s["kind_rank"], s["kind"], s["end"]) for s in r["base_spans"]] == base_spans(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_more_kinds_checksums_and_context(spark):
    good, bad = "GB82 WEST 1234 5698 7654 32", "GB82 WEST 1234 5698 7654 33"
    texts = [f"IBAN {good}.", f"IBAN {bad}.", "social security 078-05-1120", "about 078-05-1120", "ssn 000-05-1120"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {r["doc_id"]: [s["kind"] for s in r["spans"]] for r in pii.find_pii(df).collect()}
    assert kinds == {0: ["iban"], 1: [], 2: ["us_ssn"], 3: [], 4: []}
    shown = {r["doc_id"]: r["text"] for r in pii.redact(spark.createDataFrame([(0, "é me@a.org 1.1.1.1!"), (1, None), (2, "x")], "doc_id long, text string")).collect()}
    assert shown == {0: "é <email> <ip>!", 1: None, 2: "x"}


def test_pii_very_many_matches(spark):
    """A mailing list of 100,000 addresses: cost grows with the text, places and contexts stay right."""
    begun = time.monotonic()
    text = "".join(f"é call {'mail' if i % 3 else 'x' * 70} u{i}@ex{i % 7}.org +1 555 {i:07d},\n" for i in range(100_000))
    rows = spark.createDataFrame([(0, text)], "doc_id long, text string")
    found = pii.find_pii(rows).select("doc_id", "base_spans").collect()[0]["base_spans"]
    assert [(s["start"], s["kind_rank"], s["kind"], s["end"]) for s in found] == base_spans(text)
    emails = [s["score"] for s in found if s["kind"] == "email"]
    assert emails[1] == 1.0 and len(emails) == 100_000
    shown = pii.redact(rows).collect()[0]["text"]
    assert shown == re.sub(r"u\d+@ex\d\.org", "<email>", re.sub(r"\+1 555 \d{7}", "<phone>", text))
    assert time.monotonic() - begun < 90


def test_redact_overlapping_spans(spark):
    """A card inside a phone number is covered by it; what follows it directly is not."""
    text = "+4111 1111 1111 1111 a@b.org,1.2.3.4" * 40
    rows = spark.createDataFrame([(0, text)], "doc_id long, text string")
    spans = [(s["start"], s["kind"], s["end"]) for s in pii.find_pii(rows).collect()[0]["spans"]]
    out, at = "", 0
    for start, kind, end in spans:
        if start >= at:
            out, at = out + text[at:start] + f"<{kind}>", end
    assert pii.redact(rows).collect()[0]["text"] == out + text[at:]


def test_pii_empty_table(spark):
    assert pii.find_pii(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_url_rules(spark):
    cases = [
        ("https://A.Example.net/en/1", "a.example.net", "/en/1", "example.net/en/", "allow"),
        ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None, "allow"),
        ("http://x.example.com/de/a?b#c", "x.example.com", "/de/a", "example.com/de/", "block"),
        ("http://net", "net", "", None, "allow"), ("http://net/", "net", "/", "net/", "block"),
        ("http://a.org/fr/x", "a.org", "/fr/x", "org/fr/", "allow"), ("http://a.org/FR/x", "a.org", "/FR/x", None, "allow"),
        ("http://spam.org/x", "spam.org", "/x", None, "block"), ("http://spammer.org/x", "spammer.org", "/x", None, "allow"),
        (None, "", "", None, "allow"), ("nothing", "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
        ("a://b://net/", "b:", "//net/", None, "allow"), ("http://a.net\n/x", "a.net\n", "/x", None, "allow"),
    ]
    df = spark.createDataFrame([(i, c[0], "z") for i, c in enumerate(cases)] + [(None, cases[0][0], "z")], "page_id long, url string, verdict string")
    got = url_rules.judge(df, url_rules.rule_table(spark)).collect()
    assert len(got) == len(cases) + 1
    for r in got:
        c = cases[r["page_id"] or 0]
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == c[1:], c
    assert url_rules.judge(df.limit(0), url_rules.rule_table(spark)).count() == 0


def test_rule_whose_path_ends_inside_a_word(spark):
    rules = spark.createDataFrame([url_rules.site_rule("block", "com/fr")], url_rules.RULE_SCHEMA)
    df = spark.createDataFrame([(1, "http://a.com/french"), (2, "http://a.com/en")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_rules.judge(df, rules).collect()} == {1: "block", 2: "allow"}


def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    train = docs.where(language.learnable(F.col("doc_id")))
    held = {r["doc_id"] for r in docs.select("doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert held == {r["doc_id"] for r in docs.where(~language.learnable(F.col("doc_id"))).collect()}
    texts = language.dictionaries(train.select("text", "lang"))
    assert set(texts) == {"en", "fr", "de", "es"} and all(len(t) <= 4 * language.SAMPLE_ROWS * language.SAMPLE_CHARS for t in texts.values())
    found = language.identify(docs, texts).where(~language.learnable(F.col("doc_id")))
    right, n = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !!"), (4, "the and " * 9000)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in language.identify(odd, texts).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and all(got[i]["lang_rejected"] for i in (1, 2, 3))
    assert got[4]["lang_pred"] == "en" and 0 <= got[4]["lang_score"] <= 1
    assert language.identify(odd, {}).where("lang_pred <> 'und'").count() == 0
    assert language.keep_identified(docs.limit(0)).count() == 0


def test_secrets_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = secret_scan.made_findings(docs.where("doc_id % 2 = 0"))
    held = secret_scan.made_findings(docs.where("doc_id % 2 = 1"), rows=100)
    pairs, dictionary = secret_scan.corpus_statistics(docs)
    model = secret_scan.train(made, pairs, dictionary)
    from pyspark.ml.feature import VectorAssembler

    rows = secret_scan.with_features(held, pairs, dictionary)
    out = model.transform(VectorAssembler(inputCols=list(secret_scan.FEATURES), outputCol="features").transform(rows))
    right, n = out.agg(F.sum((F.col("prediction") == F.col("secret")).cast("int")), F.count("*")).first()
    assert n > 500 and right / n > 0.95


def test_secrets_found_and_edges(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source")
    planted = docs.where(F.col("text").rlike('token = "[0-9a-f]{40}"')).select("doc_id").distinct().count()
    got = secret_scan.scan(docs)
    assert got.where("secret").select("doc_id").distinct().count() >= planted > 0
    none = spark.createDataFrame([(1, None, None, 5), (2, "", "x", 6)], "doc_id long, text string, source string, score int")
    assert secret_scan.scan(none).count() == 0
    assert secret_scan.scan(none.limit(0)).count() == 0


@pytest.mark.parametrize("text, want", [
    ('key = "abcdefgh"', ["abcdefgh"]), ("x0123456789abcdef", ["x0123456789abcdef"]), ("abcdefghijklmnopqrst", []),
    ("é " + "a1" * 8 + "==!", ["a1" * 8 + "=="]),
])
def test_candidates(spark, text, want):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = secret_scan.candidates(df, path_col=None).collect()
    assert [r["value"] for r in got] == want
    assert all(text[r["start"]:r["end"]] == r["value"] for r in got)
