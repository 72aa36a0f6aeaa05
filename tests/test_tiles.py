"""Large blocks: exact results, few pairs formed."""

import random

import pytest
from pyspark.sql import functions as F

from kinmaster.operators import clustering, linkage, tiles
from kinmaster.operators.blocking import account_rules, compare
from kinmaster.operators.records import prepare_records
from kinmaster.schema import ACCOUNT_FIELDS, FieldSpec
from tests.test_accounts import COLUMNS, all_scored, components


def accounts(n, seed, families=0.3):
    """Names of one sound in one state: all in one block, some of them copies with changes."""
    rng = random.Random(seed)

    def word(k):
        return "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=k))

    rows = []
    for i in range(n):
        if rows and rng.random() < families:
            row = list(rng.choice(rows)[1:])
            at = rng.randrange(5)
            row[at] = rng.choice([None, "", (row[at] or "x") + word(rng.randrange(1, 4)), word(6)]) if at not in (0, 3) else row[at]
        else:
            sound = rng.choice(["smith", "smyth", "smiith", "smitth", "smythe"])
            row = [f"{sound} {word(rng.randrange(3, 14))}", f"{rng.randrange(9999)} {word(8)}", word(7), "MA", f"{rng.randrange(99999):05d}"]
        rows.append((f"r{i:04d}", *row))
    return rows


def prepared(spark, rows):
    return prepare_records(spark.createDataFrame(rows, COLUMNS), "id", ACCOUNT_FIELDS, account_rules())


@pytest.fixture
def formed(monkeypatch):
    """Pairs handed to the comparison of whole records."""
    seen = []
    for module in (clustering, linkage):
        real = module.compare
        monkeypatch.setattr(module, "compare", lambda pairs, *a, real=real: seen.append(pairs.count()) or real(pairs, *a))
    return seen


def test_clusters_of_a_large_block(spark, formed):
    rows = accounts(400, 1)
    records = prepared(spark, rows)
    want = components([r[0] for r in rows], [(a, b) for a, b, s in all_scored(records, records) if a < b and s >= 0.5])
    clusters, _, _ = clustering.cluster_records(records, ACCOUNT_FIELDS, None)
    assert {r["record_id"]: r["component"] for r in clusters.collect()} == want
    assert 1 < len(set(want.values())) < 400
    # A star, three rounds of hubs and the links found: not the 79,800 pairs of the block.
    assert sum(formed) < 8 * 400


def test_best_links_of_a_large_block(spark, formed):
    left, right = accounts(400, 2), accounts(400, 3)
    right[:100] = [(f"q{i}", *row[1:]) for i, row in enumerate(left[:100])]
    a, b = prepared(spark, left), prepared(spark, right)
    best = {}
    for x, y, s in all_scored(a, b):
        if s >= 0.1 and (x not in best or (-s, y) < best[x]):
            best[x] = (-s, y)
    got = {r["left_id"]: (-r["score"], r["right_id"]) for r in linkage.link_records(a, b, ACCOUNT_FIELDS, None).collect()}
    assert got == best and len(got) == 400
    assert sum(formed) < 160_000 / 20


@pytest.mark.parametrize("chunk", [1, 7, 256])
def test_chunks_change_nothing(spark, chunk):
    records = prepared(spark, accounts(60, 4, 0.5))
    scored = [(a, b) for a, b, s in all_scored(records, records) if a < b and s >= 0.5]
    blocks = records.select(F.lit("k").alias("key"), "record_id", F.col("record_id").alias("component"), F.lit("r0000").alias("main"))
    links = {tuple(r) for r in tiles.links_across(blocks, records, ACCOUNT_FIELDS, 0.5, chunk).collect()}
    state = {r["record_id"] for r in records.collect()}
    assert links == {(a, b) for a, b in scored if {a, b} <= state}


def test_blank_values_and_text_fields(spark):
    fields = (FieldSpec("text", "text", weight=0.8), FieldSpec("lang", "exact", has_missing=True, weight=0.2))
    rows = [("a", "one two three four", "en"), ("b", "one two three five", None), ("c", "", "en"), ("d", None, None), ("e", "six", "en")]
    df = spark.createDataFrame(rows, "id string, text string, lang string")
    records = prepare_records(df, "id", fields, {"all": F.array(F.lit("k"))})
    members = records.select(F.lit("k").alias("key"), "record_id")
    got = tiles.best_in_blocks(members.withColumn("wanted", F.lit(0.3)), members.where("record_id <> 'a'"), records, records, fields, 2)
    found = {r["left_id"]: (r["right_id"], r["score"]) for r in got.collect()}
    assert found["a"] == ("b", 0.6) and found["b"] == ("b", 1.0) and found["e"] == ("e", 1.0)
    assert "d" not in found and "c" not in found


def test_edit_distances_are_compiled_and_worked_out_once(spark):
    records = prepared(spark, accounts(30, 5))
    pairs = records.selectExpr("record_id AS left_id").crossJoin(records.selectExpr("record_id AS right_id"))
    tested = compare(pairs, records, records, ACCOUNT_FIELDS, None).where("score >= 0.5")
    assert tested._jdf.queryExecution().optimizedPlan().toString().count("levenshtein(") == 4
    members = records.select(F.lit("k").alias("key"), "record_id")
    best = tiles.best_in_blocks(members.withColumn("wanted", F.lit(0.3)), members, records, records, ACCOUNT_FIELDS)
    assert "lambdafunction" not in best._jdf.queryExecution().optimizedPlan().toString()
