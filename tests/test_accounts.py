"""Account matching without a similarity cut, against all pairs that share a key."""

import itertools

import pytest
from pyspark.sql import functions as F

from kinmaster.operators import clustering, linkage, scoring
from kinmaster.operators.blocking import account_rules
from kinmaster.operators.records import feature_columns, fixed_score, prepare_records
from kinmaster.plans import mastering, roles
from kinmaster.schema import ACCOUNT_FIELDS, DEDUPE_THRESHOLD, LINK_THRESHOLD, REVIEW_THRESHOLD
from kinmaster.sources import readers, writers

SF = "/root/testdata/sf0.001"
COLUMNS = "id string, name string, address string, city string, state string, zip string"


def all_scored(left, right):
    """Every pair that shares a key, scored, without blocking."""
    a = left.select(*[F.col(c).alias(f"left_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"right_{c}") for c in right.columns])
    met = a.crossJoin(b).where(F.arrays_overlap("left_keys", "right_keys"))
    scored = met.withColumns(feature_columns(ACCOUNT_FIELDS)).withColumn("score", fixed_score(ACCOUNT_FIELDS))
    return [(r[0], r[1], r[2]) for r in scored.select("left_record_id", "right_record_id", "score").collect()]


def components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("limit", [100, 2])
def test_clusters_equal_all_pairs(spark, limit):
    cleaned = mastering.clean_for_dedupe(roles.accounts(spark, SF))
    records = prepare_records(cleaned, "id", ACCOUNT_FIELDS, account_rules())
    scored = all_scored(records, records)
    want = components([r[0] for r in records.select("record_id").collect()], [(a, b) for a, b, s in scored if a < b and s >= DEDUPE_THRESHOLD])
    clusters, _, _ = clustering.cluster_records(records, ACCOUNT_FIELDS, None, limit=limit)
    assert {r["record_id"]: r["component"] for r in clusters.collect()} == want
    assert len(set(want.values())) < len(want)


def test_links_equal_all_pairs(spark):
    left = prepare_records(mastering.clean_for_linkage(roles.accounts(spark, SF)), "id", ACCOUNT_FIELDS, account_rules())
    right = prepare_records(mastering.clean_for_linkage(roles.crm_accounts(spark, SF)), "id", ACCOUNT_FIELDS, account_rules())
    best = {}
    for a, group in itertools.groupby(sorted(all_scored(left, right)), key=lambda p: p[0]):
        score, b = max((s, -b) for _, b, s in group)
        if score >= LINK_THRESHOLD:
            best[a] = (-b, score)
    got = {r["left_id"]: (r["right_id"], r["score"]) for r in linkage.link_records(left, right, ACCOUNT_FIELDS, None).collect()}
    assert got == best
    assert any(s < REVIEW_THRESHOLD for _, s in got.values())


def test_one_part_alike_is_enough(spark):
    left = spark.createDataFrame([("a", "Acme Pharmacy", "12 Main Street", "Boston", "MA", "02139"), ("b", "Zenith Supply", "400 Ocean Avenue", "Miami", "FL", "33101")], COLUMNS)
    right = spark.createDataFrame([("x", "Acme Pharmacy", "9 Far Road", "Boston", "MA", "94105"), ("y", "Lone Star Clinic", "400 Ocean Avenue", "Miami", "FL", "33101")], COLUMNS)
    linked, _ = mastering.link(left, right, "id", "id")
    clusters = {}
    for r in linked.where("cluster_id IS NOT NULL").collect():
        clusters.setdefault(r["cluster_id"], set()).add(r["id"])
    assert sorted(map(sorted, clusters.values())) == [["a", "x"], ["b", "y"]]


def test_a_correction_of_the_same_day_holds(spark):
    schema = "left_id int, right_id int, is_match int, labelled_at string"
    store = spark.createDataFrame([(1, 2, 1, "2024-01-01"), (3, 4, 1, "2024-01-02")], schema)
    new = spark.createDataFrame([(1, 2, 0, "2024-01-01"), (3, 4, 0, "2024-01-01")], schema)
    got = {(r["left_id"], r["right_id"]): r["is_match"] for r in scoring.upsert_labels(store, new).collect()}
    assert got == {(1, 2): 0, (3, 4): 1}


def test_versions_written_are_found(spark, tmp_path):
    df = spark.range(3)
    first = writers.next_version(spark, str(tmp_path), "Log ")
    writers.write_set({"t": df}, first)
    second = writers.next_version(spark, str(tmp_path), "Log ")
    writers.write_set({"t": df.where("id = 1")}, second)
    writers.write_table(df, f"{tmp_path}/Log v0.9.parquet")
    assert first.endswith("Log v1.0") and second.endswith("Log v1.1")
    newest = readers.latest_versioned(spark, str(tmp_path), "Log ")
    assert newest.endswith("Log v1.1")
    assert [r["id"] for r in writers.read_set(spark, newest, "t")["t"].collect()] == [1]
    assert readers.latest_by_time(spark, str(tmp_path), "Log ").endswith("v0.9.parquet")


def test_sample_is_the_first_by_digest(spark):
    pairs = spark.range(20000).selectExpr("id AS left_id", "id + 1 AS right_id")
    want = [tuple(r) for r in pairs.orderBy(scoring.pair_order(), "left_id", "right_id").limit(50).collect()]
    assert sorted(tuple(r) for r in scoring.sample_pairs(pairs, 50).collect()) == sorted(want)
