"""A trained model in place of the fixed weights: the results of scoring all pairs, few pairs formed."""

import pytest
from pyspark.sql import functions as F

from kinmaster.operators import clustering, linkage, refinement, scoring, tiles
from kinmaster.operators.pair_model import PairModel
from kinmaster.operators.records import feature_columns
from kinmaster.plans import queries
from kinmaster.schema import ACCOUNT_FIELDS
from tests.test_accounts import components
from tests.test_tiles import accounts, formed, prepared  # noqa: F401

SF = "/root/testdata/sf0.001"
# The address speaks for a match, the city against it, and a missing zip as well.
MODELS = [
    queries.STATED_MODEL,
    PairModel(-1.5, {"name": 1.0, "address": 4.0, "city": -2.5, "zip": 1.0}, {"address": -1.0, "zip": -0.7}),
]


def all_scored(left, right, model):
    """Every pair that shares a key, its probability worked out in Python."""
    a = left.select(*[F.col(c).alias(f"left_{c}") for c in left.columns])
    b = right.select(*[F.col(c).alias(f"right_{c}") for c in right.columns])
    met = a.crossJoin(b).where(F.arrays_overlap("left_keys", "right_keys")).withColumns(feature_columns(ACCOUNT_FIELDS))
    margin = F.lit(model.intercept)
    for f in ACCOUNT_FIELDS:
        margin = margin + F.col(f"sim_{f.name}") * model.similar.get(f.name, 0.0)
        if f.has_missing:
            margin = margin + F.col(f"missing_{f.name}") * model.missing.get(f.name, 0.0)
    rows = met.select("left_record_id", "right_record_id", F.round(1 / (1 + F.exp(-margin)), 6).alias("p")).collect()
    return [tuple(r) for r in rows]


@pytest.mark.parametrize("model", MODELS)
def test_clusters_of_a_large_block(spark, formed, model):  # noqa: F811
    rows = accounts(250, 7)
    records = prepared(spark, rows)
    want = components([r[0] for r in rows], [(a, b) for a, b, s in all_scored(records, records, model) if a < b and s >= 0.6])
    clusters, _, _ = clustering.cluster_records(records, ACCOUNT_FIELDS, None, 0.6, model=model)
    assert {r["record_id"]: r["component"] for r in clusters.collect()} == want
    assert 1 < len(set(want.values())) < 250
    assert sum(formed) < 10 * 250


@pytest.mark.parametrize("model", MODELS)
def test_best_links_of_a_large_block(spark, formed, model):  # noqa: F811
    left, right = accounts(250, 8), accounts(250, 9)
    right[:60] = [(f"q{i}", *row[1:]) for i, row in enumerate(left[:60])]
    a, b = prepared(spark, left), prepared(spark, right)
    best = {}
    for x, y, s in all_scored(a, b, model):
        if s >= 0.4 and (x not in best or (-s, y) < best[x]):
            best[x] = (-s, y)
    found = linkage.link_records(a, b, ACCOUNT_FIELDS, None, 0.4, model=model)
    assert {r["left_id"]: (-r["score"], r["right_id"]) for r in found.collect()} == best
    assert 60 <= len(best) <= 250 and sum(formed) < 62_500 / 10


def test_numbers_of_a_fitted_pipeline(spark):
    """The column expression scores as the pipeline does, and refinement and tiles take the model."""
    records = prepared(spark, accounts(40, 10, 0.6))
    ids = sorted(r["record_id"] for r in records.select("record_id").collect())
    labels = spark.createDataFrame(
        [(a, b, int((i + j) % 3 == 0)) for i, a in enumerate(ids) for j, b in enumerate(ids) if a < b] + [("none", "r0000", 1)],
        "left_id string, right_id string, is_match int",
    )
    featured = scoring.labelled_features(labels, records, records, ACCOUNT_FIELDS).cache()
    assert featured.count() == len(ids) * (len(ids) - 1) // 2
    fitted = scoring.train_scorer(featured, ACCOUNT_FIELDS)
    model = PairModel.of(fitted)
    both = scoring.score_pairs(featured, ACCOUNT_FIELDS, fitted).withColumn("own", model.score(ACCOUNT_FIELDS))
    assert both.where("abs(score - own) > 1e-6").count() == 0
    members = records.select(F.lit("k").alias("key"), "record_id", F.lit(0.0).alias("wanted"))
    best = tiles.best_in_blocks(members, members.drop("wanted"), records, records, ACCOUNT_FIELDS, 7, model)
    assert best.count() == len(ids)
    clusters, reps, copies = clustering.cluster_records(records, ACCOUNT_FIELDS, None, 0.3, model=model)
    refined = refinement.refine_clusters(clusters, reps, copies, ACCOUNT_FIELDS, 0.3, model=model)
    assert refined.count() == len(ids)


def test_learnt_links_find_pairs_never_labelled(spark):
    """Of the odd thirds, which gave no labels, nearly all links are right."""
    linked = queries.learnt_links(spark, SF).where("cluster_id IS NOT NULL")
    a = linked.where("source_file = 0 AND (id div 3) % 2 = 1").select("cluster_id", "id")
    b = linked.where("source_file = 1").select("cluster_id", F.col("id").alias("other"))
    pairs = a.join(b, "cluster_id").selectExpr("id div 3 = other AS good").collect()
    assert len(pairs) >= 2 and sum(r["good"] for r in pairs) >= 0.9 * len(pairs)
