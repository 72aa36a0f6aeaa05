import pytest
from pyspark.sql import functions as F

from kinmaster.operators import review

COLUMNS = "cluster_id int, link_score double, source_file int, id string, name string, address string, city string, state string, zip string"


def linked(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def pair(cluster, score, first, second, address=("1 Main", "1 Main")):
    return [
        (cluster, score, i, f"{cluster}{i}", name, address[i], "Town", "NY", "01234")
        for i, name in enumerate((first, second))
    ]


ORDER = ["source_file", "id"]


def labels(spark, rows):
    return {r["cluster_id"]: r["label"] for r in review.label_pairs(linked(spark, rows), ORDER).collect()}


def test_labels(spark):
    far = ("1 Main", "999 Completely Elsewhere Boulevard")
    rows = (
        pair(1, 0.1, "Acme", "ACME") + pair(2, 0.1, "Acme", "Zzzz") + pair(3, 0.1, "Acme", "Acme", far)
        + pair(4, 0.1, "Acme", "Zzzz", far) + pair(5, 0.520, "Acme", "Acme") + pair(6, 0.1, "Acme", None)
        + pair(7, 0.1, "Acme", "Acme")[:1]
    )
    assert labels(spark, rows) == {
        1: "Reliable match", 2: "Name mismatch, address same", 3: "Name match, address different",
        4: "Name and Address do not match", 6: "Other",
    }


def test_cuts_include_their_value(spark):
    # 2 * 7 / 20 is 0.70; the address lines differ in one letter of 40 (0.975).
    assert labels(spark, pair(1, 0.1, "abcdefgxyz", "abcdefgtuv")) == {1: "Reliable match"}
    label = review.label_of(F.lit(0.69), F.lit(0.80))
    assert spark.range(1).select(label).first()[0] == "Name mismatch, address same"
    assert spark.range(1).select(review.label_of(F.lit(0.70), F.lit(0.79))).first()[0] == "Name match, address different"


def test_third_entry_is_ignored(spark):
    rows = pair(1, 0.1, "Acme", "Acme") + [(1, 0.1, 2, "19", "Zzzz", "x", "y", "z", "0")]
    assert labels(spark, rows) == {1: "Reliable match"}


def test_scores_move_before_other_fills_in(spark):
    rows = pair(1, 0.1, "Acme", "Acme") + pair(2, 0.1, "Acme", "Zzzz") + pair(3, 0.9, "Acme", "Acme")
    df = linked(spark, rows)
    out = review.attach_labels(df, review.label_pairs(df, ORDER))
    assert {(r["cluster_id"], r["label"], r["adjusted_link_score"]) for r in out.collect()} == {
        (1, "Reliable match", 0.52), (2, "Name mismatch, address same", 0.3), (3, "Other", 0.9),
    }


def test_review_table(spark):
    rows = pair(1, 0.1, "Acme", "Acme") + pair(2, 0.9, "Acme", "Zzzz") + pair(3, 0.9, "Alone", "x")[:1]
    df = linked(spark, rows).withColumn("q_id", F.lit(None).cast("string"))
    labelled = review.attach_labels(df, review.label_pairs(df, ORDER))
    with pytest.warns(UserWarning, match="ship_to_number"):
        out = review.review_output(review.review_pivot(labelled, ORDER))
    assert out.columns[:4] == ["adjusted_link_score", "cluster_id", "SFDC_Acc_id", "SFDC_Acc_name"]
    assert "SFDC_Acc_q_id" not in out.columns and out.columns[-1] == "label"
    by_cluster = {r["cluster_id"]: r for r in out.collect()}
    assert by_cluster[1]["SFDC_Acc_name"] == "Acme" and by_cluster[1]["ExFactory_id"] == "11"
    assert by_cluster[3]["ExFactory_id"] is None and len(by_cluster) == 3


def test_overrides_replace_labels(spark):
    df = spark.createDataFrame([(1, "Other"), (2, "Other")], "cluster_id int, label string")
    changed = review.apply_overrides(df, df.where("cluster_id = 2").withColumn("label", F.lit("Reliable match")))
    assert sorted(map(tuple, changed.collect())) == [(1, "Other"), (2, "Reliable match")]


def test_final_column_order():
    # Fixed value: the order of the finished table.
    assert review.review_order()[12:23] == [
        f"ExFactory_{c}" for c in (
            "address", "city", "id", "link_score", "name", "q_id", "ship_to_number", "source", "state", "zip", "source_file",
        )
    ]
