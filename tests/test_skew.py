"""A key with a third of all rows is split over tasks where it is joined."""

import pytest
from pyspark.sql import functions as F

from kinmaster.operators import identity, intake
from kinmaster.operators.joins import join_back

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def eager_skew(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    return spark.range(0, 120_000, 1, 8).select(
        F.col("id").alias("record_number"), hot.alias("cluster_id"), F.md5(F.col("id").cast("string")).alias("final_id")
    )


def test_a_join_back_to_a_grouping_splits_the_hot_key(eager_skew, rows):
    counts = rows.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    assert "skew=true" in final_plan(join_back(rows, counts, "cluster_id", "cluster_id"))


def test_conflicts_of_a_hot_cluster(eager_skew, rows):
    out = identity.cluster_conflict(rows)
    assert "skew=true" in final_plan(out)
    assert out.where("label = 1").count() == 40_001


def test_known_records_with_a_hot_key(eager_skew, rows):
    master = rows.where("cluster_id = 7").withColumn("cluster_id", F.col("cluster_id").cast("string"))
    extract = rows.withColumn("cluster_id", F.col("cluster_id").cast("string"))
    new = intake.new_records(extract, master, "cluster_id")
    assert "skew=true" in final_plan(new)
    assert new.count() == 79_999
