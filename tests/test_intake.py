import pytest
from pyspark.sql import functions as F

from kinmaster.operators import intake, numbering, quality, reshape

EXTRACT = [(1, " a1 ", "X"), (2, None, None), (3, "b2", "Y"), (4, "B2", "X"), (5, "c3", "Y")]
MASTER = [("A1", "Not Found", "X"), ("A1", "Found", None), (None, "Found", "Y"), ("C3", "Not Found", "X")]


@pytest.fixture
def extract(spark):
    return spark.createDataFrame(EXTRACT, "ordinal int, q_id string, source string")


@pytest.fixture
def master(spark):
    return spark.createDataFrame(MASTER, "q_id string, final_status string, source string")


def ordinals(df):
    return sorted(r["ordinal"] for r in df.collect())


def test_missing_keys_match_in_compat_and_are_new_in_strict(extract, master):
    assert ordinals(intake.new_records(extract, master, "q_id")) == [3, 4]
    assert ordinals(intake.new_records(extract, master, "q_id", "strict")) == [2, 3, 4]


def test_repeated_master_keys_do_not_multiply_rows(extract, master):
    known = intake.known_with_status(extract, master, "q_id", "final_status")
    assert ordinals(known) == [1, 5]
    assert {r["q_id"] for r in known.collect()} == {"A1", "C3"}


def test_new_and_known_split_the_extract(extract, master):
    for mode in ("compat", "strict"):
        tagged = intake.tagged_extract(extract, master, "q_id", "final_status", mode=mode)
        new = ordinals(intake.new_records(extract, master, "q_id", mode))
        assert ordinals(tagged.where("is_new")) == new
        assert sorted(new + ordinals(tagged.where("NOT is_new"))) == [1, 2, 3, 4, 5]


def test_missing_source_is_not_the_split_source(extract):
    chosen, rest = intake.split_by_source(extract, "source", "X")
    assert ordinals(chosen) == [1, 4] and ordinals(rest) == [2, 3, 5]


def test_status(extract, master):
    rows = intake.combined_status(extract, master, "q_id", "final_status").collect()
    assert {r["ordinal"]: r["status"] for r in rows} == {1: "Not Found", 3: "Pending", 4: "Pending", 5: "Not Found"}


def test_counts_with_an_absent_group(spark, extract, master):
    only_rest = extract.where("source IS NULL OR source <> 'X'")
    rows = intake.intake_counts(only_rest, master, "q_id", "final_status", "source", "X").collect()
    by_group = {r["source_group"]: r for r in rows}
    assert by_group["split"]["extract_unique"] == 0 and by_group["split"]["master_unique"] == 2
    assert by_group["rest"]["new_unique"] == 1 and by_group["rest"]["not_found_rows"] == 1


def test_logbook_order_and_numbers(spark, extract, master):
    numbered = master.withColumn("ordinal", F.lit(0) + F.length("final_status") + F.hash("q_id") % 7)
    out = intake.append_logbook(numbered, extract, "q_id", ["ordinal", "q_id", "final_status"], "source", "X")
    assert out.columns[0] == "record_number"
    rows = out.orderBy("record_number").collect()
    assert [r["record_number"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["new_account"] for r in rows] == [False] * 4 + [True] * 2
    assert [r["ordinal"] for r in rows[4:]] == [4, 3]


def test_codes_match_across_types(spark):
    left = spark.createDataFrame([(1, "10 "), (2, "11"), (3, None)], "id int, code string")
    right = spark.createDataFrame([(10,), (10,), (12,)], "number int")
    assert [r["id"] for r in intake.matched(left, right, "code", "number").collect()] == [1]
    assert sorted(r["id"] for r in intake.unmatched(left, right, "code", "number").collect()) == [2, 3]


def test_groups_with_a_missing_key_are_not_counted(spark):
    df = spark.createDataFrame([("a", None), ("a", "b"), ("a", "b"), (None, "b")], "x string, y string")
    assert intake.distinct_count(df, "x", "y").first()[0] == 1


def test_dense_numbers_over_uneven_partitions(spark):
    df = spark.range(0, 5000).withColumn("k", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11))
    rows = numbering.dense_number(df, ["k", "id"], "n", start=5).orderBy("k", "id").collect()
    assert [r["n"] for r in rows] == list(range(5, 5005))


def test_dense_numbers_of_nothing(spark):
    assert numbering.dense_number(spark.range(0), ["id"], "n").count() == 0


def test_entry_numbers_with_a_hot_and_a_missing_key(spark):
    df = spark.range(0, 900).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") > 5, F.col("id")))
    rows = numbering.entry_number(df, "k", ["id"]).collect()
    assert len(rows) == 900
    assert sorted(r["entry"] for r in rows if r["k"] == 1) == list(range(1, 301))
    assert sorted(r["entry"] for r in rows if r["k"] is None) == [1, 2, 3, 4]
    first = numbering.first_entries(df.where("k IS NOT NULL"), "k", ["id"], 2).where("k = 1").collect()
    assert [r["id"] for r in first] == [0, 3]


def test_rank_filter_reaches_below_the_shuffle(spark):
    df = numbering.first_entries(spark.range(100).withColumn("k", F.col("id") % 3), "k", ["id"], 2)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_quality_gate(spark):
    rows = [(1, "A", "1 Main"), (2, " ", "1 Main"), (3, "A", "Main"), (4, "A", "1 Main?"), (5, None, "1"), (6, "A", None)]
    df = spark.createDataFrame(rows, "id int, name string, address string")
    kept, dropped = quality.split_quality(df)
    assert [r["id"] for r in kept.collect()] == [1]
    assert sorted(r["id"] for r in dropped.collect()) == [2, 3, 4, 5, 6]


def test_excluded_type(spark):
    df = spark.createDataFrame([(1, " Trade  Partner "), (2, "Account"), (3, None)], "id int, record_type string")
    assert sorted(r["id"] for r in quality.exclude_type(df).collect()) == [2, 3]
    assert quality.excluded_count(df).first()["skipped"] == 1
    assert quality.exclude_type(df.drop("record_type")).count() == 3


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, `c.d` string")
    assert reshape.drop_empty_columns(df).columns == ["a", "c.d"]
    assert reshape.to_front(df, ["c.d"]).columns == ["c.d", "a", "b"]
    assert reshape.align_columns(df, ["z", "a"], ["b"]).columns == ["z", "a", "c.d"]
    assert reshape.prefix_columns(df, "p_").columns == ["p_a", "p_b", "p_c.d"]
    assert reshape.group_by_prefix(["k", "q_b", "p_b", "q_a", "p_a"], ["p_", "q_"]) == ["p_a", "p_b", "q_a", "q_b", "k"]
    with pytest.warns(UserWarning, match="zz"):
        assert reshape.order_columns(df, ["b", "zz", "a"]).columns == ["b", "a"]
    both = reshape.union_all(df.select("a"), df.select("b"))
    assert both.columns == ["a", "b"] and both.count() == 2


def test_profile_of_a_table(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert {tuple(r) for r in intake.profile(df).collect()} == {(2, "a", "int", 2), (2, "b", "string", 1)}
