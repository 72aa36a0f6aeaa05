"""The stages chained on a small set of accounts."""

from pyspark.sql import functions as F

from kinmaster.plans import mastering

MASTER = [
    (1, "ExFactory", "q1", "10", "Not Found", "EMUSHCO0000005", "Acme Pharmacy", "12 Main Street", "Boston", "MA", "02139"),
    (2, "Other", "q2", "11", "Found", "EMUSHCO0000007", "Zenith Medical Supply", "400 Ocean Avenue", "Miami", "FL", "33101"),
    (3, "Other", "q3", "12", "Found", "pending", "Lone Star Clinic", "9 Ranch Road", "Austin", "TX", "73301"),
]
EXTRACT = [
    (4, "ExFactory", " Q1 ", "Acme Pharmacy", "12 Main Street", "Boston", "MA", "2139", "10"),
    (5, "ExFactory", "q4", "ACME Pharmcy", "12 Main  Street", "Boston", "MA", "02139-1111", "20"),
    (6, "Other", "q5", "Brand New Hospital", "77 Hill Street", "Denver", "CO", "80201", "21"),
    (7, None, "q6", "Brand-New Hospital", "77 Hill Street", "Denver", "CO", None, "22"),
]
SECOND = [
    ("S1", "Brand New Hospital", "77 Hill St", "Denver", "CO", "80201", "21", "Account"),
    ("S2", "Acme Pharmacy Inc", "12 Main Street", "Boston", "MA", "02139", "99", "Account"),
    ("S3", "Brand New Hospital", "77 Hill Street", "Denver", "CO", "80201", "98", " Trade Partner "),
]


def tables(spark):
    master = spark.createDataFrame(
        MASTER, "ordinal int, Source string, Q_ID string, `ShipTo Code` string, `Final - Status` string, "
        "`Final MDM ID` string, Name string, Address string, City string, State string, Zip string",
    )
    extract = spark.createDataFrame(
        EXTRACT, "ordinal int, Source string, Q_ID string, ShipTo string, Address string, City string, State string, "
        "Zip string, `ShipTo Code` string",
    )
    second = spark.createDataFrame(
        SECOND, "`SFDC ID` string, Name string, Address string, City string, State string, Zip string, "
        "`ShipTo Number` string, RecordType string",
    )
    return extract, master, second


def test_accounts_from_intake_to_ids(spark):
    out = mastering.master_accounts(*tables(spark), order=["ordinal"])
    rows = {r["ordinal"]: r for r in out["all_accounts"].collect()}
    assert sorted(rows) == [1, 2, 3, 5, 6, 7]
    assert [rows[i]["record_number"] for i in (1, 2, 3, 5, 6, 7)] == [1, 2, 3, 4, 5, 6]
    # The new Acme record is the master's Acme; the two Brand New ones are one.
    assert rows[5]["cluster_id"] == rows[1]["cluster_id"] and rows[6]["cluster_id"] == rows[7]["cluster_id"]
    assert rows[5]["final_id"] == "EMUSHCO0000005" and rows[5]["net_new"] == 0
    assert rows[6]["final_id"] == rows[7]["final_id"] == "EMUSHCO0000008"
    assert rows[3]["final_id"] == "pending"
    assert sorted(r["ordinal"] for r in out["net_new_matched"].collect()) == [6]
    assert 7 in [r["ordinal"] for r in out["net_new_unmatched"].collect()]
    assert sorted(r["ordinal"] for r in out["new_accounts"].collect()) == [5, 6, 7]


def test_linkage_to_labels(spark):
    extract, _, second = tables(spark)
    left = mastering.canonical(second).withColumnRenamed("crm_id", "id")
    right = mastering.canonical(extract).where("ordinal > 4").withColumn("id", F.concat(F.lit("N"), "ordinal"))
    linked, pairs = mastering.link(left, right, "id", "id")
    rows = {r["id"]: r for r in linked.collect()}
    assert len(rows) == 6 and rows["S3"]["cluster_id"] is None
    assert rows["S1"]["cluster_id"] == rows["N6"]["cluster_id"] and rows["S2"]["cluster_id"] == rows["N5"]["cluster_id"]
    assert rows["N7"]["cluster_id"] is None
    assert sorted((r["SFDC_id"], r["ExFactory_id"]) for r in pairs.collect()) == [("S1", "N6"), ("S2", "N5")]
    review = mastering.label(linked, ["source_file", "id"], threshold=1.1)
    assert {r["SFDC_Acc_id"] for r in review.collect()} == {"S1", "S2"}


def test_quality_gate_keeps_bad_rows_out_of_matching_only(spark):
    left = spark.createDataFrame([("L", "Acme", "1 Main Street", "Boston", "MA", "02139")], "id string, name string, address string, city string, state string, zip string")
    right = left.withColumn("id", F.lit("R")).withColumn("address", F.lit("Main Street"))
    linked, _ = mastering.link(left, right, "id", "id", quality_gate=True)
    assert linked.count() == 2 and linked.where("cluster_id IS NOT NULL").count() == 0


def test_arrivals_one_after_the_other(spark, tmp_path):
    """IDs given to the first arrival stay, and the second one builds on them."""
    from pyspark.sql import types as T

    from kinmaster.schema import EXTRACT_SCHEMA
    from kinmaster.streaming.intake import stream_files
    from kinmaster.streaming.mastering import master_stream

    _, master, second = tables(spark)
    schema = T.StructType([T.StructField("ordinal", T.IntegerType()), *EXTRACT_SCHEMA.fields])
    folder, sink = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    header = ",".join(f.name for f in schema.fields) + "\n"

    def arrive(name, *rows):
        (folder / name).write_text(header + "".join(",".join(r) + "\n" for r in rows))
        source = stream_files(spark, str(folder), "Mastering Full Extract", schema)
        master_stream(source, master, second, sink, str(tmp_path / "c"), ["ordinal"]).awaitTermination()

    arrive(
        "Mastering Full Extract 1.csv",
        ("5", "ExFactory", "q4", "ACME Pharmcy", "12 Main  Street", "Boston", "MA", "02139", "20"),
        ("6", "Other", "q5", "Brand New Hospital", "77 Hill Street", "Denver", "CO", "80201", "21"),
    )
    first = {r["ordinal"]: r["final_id"] for r in spark.read.parquet(f"{sink}/batch_id=0/all_accounts").collect()}
    assert first[5] == "EMUSHCO0000005" and first[6] == "EMUSHCO0000008"
    arrive(
        "Mastering Full Extract 2.csv",
        ("7", "Other", "q6", "Brand-New Hospital", "77 Hill Street", "Denver", "CO", "80201", "22"),
        ("8", "Other", "q5", "Brand New Hospital", "77 Hill Street", "Denver", "CO", "80201", "21"),
        ("9", "Other", "q7", "Quite Different Care", "1 Lake Road", "Chicago", "IL", "60007", "23"),
    )
    second_run = {r["ordinal"]: r["final_id"] for r in spark.read.parquet(f"{sink}/batch_id=1/all_accounts").collect()}
    assert {k: second_run[k] for k in first} == first
    assert second_run[7] == first[6] and second_run[9] == "EMUSHCO0000009" and 8 not in second_run
