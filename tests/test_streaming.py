from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.operators import intake
from kinmaster.streaming import intake as stream

SCHEMA = S.text_schema("q_id", "source")


def drop_file(folder, name, *rows):
    (folder / name).write_text("q_id,source\n" + "".join(f"{','.join(r)}\n" for r in rows))


def run(spark, tmp_path, master, **options):
    source = stream.stream_files(spark, str(tmp_path / "in"), "Extract", SCHEMA)
    sink = str(tmp_path / "out")

    def known(batch_id):
        before = stream.accepted_before(spark, sink, batch_id, SCHEMA)
        return master.unionByName(before.select("q_id", "source"))

    query = stream.stream_intake(source, known, sink, str(tmp_path / "checkpoint"), "q_id", **options)
    query.awaitTermination()
    return spark.read.schema("q_id string, source string, batch_id long").parquet(sink)


def test_arrivals_equal_batch_and_later_ones_see_earlier_ones(spark, tmp_path):
    (tmp_path / "in").mkdir()
    master = spark.createDataFrame([("A", "x")], SCHEMA)
    drop_file(tmp_path / "in", "Extract 1.csv", ("a", "x"), ("b", "x"))
    drop_file(tmp_path / "in", "Other 1.csv", ("zzz", "x"))
    first = run(spark, tmp_path, master)
    batch = intake.new_records(spark.createDataFrame([("a", "x"), ("b", "x")], SCHEMA), master, "q_id")
    assert [r["q_id"] for r in first.collect()] == [r["q_id"] for r in batch.collect()] == ["B"]
    drop_file(tmp_path / "in", "Extract 2.csv", (" b", "x"), ("c", "y"))
    second = run(spark, tmp_path, master)
    assert sorted((r["q_id"], r["batch_id"]) for r in second.collect()) == [("B", 0), ("C", 1)]
    # Nothing new: nothing happens.
    assert run(spark, tmp_path, master).count() == 2


def test_steps_run_on_each_arrival(spark, tmp_path):
    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "Extract 1.csv", ("a", "x"), ("b", "y"))
    master = spark.createDataFrame([], SCHEMA)
    steps = [lambda df, batch_id: df.where("source = 'y'").withColumn("source", F.lit(f"batch {batch_id}"))]
    rows = run(spark, tmp_path, master, steps=steps).collect()
    assert [(r["q_id"], r["source"]) for r in rows] == [("B", "batch 0")]


def test_a_batch_run_again_leaves_the_same_result(spark, tmp_path):
    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "Extract 1.csv", ("a", "x"), ("b", "x"))
    master = spark.createDataFrame([], SCHEMA)
    first = sorted(map(tuple, run(spark, tmp_path, master).collect()))
    # As after a failure before the commit: the same batch is offered again.
    again = stream.stream_files(spark, str(tmp_path / "in"), "Extract", SCHEMA)
    query = stream.stream_intake(
        again, lambda b: master.unionByName(stream.accepted_before(spark, str(tmp_path / "out"), b, SCHEMA)),
        str(tmp_path / "out"), str(tmp_path / "checkpoint2"), "q_id",
    )
    query.awaitTermination()
    out = spark.read.schema("q_id string, source string, batch_id long").parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, out.collect())) == first


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "Extract 1.csv").write_text(
        "q_id,at\n a,2024-01-01 00:00:00\nA,2024-01-01 00:01:00\nb,2024-01-01 00:02:00\n"
    )
    source = stream.stream_files(spark, str(tmp_path / "in"), "Extract", S.T.StructType(
        [S.T.StructField("q_id", S.T.StringType()), S.T.StructField("at", S.T.TimestampType())]
    ))
    seen = stream.first_of_each_key(source, "q_id", "at", "1 hour")
    query = (
        seen.writeStream.format("memory").queryName("seen").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r["q_id"] for r in spark.table("seen").collect()) == ["A", "B"]


def test_folder_tables_stream_like_files(spark, tmp_path):
    """A table of part files gives the rows that the table as one file gives."""
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.repartition(3).write.parquet(f"{tmp_path}/in/orders.parquet")
    arriving = stream.stream_files(spark, f"{tmp_path}/in", "orders", orders.schema, "parquet", ".parquet")
    master = spark.createDataFrame([], "o_orderkey string")
    keyed = arriving.selectExpr("cast(o_orderkey AS string) AS o_orderkey")
    stream.stream_intake(keyed, lambda _: master, f"{tmp_path}/out", f"{tmp_path}/check", "o_orderkey").awaitTermination()
    assert stream.accepted(spark, f"{tmp_path}/out", keyed.schema).count() == orders.count()


def test_nothing_arrived_is_an_empty_frame(spark, tmp_path):
    schema = spark.createDataFrame([], "a string").schema
    assert stream.accepted(spark, f"{tmp_path}/none", schema).count() == 0
