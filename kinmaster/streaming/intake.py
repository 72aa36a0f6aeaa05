"""Processing extract files as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kinmaster.functions.text import normalise_key
from kinmaster.operators.intake import new_records

POLL_INTERVAL = "5 seconds"


def stream_files(
    spark: SparkSession, path: str, prefix: str, schema: T.StructType, file_format: str = "csv", suffix: str = "*",
) -> DataFrame:
    """A stream of the rows of new tables whose name starts with ``prefix``.

    A table is a file in ``path``, or a folder of part files there: if there are
    such folders when the stream begins, it reads the part files that arrive in them.
    """
    context = spark.sparkContext
    glob = context._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{prefix}{suffix}")
    found = glob.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(glob) or []
    reader = spark.readStream.schema(schema)
    if file_format == "csv":
        reader = reader.option("header", True)
    if any(status.isDirectory() for status in found):
        return reader.format(file_format).load(glob.toString())
    return reader.option("pathGlobFilter", f"{prefix}{suffix}").format(file_format).load(path)


def first_of_each_key(stream: DataFrame, key: str, event_time: str, delay: str, mode: str = "compat") -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of each other."""
    keyed = stream.withColumn(key, normalise_key(F.col(key), mode))
    return keyed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def stream_intake(
    source: DataFrame,
    master: Callable[[int], DataFrame],
    sink: str,
    checkpoint: str,
    key: str,
    *,
    steps: Sequence[Callable[[DataFrame, int], DataFrame]] = (),
    mode: str = "compat",
    interval: str | None = None,
) -> StreamingQuery:
    """For each arrival keep the new records, run ``steps`` on them, write them.

    ``master(batch_id)`` gives the records known before that batch; it should
    include what earlier batches wrote (``accepted_before``). Each batch owns
    one folder of the sink and overwrites it, so a batch that is run again
    after a failure leaves the same result. Without ``interval`` all files
    present are processed and the query ends; with it the folder is polled.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        out = new_records(batch, master(batch_id), key, mode)
        for step in steps:
            out = step(out, batch_id)
        out.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def accepted(spark: SparkSession, sink: str, schema: T.StructType) -> DataFrame:
    """All rows written to the sink; none, with the schema, if nothing has arrived yet."""
    return accepted_before(spark, sink, 1 << 62, schema)


def accepted_before(spark: SparkSession, sink: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """Rows the batches before ``batch_id`` wrote to the sink."""
    empty = spark.createDataFrame([], schema)
    if batch_id == 0:
        return empty
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sink)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return empty
    with_batch = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(with_batch).parquet(sink).where(F.col("batch_id") < batch_id).drop("batch_id")
