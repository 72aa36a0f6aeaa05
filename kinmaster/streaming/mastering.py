"""Intake, deduplication and identity for each arriving extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from kinmaster.plans.mastering import canonical, master_accounts
from kinmaster.sources.writers import write_set

ADDED = ("cluster_id", "confidence_score", "net_new", "new_account")


def _batches(spark: SparkSession, sink: str) -> list[int]:
    """Batches the sink already holds completely."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(sink)
    system = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    done = [int(n.removeprefix("batch_id=")) for n in names if n.startswith("batch_id=")]
    return sorted(b for b in done if system.exists(hadoop.Path(f"{sink}/batch_id={b}/all_accounts/_SUCCESS")))


def current_master(spark: SparkSession, initial: DataFrame, sink: str, batch_id: int) -> DataFrame:
    """The accounts after the last batch before ``batch_id``."""
    before = [b for b in _batches(spark, sink) if b < batch_id]
    if not before:
        return canonical(initial)
    accounts = spark.read.parquet(f"{sink.rstrip('/')}/batch_id={before[-1]}/all_accounts")
    return accounts.drop(*ADDED)


def master_stream(
    source: DataFrame, master: DataFrame, second: DataFrame, sink: str, checkpoint: str, order: Sequence[str],
    *, interval: str | None = None, **options,
) -> StreamingQuery:
    """Run the three stages on each arrival and write a table set per batch.

    Each batch starts from the accounts the last one left, so IDs once given
    are read back and never worked out again. A batch run again overwrites its
    own set from the same start. One query must own the sink: it is the only
    writer of IDs.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        known = current_master(batch.sparkSession, master, sink, batch_id)
        tables = master_accounts(batch, known, second, order, **options)
        # ``all_accounts`` last: its presence marks the batch as complete.
        rest = {name: df for name, df in tables.items() if name != "all_accounts"}
        root = f"{sink.rstrip('/')}/batch_id={batch_id}"
        write_set({**rest, "all_accounts": tables["all_accounts"]}, root, mode="overwrite")

    writer = source.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()
