import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinmaster import schema as S
from kinmaster.session import materialise, workspace
from kinmaster.sources import readers, writers


def touch(folder, *names, start=1_700_000_000):
    for i, name in enumerate(names):
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
        os.utime(path, (start + i * 100, start + i * 100))


def test_newest_by_version_and_by_time(spark, tmp_path):
    touch(tmp_path, "Log v1.12.csv", "deep/Log v1.9.csv", "Log.csv", "Other v9.9.csv")
    assert readers.latest_versioned(spark, str(tmp_path), "Log").endswith("Log v1.12.csv")
    # Read as decimals 1.9 is above 1.12.
    assert readers.latest_versioned(spark, str(tmp_path), "Log", "compat").endswith("Log v1.9.csv")
    assert readers.latest_by_time(spark, str(tmp_path), "Log").endswith("Log.csv")


def test_no_file_is_an_error(spark, tmp_path):
    touch(tmp_path, "a.csv")
    with pytest.raises(FileNotFoundError):
        readers.latest_by_time(spark, str(tmp_path), "Log")


def test_file_listing_reads_no_contents(spark, tmp_path):
    touch(tmp_path, "a v1.0.csv")
    plan = readers.list_files(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_only_files_changed_since(spark, tmp_path):
    touch(tmp_path, "a.csv", "b.csv")
    (tmp_path / "a.csv").write_text("v\nold\n")
    (tmp_path / "b.csv").write_text("v\nnew\n")
    os.utime(tmp_path / "a.csv", (1_600_000_000, 1_600_000_000))
    os.utime(tmp_path / "b.csv", (1_700_000_000, 1_700_000_000))
    rows = readers.read_since(spark, f"{tmp_path}/*.csv", "2022-01-01T00:00:00", S.text_schema("v")).collect()
    assert [r["v"] for r in rows] == ["new"]


def test_csv_keeps_zeros_quotes_and_line_breaks(spark, tmp_path):
    rows = [("00123", 'say "hi", ok', " padded "), ("1", "a\nb", None)]
    df = spark.createDataFrame(rows, "zip string, text string, c string")
    path = writers.write_table(df, str(tmp_path / "out.csv"))
    back = readers.read_table(spark, path, df.schema, multiline=True)
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    with pytest.raises(ValueError):
        readers.read_table(spark, path)


def test_encoding(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("v\ncafé\n".encode("latin-1"))
    out = readers.read_table(spark, f"{tmp_path}/l.csv", S.text_schema("v"), "ISO-8859-1").first()
    assert out["v"] == "café"


def test_runs_are_kept_next_to_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_table(spark.range(3), path, run_id="20240101")
    writers.write_table(spark.range(5), path, run_id="20240102")
    counts = {r["run_id"]: r["count"] for r in spark.read.parquet(path).groupBy("run_id").count().collect()}
    assert counts == {20240101: 3, 20240102: 5}
    with pytest.raises(Exception, match="already exists"):
        writers.write_table(spark.range(1), path, run_id="20240101")


def test_sets_and_versions(spark, tmp_path):
    root = str(tmp_path)
    first = writers.next_version(spark, root, "All Sources ")
    assert first.endswith("All Sources v1.0")
    writers.write_set({"all": spark.range(2), "new": spark.range(1)}, first)
    (tmp_path / "All Sources v1.9").mkdir()
    assert writers.next_version(spark, root, "All Sources ").endswith("v1.10")
    assert writers.next_version(spark, root, "All Sources ", "compat").endswith("v1.91")
    assert {k: v.count() for k, v in writers.read_set(spark, first, "all", "new").items()} == {"all": 2, "new": 1}


def test_run_log_grows(spark, tmp_path):
    row = spark.range(1).select(F.lit("t").alias("run_time"))
    for _ in range(2):
        writers.append_run_log(row, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_intermediate_tables_go_where_the_session_says(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    folder = workspace(spark)
    assert folder.endswith(spark.sparkContext.applicationId)
    assert shared is None or folder.startswith(shared.rstrip("/"))
    assert materialise(spark.range(3), "t").count() == 3
    assert any(Path(folder.removeprefix("file:")).rglob("*.parquet"))


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(Session())
