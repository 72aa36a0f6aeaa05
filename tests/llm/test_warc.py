"""Archives: round trip, revisits, and what is salvaged from damaged files."""

import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kinmaster.llm import warc

SCHEMA = "page_id bigint, url string, html string"


def written(spark, tmp_path, rows, schema=SCHEMA, **options):
    path = str(tmp_path / "archive")
    warc.write_warc(spark.createDataFrame(rows, schema), path, **options)
    return path


def joined_file(path):
    """All members in one file, as bytes."""
    from pathlib import Path

    return b"".join(p.read_bytes() for p in sorted(Path(path).glob("part-*")))


def read_bytes(spark, tmp_path, data, name="x.warc", compressed=True):
    folder = tmp_path / f"damaged-{random.getrandbits(60)}"
    folder.mkdir()
    (folder / name).write_bytes(data)
    return warc.read_warc(spark, str(folder), compressed=compressed).collect()


def test_round_trip(spark, tmp_path):
    long, big = "ä" * 500, "x" * 3_000_000
    rows = [(1, "http://a/ b\r\nX: y", long), (2, None, long), (3, "http://c/", long), (4, "u", "short"), (5, "u", "short"),
            (6, "u", None), (7, "u", ""), (None, "u", long), (8, "u", big), (3, "again", long), (9, "u", "\r\n\r\nWARC/1.1\r\n\x1f"), (9, "u", "y" * 999)]
    got = warc.read_warc(spark, written(spark, tmp_path, rows)).collect()
    assert len(got) == len(rows) and not any(r["reason"] for r in got)
    by = sorted((r["record_id"], r["record_type"], r["refers_to"] or "", r["payload_bytes"]) for r in got)
    assert by == sorted([
        ("1", "revisit", "3", 1000), ("2", "revisit", "3", 1000), ("3", "response", "", 1000), ("3", "response", "", 1000),
        ("4", "response", "", 5), ("5", "response", "", 5), ("6", "response", "", 0), ("7", "response", "", 0),
        ("", "revisit", "3", 1000), ("8", "response", "", 3_000_000), ("9", "response", "", 15), ("9", "response", "", 999),
    ])
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha1(r["payload"]).hexdigest() == r["payload_digest"] and len(r["payload"]) == r["payload_bytes"]
        else:
            assert r["payload_digest"] == hashlib.sha1(long.encode()).hexdigest() and r["payload"] is None
    assert {r["target_uri"] for r in got if r["record_id"] in ("1", "2")} == {"http://a/%20b%0D%0AX:%20y", None}


def test_files_are_members_any_reader_reads(spark, tmp_path):
    path = written(spark, tmp_path, [(i, f"u{i}", f"page {i}") for i in range(50)])
    data = gzip.decompress(joined_file(path))
    assert data.count(b"WARC/1.1\r\n") == 50 and data.endswith(b"\r\n\r\n")


def test_empty_and_clashing_columns(spark, tmp_path):
    path = written(spark, tmp_path, [])
    assert warc.read_warc(spark, path).count() == 0
    odd = spark.createDataFrame([(1, "u", "h" * 2000, "a", 1, b"p"), (2, "u", "h" * 2000, "b", 2, b"q")],
                                SCHEMA + ", digest string, stored int, payload binary")
    warc.write_warc(odd, str(tmp_path / "odd"))
    assert {r["record_type"] for r in warc.read_warc(spark, str(tmp_path / "odd")).collect()} == {"response", "revisit"}


def members(n=40):
    rng = random.Random(7)
    out = []
    for i in range(n):
        payload = bytes(rng.choices(b"abcdef <>\r\n", k=rng.randrange(2000))) + rng.randbytes(50)
        out.append(warc.member(warc.record_bytes(str(i), f"http://h/{i}", payload, None, "2000-01-01T00:00:00Z")))
    return out


def whole(rows, size):
    """Records and gaps cover the file without overlap."""
    spans = sorted({(r["offset"], r["length"]) for r in rows})
    at = 0
    for offset, length in spans:
        assert offset == at
        at += length
    assert at == size


@pytest.mark.parametrize("name", ["x.warc", "x.warc.gz"])
def test_salvage_of_members(spark, tmp_path, name):
    parts = members()
    broken = list(parts)
    broken[3] = parts[3][:60] + bytes(40) + parts[3][100:]  # overwritten bytes
    broken[10] = parts[10][:-20]  # cut
    broken[11] = b""  # lost
    broken[20] = parts[20] + b"junk after a member"
    broken[30] = parts[30][:5] + parts[30][6:]  # a byte less
    broken[39] = parts[39][:-1]  # cut at the end
    data = b"noise" + b"".join(broken)
    rows = read_bytes(spark, tmp_path, data, name)
    kept = {int(r["record_id"]) for r in rows if r["reason"] is None}
    assert kept == set(range(40)) - {3, 10, 11, 30, 39}
    whole(rows, len(data))
    lost = {(r["offset"], r["length"]) for r in rows if r["reason"]}
    starts = [5]
    for b in broken:
        starts.append(starts[-1] + len(b))
    assert (0, 5) in lost and (starts[3], len(broken[3])) in lost and (starts[21] - 19, 19) in lost
    assert (starts[39], len(broken[39])) in lost


def test_false_beginnings_inside_members(spark, tmp_path):
    # Stored, not compressed: the magic bytes and whole members stand inside a member.
    inner = members(3)
    record = warc.record_bytes("outer", "u", b"".join(inner) + warc.MEMBER * 5, None, "2000-01-01T00:00:00Z")
    packer = zlib.compressobj(level=0, wbits=31)
    stored = packer.compress(record) + packer.flush()
    data = inner[0] + stored + inner[1]
    rows = read_bytes(spark, tmp_path, data)
    assert [r["record_id"] for r in rows] == ["0", "outer", "1"]
    whole(rows, len(data))


def test_plain_records(spark, tmp_path):
    bodies = [f"text {i} ".encode() * 30 for i in range(12)]
    bodies[4] = b"a page on WARC/1.1\r\nand WARC/1.0 " + warc.record_bytes("inner", "u", b"x", None, "2000-01-01T00:00:00Z")
    parts = [warc.record_bytes(str(i), "u", b, None, "2000-01-01T00:00:00Z") for i, b in enumerate(bodies)]
    rows = read_bytes(spark, tmp_path, b"".join(parts), compressed=False)
    assert [r["record_id"] for r in rows] == [str(i) for i in range(12)]
    parts[2] = parts[2][:-30]  # cut: its length reaches into the next record
    parts[6] = parts[6].replace(b"text 6", b"tExt 6", 1)  # digest
    parts[8] = parts[8].replace(b"Content-Length: ", b"Content-Length: 99999999999", 2)
    parts[9] = b"\r\n\r\nlost" + parts[9]
    data = b"".join(parts)
    rows = read_bytes(spark, tmp_path, data, compressed=False)
    assert {r["record_id"] for r in rows if r["reason"] is None} == {"0", "1", "3", "4", "5", "7", "9", "10", "11"}
    whole(rows, len(data))
    assert {r["reason"] for r in rows if r["reason"]} >= {"block digest differs", "longer than the file", "length does not fit"}


def test_files_cut_into_many_splits(spark, tmp_path):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    try:
        parts = members(60)
        parts[7] = parts[7][:30]
        data = b"".join(parts)
        rows = read_bytes(spark, tmp_path, data)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {int(r["record_id"]) for r in rows if r["reason"] is None} == set(range(60)) - {7}
    whole(rows, len(data))


def test_hot_payload_spreads(spark, tmp_path):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 > 0, F.lit("z" * 1500)).otherwise(F.concat(F.lit("q" * 1200), F.col("id").cast("string"))).alias("html"))
    path = str(tmp_path / "hot")
    warc.write_warc(pages, path)
    got = warc.records(warc.read_warc(spark, path, with_payload=False))
    assert got.where("record_type = 'revisit'").count() == 1999
    assert [r["refers_to"] for r in got.where("record_type = 'revisit'").select("refers_to").distinct().collect()] == ["2999"]
