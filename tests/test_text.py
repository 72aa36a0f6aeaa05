import pytest
from pyspark.sql import functions as F

from kinmaster.functions import text as X


def values(spark, rows, *columns):
    df = spark.createDataFrame([(r,) for r in rows], "v string")
    return [tuple(r) if len(columns) > 1 else r[0] for r in df.select(*columns).collect()]


def test_missing_keys_equal_each_other_only_in_compat(spark):
    v = F.col("v")
    rows = values(spark, [" ab1 ", None, "", "nan"], X.normalise_key(v), X.normalise_key(v, "strict"))
    assert rows == [("AB1", "AB1"), ("NAN", None), ("", None), ("NAN", "NAN")]


def test_unknown_mode_is_refused():
    with pytest.raises(ValueError):
        X.normalise_key(F.lit("a"), "other")


def test_ascii(spark):
    rows = ["Crème Brûlée", "Straße ẞ Ærø Œuvre", "Łódź İstanbul Þór", "“x” — ‘y’…", "中文", None]
    assert values(spark, rows, X.to_ascii(F.col("v"))) == [
        "Creme Brulee", "Strasse Ss AEro OEuvre", "Lodz Istanbul Thor", "\"x\" -- 'y'...", "中文", None,
    ]


def test_dedup_cleaning_collapses_before_newlines_become_spaces(spark):
    rows = ["  A  b\n c ", '"Quoted"', "'x'", "  ", None, "ẞ", "ŒUF Straße", "a \n b"]
    assert values(spark, rows, X.normalise_text(F.col("v"))) == [
        "a b  c", "quoted", "x", None, None, "ss", "oeuf strasse", "a   b",
    ]


def test_link_cleaning(spark):
    v = F.col("v")
    rows = ["O'Neil-Main/St. 5,Apt:2\n x", "A , b", None, " . ", "x — y…z’s", "Æble/Ø"]
    assert values(spark, rows, X.normalise_link_text(v)) == [
        "oneil main st 5 apt 2 x", "a b", "", "", "x y zs", "aeble o",
    ]
    assert values(spark, ["1 Main St,Apt 2", "A , b"], X.normalise_link_text(v, comma="")) == ["1 main stapt 2", "a b"]


def test_zip_is_padded_and_never_cut(spark):
    v = F.col("v")
    rows = values(
        spark, ["1234", "12345-6789", "123456", "", None, "-99"], X.normalise_zip(v), X.normalise_zip(v, "compat")
    )
    assert rows == [
        ("01234", "01234"), ("12345", "12345"), ("123456", "123456"), (None, "00000"), (None, "00000"), (None, "00000"),
    ]


def test_pending_and_blank(spark):
    rows = values(spark, ["pending", "is pending!", "Pending", "", None, "X1"], X.is_pending(F.col("v")))
    assert rows == [True, True, False, True, True, False]


def test_versions(spark):
    major, minor = X.version_parts(F.col("v"))
    rows = values(
        spark, ["/a/Log v1.9.csv", "/v3.4/Log v1.12 - x.csv", "/v3.4/Log.csv"], major, minor, X.version_of(F.col("v"))
    )
    assert rows == [(1, 9, 1.9), (1, 12, 3.4), (0, 0, 3.4)]


def test_ids(spark):
    df = spark.createDataFrame([(7,), (12345678,)], "n bigint")
    made = df.select(X.format_id(F.col("n")).alias("id"))
    assert [r[0] for r in made.collect()] == ["EMUSHCO0000007", "EMUSHCO12345678"]
    assert [r[0] for r in made.select(X.id_number(F.col("id"))).collect()] == [7, 12345678]
    assert values(spark, ["EMUSHCO", "x", None], X.id_number(F.col("v"))) == [None, None, None]


def test_address_line_has_blanks_for_missing_parts(spark):
    df = spark.createDataFrame([("1 Main", None, "NY", None)], "a string, b string, c string, d string")
    line = X.address_line(*[F.col(c) for c in "abcd"])
    assert df.select(line).first()[0] == "1 Main, , NY "
