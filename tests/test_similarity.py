import random

from pyspark.sql import functions as F

from kinmaster.functions.similarity import common_subsequence, edit_similarity, ratio_percent, string_ratio


def table_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last, row = row, [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
    return row[-1]


def test_common_subsequence_equals_the_table_method():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ("".join(rng.choice("abcd é") for _ in range(rng.randint(0, 90))) for _ in "ab")
        assert common_subsequence(a, b) == table_lcs(a, b)
        assert common_subsequence(a, b) == common_subsequence(b, a)
        assert 0 <= ratio_percent(a, b) <= 100


def test_percent_rounds_halves_to_even():
    assert ratio_percent("", "") == 100
    assert ratio_percent("a", "") == 0
    # 2 * 1 / 16 is 12.5 percent, 2 * 3 / 16 is 37.5 percent.
    assert ratio_percent("a", "a" + "b" * 14) == 12
    assert ratio_percent("aaa", "aaa" + "b" * 10) == 38


def test_ratio_ignores_case_and_keeps_missing(spark):
    rows = [("Acme", "ACME"), ("abc", None), (None, None), ("abcd", "bcde"), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(string_ratio(F.col("a"), F.col("b"))).collect()] == [1.0, None, None, 0.75, 1.0]


def test_edit_similarity(spark):
    df = spark.createDataFrame([("kitten", "sitting"), ("", ""), ("a", "")], "a string, b string")
    got = [round(r[0], 4) for r in df.select(edit_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5714, 1.0, 0.0]
