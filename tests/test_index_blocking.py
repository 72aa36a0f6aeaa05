"""Cosine join over weighted tokens against all pairs."""

import math
import random
from collections import Counter
from pathlib import Path

import pytest

from kinmaster.operators import index_blocking as index
from kinmaster.session import workspace


def brute(rows, threshold):
    sets = {i: set(t) for i, t in rows if t}
    df = Counter(t for s in sets.values() for t in s)
    weight = {t: math.floor(math.log(1 + len(sets) / n) * index.PARTS + 0.5) for t, n in df.items()}
    classes = {}
    for i in sorted(sets):
        classes.setdefault(frozenset(sets[i]), i)
    out = {}
    for s, i in classes.items():
        for r, j in classes.items():
            if i < j:
                norm = [math.sqrt(sum(weight[t] ** 2 for t in x)) for x in (s, r)]
                cosine = sum(weight[t] ** 2 for t in s & r) / (norm[0] * norm[1])
                if round(cosine, 6) >= threshold:
                    out[i, j] = round(cosine, 6)
    return out, {i: classes[frozenset(s)] for i, s in sets.items()}


def rows_of(seed, n=150):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            tokens = set(rng.choice(rows)[1]) ^ set(rng.choices(range(40), k=rng.randrange(3)))
        else:
            tokens = {int(rng.expovariate(0.05)) for _ in range(rng.randrange(1, 15))}
        rows.append((i, sorted(tokens)))
    return rows + [(n, []), (n + 1, None), (n + 2, [7]), (n + 3, [7])]


@pytest.mark.parametrize("seed, threshold", [(1, 0.3), (2, 0.7), (3, 0.95), (4, 1.0), (5, 0.05)])
def test_equals_all_pairs(spark, seed, threshold):
    rows = rows_of(seed)
    pairs, members = index.similar_sets(spark.createDataFrame(rows, "record_id long, tokens array<long>"), threshold)
    want, classes = brute(rows, threshold)
    assert {(r[0], r[1]): r[2] for r in pairs.collect()} == want
    assert {r[0]: r[1] for r in members.collect()} == classes


def test_frequent_tokens_bring_nobody_together(spark):
    # A token of all and one of each own: the shared one is beyond every prefix.
    rows = [(i, [0, 1000 + i]) for i in range(500)]
    classes, _ = index.token_classes(spark.createDataFrame(rows, "record_id long, tokens array<long>"))
    weighted, lone = index.weighted_tokens(classes)
    keys = index.prefixes(weighted, 0.5).collect()
    assert len(keys) == 500 and all(r["code"] <= lone for r in keys)


def test_keys_join_similar_classes(spark):
    rows = [(1, [1, 2, 3, 4]), (2, [1, 2, 3, 5]), (3, [1, 2, 3, 4]), (4, [9])]
    pairs, members = index.similar_sets(spark.createDataFrame(rows, "record_id long, tokens array<long>"), 0.3)
    keys = {r["record_id"]: set(r["keys"]) for r in index.index_keys(members, pairs).collect()}
    assert keys[1] & keys[2] and keys[1] == keys[3] and not keys[4] & (keys[1] | keys[2])


def test_empty(spark):
    pairs, members = index.similar_sets(spark.createDataFrame([], "record_id long, tokens array<long>"), 0.5)
    assert pairs.count() == 0 and members.count() == 0


def test_sets_go_to_groups_of_pairs(spark):
    def written():
        return {e for e in Path(workspace(spark)).iterdir() if e.name.startswith("pairs-")}

    # All share the token "all"; the first two have the rare ones in common as well.
    rows = [(0, ["all", "x", "y", "z"]), (1, ["all", "x", "y", "w"])] + [(i, ["all", f"a{i}", f"b{i}"]) for i in range(2, 40)]
    records = spark.createDataFrame(rows, "record_id long, words array<string>").selectExpr(
        "record_id", "transform(words, w -> xxhash64(w)) AS tokens"
    )
    before = written()
    found = index.similar_sets(records, 0.5)[0].collect()
    assert [(r["left_id"], r["right_id"]) for r in found] == [(0, 1)]
    (table,) = written() - before
    pairs = spark.read.parquet(str(table))
    assert pairs.columns == ["left_id", "right_id", "key"] and pairs.count() == 1


def test_whole_sets_are_sent_where_prefixes_allow_it(spark):
    def written():
        return {e for e in Path(workspace(spark)).iterdir() if e.name.startswith("pairs-")}

    # One rare token of ten in common, the rarest but for those of one set alone: they meet, and their prefixes say no.
    rows = [(i, [100 + 10 * i + j for j in range(9)] + [50]) for i in (0, 1)] + [(i, [100 + 10 * (i - 2) + j for j in range(9)] + [1000 + i]) for i in (2, 3)]
    before = written()
    found = {(r[0], r[1]): r[2] for r in index.similar_sets(spark.createDataFrame(rows, "record_id long, tokens array<long>"), 0.7)[0].collect()}
    assert found == brute(rows, 0.7)[0]
    (table,) = written() - before
    assert spark.read.parquet(str(table)).where("left_id = 0 AND right_id = 1").isEmpty()


def test_codes_of_frequent_tokens(spark, monkeypatch):
    rows = rows_of(7)
    classes, _ = index.token_classes(spark.createDataFrame(rows, "record_id long, tokens array<long>"))
    want = {r["class_id"]: r["codes"] for r in index.weighted_tokens(classes)[0].collect()}
    monkeypatch.setattr(index, "MOST_FREQUENT", 3)
    assert {r["class_id"]: r["codes"] for r in index.weighted_tokens(classes)[0].collect()} == want
