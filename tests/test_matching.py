"""Blocking, clustering and linkage against brute force on small fixtures."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kinmaster.operators import blocking, clustering, linkage, records, scoring
from kinmaster.operators.pair_model import PairModel
from kinmaster.plans import queries, roles
from kinmaster.schema import FieldSpec
from kinmaster.session import materialise, release, workspace

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Many small plans: running them is quicker than compiling them."""
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.shuffle.partitions": "3"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


FIELDS = (FieldSpec("text", "text", weight=0.8), FieldSpec("lang", "exact", has_missing=True, weight=0.2))
THRESHOLD = 0.6


def make_texts(seed, n, words=14, vocabulary=400):
    """A third near copies of one text, some exact copies, the rest unrelated."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, vocabulary)}" for _ in range(words)]
    rows = []
    for i in range(n):
        kind = i % 6
        if kind in (0, 1):
            text = base[:]
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(words)] = f"w{rng.randint(0, vocabulary)}"
        elif kind == 2 and rows:
            text = rng.choice(rows)[1].split()
        else:
            text = [f"w{rng.randint(0, vocabulary if kind == 3 else 25)}" for _ in range(rng.randint(0, words))]
        rows.append((i, " ".join(text), rng.choice(["en", "en", "fr", None])))
    return rows


def prepared(spark, rows, rules=None):
    df = spark.createDataFrame(rows, "id bigint, text string, lang string")
    # One key per record that a third of them and more have in common.
    rules = rules or {"first": blocking.rule_first_chars("text", 1), "phrases": blocking.rule_phrases("text", 2, 3)}
    return records.prepare_records(df, "id", FIELDS, rules)


def jaccard(a, b):
    a, b = set(a.split()), set(b.split())
    return len(a & b) / len(a | b) if a and b else 0.0


def score(a, b):
    gained, counted = round(jaccard(a[1], b[1]), 6) * 0.8, 0.8
    if a[2] and b[2]:
        gained, counted = gained + 0.2 * (a[2] == b[2]), 1.0
    return round(gained / counted, 6)


def brute_pairs(rows):
    """Every pair similar enough (all texts here share the first-letter key)."""
    out = {}
    for i, a in enumerate(rows):
        for b in rows[i + 1 :]:
            if a[1] and b[1] and jaccard(a[1], b[1]) >= THRESHOLD:
                out[a[0], b[0]] = score(a, b)
    return out


def brute_components(rows, pairs, cut):
    top = {r[0]: r[0] for r in rows}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for (a, b), s in pairs.items():
        if s >= cut:
            a, b = sorted((root(a), root(b)))
            top[b] = a
    return {r[0]: root(r[0]) for r in rows}


@pytest.mark.parametrize("limit,frequent", [(10_000, 1000), (5, 8), (1, 0)])
def test_candidates_are_exactly_the_similar_pairs(spark, limit, frequent):
    rows = make_texts(limit, 150)
    found = blocking.candidate_pairs(prepared(spark, rows), FIELDS, THRESHOLD, frequent, limit).collect()
    got = {(r["left_id"], r["right_id"]): r["score"] for r in found}
    assert len(got) == len(found)
    assert got == pytest.approx(brute_pairs(rows), abs=2e-6)


@pytest.mark.parametrize("threshold", [0.51, 0.8, 1.0])
def test_signatures_lose_nothing_at_any_threshold(spark, threshold):
    rows = make_texts(int(threshold * 100), 120, words=30)
    rec = prepared(spark, rows)
    found = blocking.candidate_pairs(rec, FIELDS, threshold, 5, 2).collect()
    want = {
        (a[0], b[0]) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[1] and jaccard(a[1], b[1]) >= threshold
    }
    assert {(r["left_id"], r["right_id"]) for r in found} == want


def test_a_low_threshold_is_refused(spark):
    with pytest.raises(ValueError):
        blocking.signatures(spark.createDataFrame([(1, [1])], "record_id int, tokens array<bigint>"), 0.5)


def test_no_shared_key_no_pair(spark):
    rows = [(1, "a b c", "en"), (2, "a b c", "en"), (3, "b c a", "en")]
    rec = prepared(spark, rows, {"first": blocking.rule_first_token("text")})
    found = blocking.candidate_pairs(rec, FIELDS, THRESHOLD).collect()
    assert [(r["left_id"], r["right_id"]) for r in found] == [(1, 2)]


@pytest.mark.parametrize("limit,frequent", [(10_000, 1000), (5, 3), (1, 0)])
def test_clusters_equal_components_of_all_matches(spark, limit, frequent):
    rows = make_texts(limit + frequent, 150)
    cut = 0.5 if limit == 5 else 0.75
    clusters, _, _ = clustering.cluster_records(prepared(spark, rows), FIELDS, THRESHOLD, cut, frequent, limit)
    got = {r["record_id"]: r["component"] for r in clusters.collect()}
    assert got == brute_components(rows, brute_pairs(rows), cut)


def test_clusters_do_not_depend_on_partitioning(spark):
    rows = make_texts(3, 90)
    first = clustering.cluster_records(prepared(spark, rows), FIELDS, THRESHOLD)[0].collect()
    shuffled = rows[::-1]
    second = clustering.cluster_records(prepared(spark, shuffled), FIELDS, THRESHOLD, limit=5)[0].collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))


def test_a_family_of_copies_costs_one_comparison_each(spark):
    """A third exact copies and a third near copies of one record."""
    near = [(i, f"{' '.join(f's{k}' for k in range(30))} n{i}", "en") for i in range(300)]
    rows = near + [(1000 + i, near[0][1], "en") for i in range(300)] + [
        (2000 + i, " ".join(f"r{i}_{k}" for k in range(20)), "en") for i in range(300)
    ]
    rec = prepared(spark, rows, {"start": blocking.rule_first_chars("text", 1)})
    reps, copies = records.collapse_copies(rec, FIELDS)
    assert reps.count() == 600 and copies.count() == 900
    links = clustering.spanning_links(reps, FIELDS, THRESHOLD, 0.5, limit=50)
    assert links.count() == 299
    clusters = clustering.cluster_records(rec, FIELDS, THRESHOLD, limit=50)[0]
    sizes = clusters.groupBy("component").count().orderBy(F.desc("count")).collect()
    assert sizes[0]["count"] == 600 and len(sizes) == 301


def test_several_families_in_one_block(spark, monkeypatch):
    """Families other than the first record's are not compared pair by pair either."""
    rows = [
        (100 * f + i, f"s {' '.join(f'f{f}w{k}' for k in range(25))} n{f}x{i}", "en") for f in range(3) for i in range(90)
    ]
    compared = []
    true_compare = clustering.compare

    def counting(pairs, *args):
        compared.append(pairs.count())
        return true_compare(pairs, *args)

    monkeypatch.setattr(clustering, "compare", counting)
    rec = prepared(spark, rows, {"start": blocking.rule_first_chars("text", 1)})
    clusters, _, _ = clustering.cluster_records(rec, FIELDS, THRESHOLD, 0.5, frequent=1000, limit=30)
    got = {r["record_id"]: r["component"] for r in clusters.collect()}
    assert got == {r[0]: r[0] // 100 * 100 for r in rows}
    # All pairs within the families would be 12,015.
    assert sum(compared) < 4 * len(rows)


def test_components_of_chains_and_lone_records(spark):
    rng = random.Random(5)
    ids = list(range(400))
    rng.shuffle(ids)
    chain = list(zip(ids[:200], ids[1:201]))
    ring = list(zip(ids[210:300], ids[211:301])) + [(ids[300], ids[210])]
    star = [(ids[310], x) for x in ids[311:380]]
    edges = spark.createDataFrame(chain + ring + star + [(ids[390], ids[390])], "left_id int, right_id int")
    nodes = spark.createDataFrame([(i,) for i in ids], "record_id int")
    got = {r["record_id"]: r["component"] for r in clustering.connected_components(nodes, edges).collect()}
    want = brute_components([(i,) for i in ids], {e: 1.0 for e in chain + ring + star}, 0.5)
    assert got == want


def test_confidence_formula(spark):
    rows = make_texts(8, 90)
    pairs = brute_pairs(rows)
    reps, copies = records.collapse_copies(prepared(spark, rows), FIELDS)
    scored = blocking.candidate_pairs(reps, FIELDS, THRESHOLD)
    clusters, _, _ = clustering.cluster_records(prepared(spark, rows), FIELDS, THRESHOLD, 0.5)
    got = {r["record_id"]: r["confidence_score"] for r in clustering.cluster_confidence(clusters, scored, copies, reps).collect()}
    component = brute_components(rows, pairs, 0.5)
    for i, c in component.items():
        mates = [j for j in component if component[j] == c and j != i]
        total = sum((1 - pairs.get((min(i, j), max(i, j)), 0.0)) ** 2 for j in mates)
        want = 1 - (total / len(mates)) ** 0.5 if mates else 1.0
        assert got[i] == pytest.approx(want, abs=2e-6)


def test_confidence_against_the_lowest_record(spark):
    rows = make_texts(9, 90)
    by_id = {r[0]: r for r in rows}
    clusters, reps, copies = clustering.cluster_records(prepared(spark, rows), FIELDS, THRESHOLD, 0.5)
    out = clustering.representative_confidence(clusters, reps, copies, FIELDS).collect()
    assert len(out) == len(rows)
    for r in out:
        own = r["record_id"] == r["component"]
        want = 1.0 if own else score(by_id[r["component"]], by_id[r["record_id"]])
        assert r["confidence_score"] == pytest.approx(want, abs=2e-6)


def test_cluster_output_numbers_from_zero(spark):
    clusters = spark.createDataFrame([(1, 1, 1.0), (2, 1, 0.9), (5, 5, 1.0)], "record_id int, component int, confidence_score double")
    accounts = spark.createDataFrame([(1, "a"), (2, "b"), (5, "c"), (9, "not clustered")], "n int, v string")
    out = clustering.cluster_output(accounts, clusters, "n")
    assert out.columns == ["cluster_id", "confidence_score", "n", "v"]
    assert sorted(map(tuple, out.collect())) == [(0, 0.9, 2, "b"), (0, 1.0, 1, "a"), (1, 1.0, 5, "c")]


@pytest.mark.parametrize("limit,frequent", [(10_000, 1000), (1, 2)])
def test_links_equal_brute_force(spark, limit, frequent):
    left = make_texts(1, 70)
    right = [(i + 20, t, g) for i, t, g in make_texts(1, 120)[30:]]
    out = linkage.link_records(prepared(spark, left), prepared(spark, right), FIELDS, THRESHOLD, 0.1, frequent, limit)
    want = {}
    for a in left:
        scores = [(-score(a, b), b[0]) for b in right if a[1] and b[1] and jaccard(a[1], b[1]) >= THRESHOLD]
        if scores:
            want[a[0]] = (min(scores)[1], -min(scores)[0])
    got = {r["left_id"]: (r["right_id"], pytest.approx(r["score"], abs=2e-6)) for r in out.collect()}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    assert all(got[k][1] == want[k][1] for k in want)


def test_several_left_rows_on_one_right_row(spark):
    links = spark.createDataFrame([(1, 10, 0.9), (2, 10, 0.9), (3, 10, 0.4), (4, 11, 0.2)], "left_id int, right_id int, score double")
    assert sorted(map(tuple, linkage.resolve_right(links).collect())) == [(1, 10, 0.9), (4, 11, 0.2)]
    left = spark.createDataFrame([(i, f"l{i}") for i in (1, 2, 3, 4, 5)], "k int, v string")
    right = spark.createDataFrame([(i, f"r{i}") for i in (10, 11, 12)], "k int, v string")
    linked = linkage.link_output(left, right, links, "k", "k")
    marks = {(r["source_file"], r["k"]): (r["cluster_id"], r["link_score"]) for r in linked.collect()}
    assert marks == {
        (0, 1): (0, 0.9), (0, 2): (1, 0.9), (0, 3): (2, 0.4), (0, 4): (3, 0.2), (0, 5): (None, None),
        (1, 10): (0, 0.9), (1, 11): (3, 0.2), (1, 12): (None, None),
    }
    pairs = linkage.pair_horizontal(linked)
    assert sorted((r["SFDC_k"], r["ExFactory_k"]) for r in pairs.collect()) == [(1, 10), (4, 11)]
    ordered = [r["cluster_id"] for r in linkage.by_group_size(linked, "cluster_id").collect()]
    assert ordered == [0, 0, 3, 3, 1, 2]


def test_rules(spark):
    rows = [(1, "acme pharma", "boston", "02139"), (2, "acmee pharma", "boston", ""), (3, None, "boston", "02144")]
    df = spark.createDataFrame(rows, "id int, name string, city string, zip string")
    rules = {
        "exact": blocking.rule_exact("city"), "sound": blocking.rule_soundex("name"),
        "sorted": blocking.rule_sorted_tokens("name"), "zip": blocking.rule_zip_and_name("zip", "name"),
        "both": blocking.rule_both(blocking.rule_first_chars("name", 4), blocking.rule_exact("city")),
        "first": blocking.rule_first_token("name"), "phrases": blocking.rule_phrases("name"),
    }
    keys = {(r["record_id"], r["rule"]): r["key"] for r in blocking.block_keys(df, "id", rules).collect()}
    assert keys[1, "sound"] == keys[2, "sound"]
    assert keys[1, "both"] == keys[2, "both"] == "acme|boston"
    assert keys[1, "zip"] == "021|acm" and (2, "zip") not in keys
    assert [rule for i, rule in keys if i == 3] == ["exact"]
    assert keys[1, "sorted"] == "acme pharma" and keys[1, "first"] == "acme"


def test_rule_choice(spark):
    keys = [(1, "a", "x"), (2, "a", "x"), (3, "a", "y"), (4, "a", "y")] + [(i, "b", "z") for i in range(1, 9)]
    keys = spark.createDataFrame(keys, "record_id int, rule string, key string")
    labels = spark.createDataFrame([(1, 2, 1), (3, 4, 1), (5, 6, 1), (1, 3, 0)], "left_id int, right_id int, is_match int")
    coverage = {r["rule"]: (r["n_pairs"], r["covered"]) for r in blocking.rule_coverage(labels, keys).collect()}
    assert coverage == {"a": (2, 2), "b": (28, 3)}
    assert blocking.select_rules(labels, keys, recall=0.6) == ["a"]
    assert blocking.select_rules(labels, keys, recall=0.75) == ["a", "b"]


def test_minhash_finds_close_pairs_and_nothing_wrong(spark):
    rows = make_texts(4, 120, words=30)
    found = blocking.minhash_pairs(prepared(spark, rows), FIELDS, 0.3).collect()
    got = {(r["left_id"], r["right_id"]): r["distance"] for r in found}
    all_pairs = {(a[0], b[0]): 1 - jaccard(a[1], b[1]) for i, a in enumerate(rows) for b in rows[i + 1 :] if a[1]}
    assert all(all_pairs[p] <= 0.3 + 1e-9 and d == pytest.approx(all_pairs[p], abs=1e-6) for p, d in got.items())
    close = {p for p, d in all_pairs.items() if d <= 0.1}
    assert close and len(close & set(got)) >= 0.99 * len(close)


def test_missing_fields_are_left_out_of_the_score(spark):
    fields = (FieldSpec("a", "string", weight=0.6), FieldSpec("b", "exact", has_missing=True, weight=0.4))
    rows = [(1, "x", "p", "x", "p"), (2, "x", None, "x", "p"), (3, "x", "p", "x", "q"), (4, None, "p", "x", "p")]
    df = spark.createDataFrame(rows, "left_id int, left_a string, left_b string, right_a string, right_b string")
    out = scoring.score_pairs(scoring.pair_features(df, fields), fields).orderBy("left_id").collect()
    assert [r["score"] for r in out] == [1.0, 1.0, 0.6, 0.4]
    assert [r["missing_b"] for r in out] == [0, 1, 0, 0]


def test_training_saves_and_reuses_a_model(spark, tmp_path):
    fields = (FieldSpec("a", "string"),)
    rows = [(i, j, (i + j) % 10 / 10, 0, int((i + j) % 10 >= 5)) for i in range(20) for j in range(10)]
    df = spark.createDataFrame(rows, "left_id int, right_id int, sim_a double, missing_a int, is_match int")
    path = str(tmp_path / "model")
    model = scoring.load_or_train(path, df, fields)
    again = scoring.load_or_train(path, df.limit(0), fields)
    first = scoring.score_pairs(df, fields, model).orderBy("left_id", "right_id").collect()
    second = scoring.score_pairs(df, fields, again).orderBy("left_id", "right_id").collect()
    assert [r["score"] for r in first] == [r["score"] for r in second]
    assert all((r["score"] > 0.5) == (r["is_match"] == 1) for r in first)


def test_labels_latest_wins(spark):
    schema = "left_id int, right_id int, is_match int, labelled_at string"
    store = spark.createDataFrame([(1, 2, 1, "2024-01-01"), (1, 3, 0, "2024-01-01")], schema)
    new = spark.createDataFrame([(1, 2, 0, "2024-02-01"), (4, 5, 1, "2024-02-01")], schema)
    out = sorted(map(tuple, scoring.upsert_labels(store, new).collect()))
    assert out == [(1, 2, 0, "2024-02-01"), (1, 3, 0, "2024-01-01"), (4, 5, 1, "2024-02-01")]


def test_sample_is_the_same_whatever_the_partitioning(spark):
    pairs = spark.range(1000).select(F.col("id").alias("left_id"), (F.col("id") + 7).alias("right_id"))
    one = scoring.sample_pairs(pairs.repartition(1), 50).collect()
    many = scoring.sample_pairs(pairs.repartition(13), 50).collect()
    assert sorted(one) == sorted(many) and len(one) == 50


def test_threshold_choice(spark):
    rows = [(0.95, 1), (0.85, 1), (0.75, 0), (0.65, 1), (0.25, 0), (0.15, 0)]
    df = spark.createDataFrame(rows, "score double, is_match int")
    best = scoring.threshold_fbeta(df, beta=1.0).first()
    assert (best["threshold"], best["precision"], best["recall"]) == (0.65, 0.75, 1.0)
    assert scoring.threshold_fbeta(df, beta=0.1).first()["threshold"] == 0.85


def test_unlike_records_of_a_block_form_no_pairs(spark, monkeypatch):
    """Sketches tell them apart where they meet: only pairs that are similar go on to be compared in full."""
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(40)), "en") for i in range(90)]
    rows.append((90, rows[7][1] + " more", "en"))
    formed = []
    compare = blocking.compare
    monkeypatch.setattr(blocking, "compare", lambda pairs, *rest: formed.append(pairs.count()) or compare(pairs, *rest))
    for limit in (100, 5):
        found = blocking.candidate_pairs(prepared(spark, rows), FIELDS, THRESHOLD, limit=limit).collect()
        assert [(r["left_id"], r["right_id"]) for r in found] == [(7, 90)]
    assert formed == [1, 1]


@pytest.mark.parametrize("tiled,frequent", [(20_000, 1000), (5, 8), (1, 0)])
def test_tiles_and_signatures_find_the_same_pairs(spark, monkeypatch, tiled, frequent):
    monkeypatch.setattr(blocking, "FACING", 7)
    rows = make_texts(3, 150)
    found = blocking.candidate_pairs(prepared(spark, rows), FIELDS, THRESHOLD, frequent, 1, tiled=tiled).collect()
    got = {(r["left_id"], r["right_id"]): r["score"] for r in found}
    assert len(got) == len(found)
    assert got == pytest.approx(brute_pairs(rows), abs=2e-6)


def test_no_record_is_sent_once_for_each_of_its_pairs(spark):
    """A family's pairs stand in one group, where every record goes once."""
    rec = prepared(spark, [(i, f"a b c d e f g h x{i}", "en") for i in range(30)], {"first": blocking.rule_first_chars("text", 1)})
    pairs = blocking.pairs_within(blocking.sketch_members(blocking.block_members(rec), blocking.sketches(rec)), THRESHOLD)
    assert pairs.count() == 435
    assert pairs.select("key", "left_id").distinct().count() == 29
    assert blocking.compare(pairs, rec, rec, FIELDS, THRESHOLD).count() == 435


def _tables(spark):
    return {entry.name.rsplit("-", 1)[0] for entry in Path(workspace(spark)).iterdir()}


def test_released_tables_leave_the_workspace_and_others_stay(spark, tmp_path):
    kept = spark.range(5)
    kept.write.parquet(f"{tmp_path}/kept")
    table = materialise(kept, "short_lived")
    assert "short_lived" in _tables(spark)
    release(table.where("id > 2"))
    release(spark.read.parquet(f"{tmp_path}/kept"))
    assert "short_lived" not in _tables(spark)
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 5


@pytest.mark.parametrize("name", ["pair_sample", "cluster_confidence"])
def test_scored_pairs_are_written_once_without_features(spark, name):
    def written():
        return {entry for entry in Path(workspace(spark)).iterdir() if entry.name.startswith("scored-")}

    before = written()
    assert queries.REGISTRY[name](spark, SMOKE).count() > 0
    (table,) = written() - before
    assert spark.read.parquet(str(table)).columns == ["left_id", "right_id", "score"]


def test_scored_pairs_do_not_keep_the_records_beside_their_representatives(spark):
    def records():
        return {entry.name for entry in Path(workspace(spark)).iterdir() if entry.name.startswith("records-")}

    before = records()
    assert queries.score_pairs(spark, SMOKE).count() > 0
    assert records() == before


def test_a_family_of_near_copies_is_linked_by_few_comparisons(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(80)]
    family = []
    for i in range(80):
        text = words[:]
        for place in rng.sample(range(80), rng.randint(1, 6)):
            text[place] = f"x{rng.randint(0, 400)}"
        family.append((i, " ".join(["start", *text]), rng.choice(["en", "fr", None])))
    left, right = family[:40], family[40:]
    formed = []
    compare = blocking.compare
    monkeypatch.setattr(linkage, "compare", lambda pairs, *rest: formed.append(pairs.count()) or compare(pairs, *rest))
    rules = {"first": blocking.rule_first_token("text")}
    out = linkage.link_records(prepared(spark, left, rules), prepared(spark, right, rules), FIELDS, THRESHOLD, 0.1).collect()
    want = {}
    for a in left:
        best = min((-score(a, b), b[0]) for b in right if jaccard(a[1], b[1]) >= THRESHOLD)
        want[a[0]] = (best[1], pytest.approx(-best[0], abs=2e-6))
    assert {r["left_id"]: (r["right_id"], r["score"]) for r in out} == want
    # Of 1,600 similar pairs.
    assert sum(formed) < 400


@pytest.mark.parametrize("model", [None, PairModel(-3.0, {"text": 5.0, "lang": 1.0}, {"lang": 0.5}), PairModel(1.0, {"text": -2.0, "lang": 1.0}, {})])
def test_no_score_is_above_its_bound(spark, model):
    rows = make_texts(11, 90)
    a, b = prepared(spark, rows[:45]), prepared(spark, rows[45:])
    bounds = blocking.fitting_links(a, b, FIELDS, THRESHOLD, model=model)
    scored = blocking.candidate_links(a, b, FIELDS, THRESHOLD, model=model).select("left_id", "right_id", "score")
    both = scored.join(bounds, ["left_id", "right_id"])
    assert both.count() == scored.count() > 20
    assert both.where("score > bound").count() == 0


def test_many_pairs_of_one_group_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(blocking, "CELL", 20)
    rows = make_texts(12, 90)
    rec = materialise(prepared(spark, rows), "rec")
    ids = [r[0] for r in rows if r[1]]
    pairs = [(a, b, 1) for a in ids for b in ids if a < b]
    found = blocking.compare(spark.createDataFrame(pairs, "left_id bigint, right_id bigint, key bigint"), rec, rec, FIELDS, THRESHOLD).collect()
    got = {(r["left_id"], r["right_id"]): r["score"] for r in found}
    assert len(got) == len(found)
    assert got == pytest.approx(brute_pairs(rows), abs=2e-6)


def test_minhash_members_have_the_keys_of_the_rule_and_records_are_not_written_again(spark):
    rec = prepared(spark, make_texts(13, 60))
    ruled = blocking.block_members(rec.withColumn("keys", F.array_distinct(blocking.minhash_rule(F.col("tokens"), 4, 2))))
    got = sorted(map(tuple, blocking.minhash_members(rec, 4, 2).collect()))
    assert len(got) > 100 and got == sorted(map(tuple, ruled.collect()))
    before = set(Path(workspace(spark).removeprefix("file:")).iterdir())
    blocking.minhash_pairs(rec, FIELDS, 0.4).count()
    assert not [p for p in set(Path(workspace(spark).removeprefix("file:")).iterdir()) - before if p.name.startswith("banded")]


def test_rule_coverage_reads_the_texts_once(spark, monkeypatch):
    read = []
    documents = roles.documents
    monkeypatch.setattr(roles, "documents", lambda *args: read.append(args) or documents(*args))
    assert queries.rule_coverage(spark, SMOKE).count() == 5
    assert len(read) == 1
