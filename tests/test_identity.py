import random

import pytest

from kinmaster.operators import identity

IDS = [None, "", "pending", "pending x", "EMUSHCO0000003", "EMUSHCO0000009", "EMUSHCO0000012"]


def loop_model(rows, start, policy):
    """The rules one row after the other: (record, cluster, id) in file order."""
    rows = [list(r) for r in rows]

    def blank(v):
        return v is None or v == ""

    def usable(v):
        return not blank(v) and (policy == "compat" or "pending" not in v)

    pending = [blank(r[2]) or "pending" in r[2] for r in rows]
    for i, row in enumerate(rows):
        if pending[i]:
            known = [r[2] for r in rows if r[1] == row[1] and usable(r[2])]
            if known:
                row[2] = known[0]
            else:
                row[2] = f"EMUSHCO{start:07d}"
                start += 1
    return {r[0]: r[2] for r in rows}


def frame(spark, rows):
    return spark.createDataFrame(rows, "record_number int, cluster_id int, final_id string")


@pytest.mark.parametrize("policy", ["compat", "strict"])
def test_assignment_equals_the_loop(spark, policy):
    rng = random.Random(policy)
    for _ in range(4):
        rows = [(i, rng.randint(0, 40), rng.choice(IDS)) for i in range(150)]
        shuffled = rows[:]
        rng.shuffle(shuffled)
        out = identity.assign_ids(frame(spark, shuffled), 13, pending_policy=policy).collect()
        assert {r["record_number"]: r["final_id"] for r in out} == loop_model(rows, 13, policy)


def test_second_run_changes_nothing_and_creates_nothing(spark):
    rows = [(i, i % 20, IDS[i * 7 % len(IDS)]) for i in range(100)]
    once = identity.assign_ids(frame(spark, rows), 13, pending_policy="strict")
    twice = identity.assign_ids(once, 500, pending_policy="strict")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_existing_ids_never_change(spark):
    rows = [(1, 1, "EMUSHCO0000003"), (2, 1, "EMUSHCO0000009"), (3, 1, None)]
    out = {r["record_number"]: r["final_id"] for r in identity.assign_ids(frame(spark, rows), 10).collect()}
    assert out == {1: "EMUSHCO0000003", 2: "EMUSHCO0000009", 3: "EMUSHCO0000003"}
    labels = identity.cluster_conflict(frame(spark, rows)).select("label").distinct().collect()
    assert [r[0] for r in labels] == [1]


@pytest.mark.parametrize("ids,top", [([], 0), ([None, "", "pending"], 0), (["EMUSHCO0000041", "pending"], 41)])
def test_start_after_the_master(spark, ids, top):
    master = frame(spark, [(i, i, v) for i, v in enumerate(ids)])
    assert identity.max_id(master, "final_id").first()["max_number"] == top
    out = identity.assign_ids(frame(spark, [(1, 1, None)]), master=master).first()
    assert out["final_id"] == f"EMUSHCO{top + 1:07d}"


def test_net_new_modes(spark):
    rows = [(1, 1, "EMUSHCO0000003"), (2, 2, "EMUSHCO0000010"), (3, 3, "pending"), (4, 4, "EMUSHCO10000000")]
    flags = {
        mode: [r["net_new"] for r in identity.flag_net_new(frame(spark, rows), "EMUSHCO0000005", mode=mode).orderBy("record_number").collect()]
        for mode in ("strict", "compat")
    }
    assert flags == {"strict": [0, 1, 0, 1], "compat": [0, 1, 1, 1]}
    out = identity.flag_net_new(frame(spark, rows), "EMUSHCO0000005")
    assert out.columns[:2] == ["final_id", "net_new"]


def test_one_new_id_per_cluster_in_order_of_appearance(spark):
    rows = [(1, 9, ""), (2, 4, ""), (3, 9, ""), (4, 1, "")]
    out = identity.seq_id_per_cluster(frame(spark, rows)).orderBy("record_number").collect()
    assert [r["new_id"][-1] for r in out] == ["1", "2", "1", "3"]


def test_qc(spark):
    rows = [(1, 1, "A"), (2, 2, "A"), (3, 3, "B"), (4, 4, None), (5, 5, None)]
    assert tuple(identity.id_qc(frame(spark, rows)).first()) == (5, 2)
    assert [r["record_number"] for r in identity.duplicate_ids(frame(spark, rows)).collect()] == [4, 5, 1, 2]
