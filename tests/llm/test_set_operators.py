"""Token file, decontamination, near duplicates, mixing, lines and neighbours: brute force and edge cases."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinmaster.llm import decontaminate, huffman, line_dedup, mixing, near_dup, neighbours

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path(huffman.TOKENIZER)


def test_pieces_in_parts(monkeypatch):
    """Words, marks and lines of many scripts, with little remembered and long texts encoded in parts."""
    monkeypatch.setattr(huffman, "BYTES_AT_ONCE", 60)
    monkeypatch.setattr(huffman, "REMEMBERED", 50)
    monkeypatch.setattr(huffman, "LONGEST_REMEMBERED", 4)
    plain = Tokenizer.from_file(PATH)
    encoder = huffman.PieceEncoder(PATH)
    rng = random.Random(5)
    signs = [" ", "  ", "\n", " \n", "a", "b c", "ёж", "ñandú,", "Ωμ.", "e\u0301.", ".\nB", "don't", "x²", "ª!", "中。a", "\0", "\u3000", "<|endoftext|>"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(60))) for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype=encoder.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert encoder.encode([None, ""]) == [b"", b""]
    assert list(huffman._groups([0, 0, 70, 10, 50, 1])) == [(0, 2), (2, 1), (3, 2), (5, 1)]


def test_pieces_give_the_ids_of_whole_texts():
    rng = random.Random(0)
    parts = ["a", "b", " ", "\n", "\t", "'s", "é", "1", "!", "\u00a0", "\u3000", "<|endoftext|>", "\x1c", "\r", "  ", "   ", "\0", " the", "\U0001f389"]
    texts = [None, ""] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    encoder = huffman.PieceEncoder(PATH)
    plain = Tokenizer.from_file(PATH)
    want = [np.array(e.ids, dtype=encoder.dtype).tobytes() for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoder.by_piece and encoder.encode(texts) == want


def test_ids_of_many_documents_are_counted_at_once(monkeypatch):
    rng = np.random.default_rng(3)
    documents = [rng.integers(0, 50_000, rng.integers(0, 20)).astype("<u2") for _ in range(3000)]
    calls, bincount = [], np.bincount
    monkeypatch.setattr(huffman, "ROW_IDS", 10_000)
    monkeypatch.setattr(huffman.np, "bincount", lambda ids: calls.append(len(ids)) or bincount(ids))
    counts = huffman.vocabulary_counts(iter(documents))
    assert {i: int(counts[i]) for i in np.flatnonzero(counts).tolist()} == Counter(np.concatenate(documents).tolist())
    assert len(calls) <= sum(map(len, documents)) // 10_000 + 1
    assert len(huffman.vocabulary_counts(iter([]))) == 0


@pytest.mark.parametrize("case", range(12))
def test_code_round_trip(case):
    rng = np.random.default_rng(case)
    n = int(rng.integers(1, 3000))
    ids = (rng.zipf(1.2, n) % 5000).astype(np.uint32) if case % 2 else rng.integers(0, int(rng.integers(1, 60000)), n).astype(np.uint32)
    values, counts = np.unique(ids, return_counts=True)
    bits = min(16, max(1, int(np.ceil(np.log2(len(values)))) + case % 3))
    lengths = huffman.code_lengths(dict(zip(values.tolist(), counts.tolist(), strict=True)), bits)
    assert max(lengths.values()) <= bits and sum(2.0**-b for b in lengths.values()) <= 1
    code = huffman.Code(lengths)
    data, offsets = code.encode(ids, 64)
    assert (code.decode(data, offsets, n, 64) == ids).all()


def test_length_limit_is_optimal_on_a_skewed_code():
    counts = dict(enumerate([1, 1, 2, 3, 5, 8, 13, 21]))
    best = min(
        sum(counts[i] * b for i, b in enumerate(lengths))
        for lengths in itertools.product(range(1, 5), repeat=8) if sum(2.0**-b for b in lengths) <= 1
    )
    lengths = huffman.code_lengths(counts, 4)
    assert sum(counts[i] * b for i, b in lengths.items()) == best


def test_token_file(spark):
    rows = [(5, "one two"), (3, None), (9, ""), (3, "again 3"), (None, "no id"), (7, "x " * 30000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int").repartition(3)
    path = huffman.token_file(df, PATH)
    got = huffman.read_ids(spark, path).orderBy("start").collect()
    plain = Tokenizer.from_file(PATH)
    start = 0
    assert [r["doc_id"] for r in got] == [None, 3, 3, 5, 7, 9]
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(plain.encode(t or "", add_special_tokens=False).ids + [huffman.END_ID])
    for r in got:
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert ids in texts[r["doc_id"]] and r["start"] == start and r["n_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    assert huffman.encoded(df.limit(0)).count() == 0


def test_automaton_equals_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        letters = "abcd"[: rng.randint(1, 4)]
        items = [(k, " ".join(rng.choice(letters) for _ in range(rng.randint(0, 7)))) for k in range(rng.randint(0, 5))]
        texts = [" ".join(rng.choice(letters + "z") for _ in range(rng.randint(0, 25))) for _ in range(4)]
        window = rng.randint(1, 5)
        automaton = decontaminate.SuffixAutomaton([(k, decontaminate.words_of(t.encode())) for k, t in items], window)
        for text, want in zip(texts, decontaminate.brute_force(texts, items, window), strict=True):
            spans, names = automaton.hits(decontaminate.words_of(text.encode()))
            assert (sum(b - a for a, b in spans), len(names)) == (want[1], want[2])


def test_decontamination(spark):
    items = [(1, "The quick brown fox jumps over the lazy dog and runs away from it all today"), (2, "short item"), (3, None), (4, "!!"), (None, "né à Paris")]
    passage = "the QUICK, brown fox jumps over the lazy dog and runs away from it all"
    texts = [None, "", passage, "x " * 400 + passage + " y" * 400, "a short item here", "Short\nitem", "ne a paris, NÉ À paris", "né à Paris"]
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = decontaminate.brute_force(texts, [(i if i is not None else "null", t) for i, t in items])
    for limit in (10_000, 3):
        found = decontaminate.find_contamination(docs, bench, shard_words=limit).withColumn("h", decontaminate.n_hit()).collect()
        got = {r["doc_id"]: (r["n_words"], r["h"], len(r["item_ids"])) for r in found}
        assert got == {i: w[:3] for i, w in enumerate(want)}
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, bench).collect()}
    assert set(kept) == {i for i, w in enumerate(want) if not w[4]}
    assert kept[3] == "x " * 400 + " y" * 400 and kept[0] is None and kept[1] == ""
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == len(texts)
    assert decontaminate.find_contamination(docs.limit(0), bench).count() == 0


def shingles(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def components(sets, similar):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for a, b in {p for ids in where.values() for p in itertools.combinations(sorted(ids), 2)}:
        if similar(sets[a], sets[b]):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {i: find(i) for i in sets}


def close(a, b):
    return 100 * len(a & b) >= 80 * len(a | b)


def check_near(spark, texts, **options):
    df = spark.createDataFrame([(i, t, 0) for i, t in texts.items()], "doc_id long, text string, component_id int").repartition(6)
    sets = {i: shingles(t, 4) for i, t in texts.items()}
    want = components(sets, close)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.near_duplicates(df, shingle=4, **options).collect()}
    assert got == {i: (len(sets[i]), c, c == i) for i, c in want.items()}


def test_near_duplicates_equal_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    check_near(spark, texts)


def test_near_duplicates_of_a_family_and_a_shared_passage(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    base = rng.choices(words, k=120)
    texts = {}
    for i in range(0, 300):  # near copies of near copies: chains as well as stars
        if rng.random() < 0.3:
            base = list(base)
            base[rng.randrange(120)] = rng.choice(words)
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(120)] = rng.choice(words)
        texts[i] = " ".join(copy)
    passage = rng.choices(words, k=60)
    for i in range(300, 420):
        texts[i] = " ".join(rng.choices(words, k=rng.randint(5, 80)) + passage)
    texts |= {500: None, 501: "", 502: " \n", 503: "A b", 504: "a\tB", 505: "a b c", 506: texts[3], 507: texts[3].upper()}
    check_near(spark, texts)


@pytest.mark.parametrize("seed", [5, 6])
def test_near_duplicates_of_copies_about_the_threshold(spark, seed):
    rng = random.Random(seed)
    texts, common = {}, [f"c{i}" for i in range(30)]
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(150)]
        for _ in range(70):  # up to 11 words changed, for new ones or for a few that others have too; some cut short
            copy = list(base)
            for _ in range(rng.randint(0, 11)):
                copy[rng.randrange(150)] = rng.choice(common) if rng.random() < 0.5 else f"n{rng.random()}"
            texts[len(texts)] = " ".join(copy[:150 - rng.choice([0, 0, 10, 25])])
    passage = [f"p{i}" for i in range(100)]
    for own in range(150):  # mostly one passage, in pairs of copies
        start = [f"o{own // 2}x{i}" for i in range(8 + own % 40)]
        texts[len(texts)] = " ".join(start + passage)
    check_near(spark, texts)


def test_pairs_of_a_crowded_list_are_not_formed(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(600):  # most of a copy is the same text, and half of the copies are not similar to any other
        copy = list(base)
        for at in rng.sample(range(0, 150, 5), 2 if i % 2 else 7):
            copy[at] = f"n{rng.random()}"
        rows.append((i, " ".join(copy)))
    looked = []
    plain = near_dup.apart
    monkeypatch.setattr(near_dup, "apart", lambda *a: looked.append(plain(*a).count()) or plain(*a))
    kept = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), shingle=4).where("kept").count()
    assert kept == 301
    assert sum(looked) < 600


def test_texts_of_one_id_are_one_document(spark):
    a = " ".join(f"a{i}" for i in range(60))
    b = " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, "c d e f")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dup.near_duplicates(df).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 1), (4, 4)]


def test_near_duplicates_edges(spark):
    df = spark.createDataFrame([(1, "a b c d e"), (None, "a b c d e"), (None, "a b c d e"), (2, "a b c d e"), (2, "a b c d e")], "doc_id long, text string")
    got = sorted(near_dup.near_duplicates(df).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"]] == [(1, 1, True), (2, 1, False), (2, 1, False)]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)
    assert near_dup.keep_one(df).count() == 3
    assert near_dup.near_duplicates(df.limit(0)).count() == 0


class _Batches:
    """Stands for a DataFrame of given Arrow batches."""

    def __init__(self, batches):
        self.batches = batches

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        return list(function(iter(self.batches)))


def test_sets_leave_a_task_in_small_batches(spark):
    texts = [" ".join(f"w{i * k % 977}" for k in range(4000)) for i in range(400)] + [None, ""]
    docs = _Batches([pa.RecordBatch.from_arrays([pa.array(range(402)), pa.array(texts)], ["doc_id", "text"])])
    sets, signed = near_dup.whole_sets(docs, 5, "text"), near_dup.sketch(docs)
    for found in (sets, signed):
        assert sum(b.num_rows for b in found) == 402 and max(b.num_rows for b in found) <= 200
    assert [i for b in signed for i in b.column("doc_id").to_pylist()] == list(range(402))
    names = [[n for b in found for n in zip(b["set_a"].to_pylist(), b["set_b"].to_pylist(), strict=True)] for found in (sets, signed)]
    assert names[0] == names[1]


def test_mix(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(0, 40)), f"s{min(i % 9, 5)}" if i % 10 else None) for i in range(600)]
    rows += [(1000, None, "s1"), (1001, "", "empty"), (1002, "one two", "z")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    total = sum(r["mix_size"] for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
    targets = {s: g[0]["mix_target"] for s, g in by.items()}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6 * total
    assert list(sorted(by, key=lambda s: (s is None, s)))[-1] is None
    for s, g in by.items():
        size = sum(r["mix_size"] for r in g)
        taken = sum(r["mix_size"] * r["mix_copies"] for r in g)
        assert g[0]["mix_source_size"] == size and targets[s] <= 2 * size
        assert abs(taken - targets[s]) <= max((r["mix_size"] for r in g), default=0) / 2 + 1e-6
    again = {r["doc_id"]: r["mix_copies"] for r in mixing.mix(df.repartition(7)).collect()}
    assert again == {r["doc_id"]: r["mix_copies"] for r in got}
    assert mixing.mixed_documents(df).count() == sum(r["mix_copies"] for r in got)
    assert mixing.mixed_documents(df).columns == df.columns
    assert mixing.mix(df.limit(0)).count() == 0


def normal(line):
    return re.sub(r"\d", "0", re.sub(r"[\W_]+", " ", line.lower()).strip())


def test_line_dedup(spark):
    rng = random.Random(4)
    words = [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(3000)]
    line = " ".join(rng.choices(words, k=60))
    near = line.replace(line.split()[30], line.split()[30] + "x", 1)
    other = " ".join(rng.choices(words, k=60))
    docs = [(1, f"{line}\nshort line\n{other}"), (2, f"intro words here\n{line.upper()}!!\nshort line"), (3, near), (4, None), (5, ""),
            (6, f"{other} 12\n\n{other} 34"), (None, "x y")]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, n_lines int")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert len(got) == 7 and got[1]["n_removed"] == 0
    assert got[2]["clean_text"] == "intro words here\nshort line" and got[2]["n_removed"] == 1
    assert got[4]["clean_text"] is None and got[4]["n_lines"] == 0 and got[5]["clean_text"] == "" and got[5]["n_lines"] == 1
    # One empty line is left if the two are also near the line of document 1.
    assert got[6]["clean_text"] in ("", f"{other} 12\n") and got[None]["clean_text"] == "x y"
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    rng = random.Random(14)
    words = [f"w{i}".translate(str.maketrans("0123456789", "abcdefghij")) for i in range(3000)]
    a, b, c, d = (" ".join(rng.choices(words, k=30)) for _ in range(4))
    for i in (None, 7):
        docs = [(i, f"{a}\n{b}"), (i, f"{a}\n{b}"), (i, f"{c}\n{a}"), (i, f"x\n{d}")]
        got = sorted(r["clean_text"] for r in line_dedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect())
        assert len(got) == 4 and sum(t.count(a) for t in got) == 1 and sum(t.count(b) for t in got) == 1
        assert sum(t.count(c) for t in got) == 1 and f"x\n{d}" in got


def test_op10_takes_lines_of_any_length(spark, tmp_path):
    thai, han = "\u0e2a\u0e27\u0e31\u0e2a\u0e14\u0e35\u0e04\u0e23\u0e31\u0e1a" * 4, "\u4eca\u65e5\u306f\u3068\u3066\u3082\u826f\u3044\u5929\u6c17\u3067\u3059\u306d" * 3
    docs = [(1, f"one\n\nshort line\n{thai}\n***\n{han}"), (2, f"two\n\nShort line!\n{thai}\n***\n---\n{han}")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in line_dedup.op10_line_dedup(spark, str(tmp_path)).collect()}
    assert got[1]["n_removed"] == 0 and got[2]["n_removed"] == 4
    assert got[2]["clean_md5"] == hashlib.md5(b"two\n\n---").hexdigest()


def test_simhash_and_blocks(spark):
    df = spark.createDataFrame([(0, "a b c"), (1, "a b d"), (2, ""), (3, "a " * 70000)], "i long, norm string")
    out = [r["simhash"] for r in line_dedup.simhash(df, ["i"]).orderBy("i").collect()]
    one = spark.sql("select xxhash64('a')").first()[0]
    assert out[3] == one and len(set(out)) >= 3
    rng = random.Random(5)
    rows = []
    for i in range(200):
        bits = rng.getrandbits(64)
        other = bits
        for b in rng.sample(range(64), line_dedup.MAX_DISTANCE):
            other ^= 1 << b
        rows.append((i, *(x - (1 << 64) if x >> 63 else x for x in (bits, other))))
    keys = spark.createDataFrame(rows, "i int, a long, b long").select(
        F.size(F.array_intersect(line_dedup.block_keys(F.col("a")), line_dedup.block_keys(F.col("b")))).alias("n"))
    assert keys.where("n = 0").count() == 0


def test_every_word_of_a_long_line_votes(spark):
    rng = random.Random(15)
    words = [rng.choice("abcdefgh") + str(rng.randrange(500)) for _ in range(40_000)]
    df = spark.createDataFrame([(0, " ".join(words)), (1, " ".join(["first", *words]))], "i long, norm string")
    a, b = (r["simhash"] for r in line_dedup.simhash(df, ["i"]).orderBy("i").collect())
    assert bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3


def typo_lines(rng, n, changed, trials):
    """Pairs of lines of ``n`` words, of which ``changed`` have one letter replaced in the second."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    for _ in range(trials):
        words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)]
        other = list(words)
        for i in rng.sample(range(n), changed):
            at = rng.randrange(len(words[i]))
            other[i] = words[i][:at] + rng.choice(letters.replace(words[i][at], "")) + words[i][at + 1:]
        yield " ".join(words), " ".join(other)


def share_that_meets(spark, pairs):
    rows = [(2 * i + side, line) for i, pair in enumerate(pairs) for side, line in enumerate(pair)]
    keys = line_dedup.line_keys(spark.createDataFrame(rows, "line_hash long, norm string"))
    met = keys.groupBy(F.floor(F.col("node") / 2).alias("pair"), "key").count().where("count > 1").select("pair").distinct().count()
    return met / len(pairs)


@pytest.mark.parametrize(("n", "changed", "least"), [(5, 1, 0.95), (10, 1, 0.98), (20, 1, 0.99), (30, 1, 0.99), (60, 1, 0.99), (100, 1, 0.99), (30, 3, 0.95), (100, 10, 0.95)])
def test_lines_with_typos_meet(spark, n, changed, least):
    assert share_that_meets(spark, list(typo_lines(random.Random(n), n, changed, 400))) >= least


def test_lines_without_blanks_meet(spark):
    rng = random.Random(16)
    lines = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(80)) for _ in range(200)]
    assert share_that_meets(spark, [(x, x[:40] + chr(0x3042) + x[41:]) for x in lines]) >= 0.99


def test_exact_repeats_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    df = spark.createDataFrame(docs)
    seen, lost = set(), defaultdict(set)
    for r in sorted(docs):
        for n, line in enumerate((r["text"] or "").split("\n")):
            key = normal(line)
            if len(key.split()) >= line_dedup.MIN_WORDS:
                if key in seen:
                    lost[r["doc_id"]].add(n)
                seen.add(key)
    got = defaultdict(set)
    for r in line_dedup.line_groups(df).where("NOT first").collect():
        got[r["doc_id"]].add(r["line_no"])
    assert lost and all(lines <= got[i] for i, lines in lost.items())


def test_hilbert_keys_are_a_walk():
    for n, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        keys = neighbours.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        steps = np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def recall(spark, df, **options):
    got = defaultdict(list)
    for r in neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0, **options).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"], r["rank"]))
    rows = {}
    for r in df.collect():
        v = r["embedding"]
        if r["vec_id"] is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            rows[r["vec_id"]] = np.array(v, dtype=np.float64)
    ids = np.array(sorted(rows))
    table = np.stack([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    hits = n = 0
    for q in ids[ids % 50 == 0]:
        scores = table @ (rows[q] / np.linalg.norm(rows[q]))
        order = [i for i in np.lexsort((ids, -np.round(scores, 12))) if ids[i] != q][:5]
        assert [r for _, _, r in got[q]] == list(range(1, len(order) + 1))
        assert all(abs(s - float(rows[v] @ rows[q] / np.linalg.norm(rows[v]) / np.linalg.norm(rows[q]))) < 1e-12 for v, s, _ in got[q])
        hits += len({ids[i] for i in order} & {v for v, _, _ in got[q]})
        n += len(order)
    return hits / n


def test_neighbours_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    assert recall(spark, df, block=256) >= 0.9


def test_neighbours_edges(spark):
    rng = np.random.default_rng(0)
    base = rng.standard_normal(8)
    rows = [(i, base.tolist()) for i in range(0, 120)] + [(i, rng.standard_normal(8).tolist()) for i in range(200, 260)]
    rows += [(300, None), (350, [0.0] * 8), (400, [1.0, None] + [0.0] * 6), (450, [float("nan")] * 8), (500, []), (550, [1.0, 2.0]), (None, base.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert recall(spark, df.where("vec_id < 500 or vec_id is null")) >= 0.99
    got = neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0).where("query_id = 50").orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [0, 1, 2, 3, 4]
    assert neighbours.nearest_neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert neighbours.nearest_neighbours(alone, F.col("vec_id") % 50 == 0).count() == 0
