"""Divergence of sources against direct sums over all terms."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from kinmaster.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, top):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        groups.add((lang, source))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 2) // (total + 2 * len(kept)) for t in kept}

        whole = Counter()
        for g in groups:
            if g[0] == lang:
                whole.update(counts[g])
        p, q = shares(counts[lang, source]), shares(whole)
        pairs = []
        for other in {s for la, s in groups if la == lang} - {source}:
            r = shares(counts[lang, other])
            pairs.append((-sum((p[t] - r[t]) ** 2 // (p[t] + r[t]) for t in kept), other.encode()))
        terms = [(-((p[t] - q[t]) ** 2 // (p[t] + q[t])), t.encode()) for t in kept if counts[lang, source][t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, top)):
            out += [(lang, source, part, item.decode(), -v, i) for i, (v, item) in enumerate(sorted(found)[:most], 1)]
    return sorted(out)


def texts(seed, n=400, sources=7):
    rng = random.Random(seed)
    vocabulary = ["The", "été", "ÉTÉ", "日本語", "a1b", "don't", "x_y", "A"] + [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    rows = []
    for _ in range(n):
        source = rng.choice([f"s{i}" for i in range(sources)] + ["s0"] * sources + [None, "", "Ä"])
        shift = hash(source) % 5 if source else 0
        words = rng.choices(vocabulary, [1 / (1 + (i + shift) % len(vocabulary)) for i in range(len(vocabulary))], k=rng.randrange(30))
        rows.append((rng.choice(["en", "en", "fr", None, ""]), source, rng.choice([" ", "\n", "-", "1"]).join(words)))
    return rows + [("en", "only", None), ("en", "blank", "12 !"), ("xx", "a", "one"), ("xx", "b", None), ("lone", "a", "z " * 30)] + [("fr", "s1", "same Row")] * 30


@pytest.mark.parametrize("seed, min_docs, block_terms, tile", [(1, 10, 2048, 32), (2, 3, 5, 2), (3, 1, 7, 3), (4, 10, 1, 1)])
def test_equals_direct_sums(spark, seed, min_docs, block_terms, tile):
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, "t", 1, 2) for r in rows], "lang string, source string, text string, term string, n int, rank int")
    got = divergence.audit(docs, min_docs, block_terms=block_terms, tile=tile)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_docs, 10)


def test_joint_tables_count_terms(spark):
    rows = texts(5)
    profiles = divergence.Profiles(spark.createDataFrame(rows, "lang string, source string, text string"), 3)
    got = {tuple(r)[:5]: r["n_terms"] for r in divergence.joint_tables(profiles, 6, 3).collect()}
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        terms = ["".join(c.lower() if "A" <= c <= "Z" else c for c in t) for t in TERM.findall(text or "")]
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    want = Counter()
    for la, a in list(counts):
        for lb, b in list(counts):
            if la == lb and a.encode() < b.encode():
                want.update((la, a, counts[la, a][t], b, counts[la, b][t]) for t, n in docs[la].items() if n >= 3)
    assert got == want


def test_strips_give_the_same_product(spark):
    rng = random.Random(6)
    sources, terms, counts = [], [], []
    for s in "abcde":
        for t in range(200):
            if rng.random() < 0.6:
                sources.append(s), terms.append(f"t{t}"), counts.append(rng.randrange(1, 50))
    def table(strip):
        found = divergence.block_table(sources, terms, np.array(counts), 210, list("abcde"), list("abcde"), strip)
        out = Counter()
        for a, b, c, d, n in zip(*found, strict=True):
            out[a, int(b), c, int(d)] += int(n)
        return out

    assert table(1024) == table(7) and sum(table(7).values()) == 10 * 210


def test_empty_table_and_long_text(spark):
    schema = "lang string, source string, text string"
    assert divergence.audit(spark.createDataFrame([], schema)).count() == 0
    rows = [("en", "a", "long road " * 300_000 + "w" * 100_000)] + [("en", "b", "long road")] * 9
    got = divergence.audit(spark.createDataFrame(rows, schema))
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 10, 10)
