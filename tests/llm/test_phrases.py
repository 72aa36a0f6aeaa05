"""Phrases against counting everything."""

import random
import re
from collections import Counter

import pytest

from kinmaster.llm import phrases


def brute(rows, min_count, top, longest):
    counts, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {q for p, a in found.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if (q := p[i:j]) != p and f[q] <= a}
        rows = []
        for p, a in found.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["the", "Of", "new", "york", "Été", "île", "a", "b", "c", "x" * 60, "12", "ß", "日本"] + [f"w{i}" for i in range(60)]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    fixed = ["united States of america", "to be or not to be", "New York", "a a a a a a a a", "only here, never There"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(1, 15)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else " ".join(rng.choices(vocabulary, weights, k=rng.randrange(1, 8))))
            parts.append(rng.choice([" ", "\t", ". ", ",", "\n", "  ", "\r\n", "\x0b", " - ", " "]))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und", ""]), "".join(parts)))
    return rows + [("en", None), ("fr", ""), (None, None), ("en", "one"), ("de", "... !")] + [("fr", "Same row again and again")] * 40


@pytest.mark.parametrize("seed, min_count, top, longest, shares", [
    (1, 5, 2000, 5, phrases.SHARES), (2, 3, 10, 5, (64, 16, 4, 1)), (3, 2, 25, 4, (1,)),
])
def test_equals_counting_everything(spark, seed, min_count, top, longest, shares):
    rows = texts(seed)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, word string, n int")
    got = phrases.mine_phrases(docs, min_count, top, longest, shares, bits=14)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, min_count, top, longest)


def test_ties_at_the_end_are_settled(spark):
    # Equal scores and counts: the phrase's bytes decide who is in.
    rows = [("en", f"{a}x {a}y. pad{i}") for a in "zébcda" for i in range(5)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in phrases.mine_phrases(docs, 5, 3, shares=(8, 1)).collect())
    assert got == brute(rows, 5, 3, 5)
    assert [r[2] for r in got] == ["ax ay", "bx by", "cx cy"]


def test_empty_table_and_long_text(spark):
    assert phrases.mine_phrases(spark.createDataFrame([], "lang string, text string")).count() == 0
    rows = [("en", "long road " * 200_000 + "word" * 50_000)]
    got = phrases.mine_phrases(spark.createDataFrame(rows, "lang string, text string")).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 100, 2000, 5)


def test_frequent_words_are_not_expanded(spark, monkeypatch):
    grown = []
    real = phrases.grow
    monkeypatch.setattr(phrases, "grow", lambda *a: grown.append(a[1]) or real(*a))
    rows = [("en", f"q{i} r{i}. the the the") for i in range(20) for _ in range(6)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in phrases.mine_phrases(docs, 5, 4, shares=(64, 1)).collect())
    assert got == brute(rows, 5, 4, 5)
    assert len(grown) < 5  # one batch, and it ends where nothing is frequent
