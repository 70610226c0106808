"""Phrase collocations: trees grown in groups equal plain counting, whatever the budget."""

import random
import re
from collections import Counter

import pytest

from tributary.llm import collocations

COLUMNS = "doc_id long, text string, lang string"


def brute(rows, least, top):
    out = []
    by_lang = {}
    for _, text, lang in rows:
        f = by_lang.setdefault("und" if lang is None else lang, Counter())
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            for d in range(1, 5):
                f.update(tuple(words[i : i + d]) for i in range(len(words) - d + 1))
    for lang, f in by_lang.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longest = Counter()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], a)
        found = []
        for p, a in candidates.items():
            if p in longest and 100 * longest[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def rows_of(seed, documents, words):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["É", "de", "|", "\x00", "A", "ß\x1f"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]
    rows = []
    for i in range(documents):
        n = draw.choice([0, 1, 2, 3, 60, 60, 300])
        text = "".join(w + draw.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", " ! "]) for w in draw.choices(vocabulary, weights, k=n))
        rows.append((i, text, draw.choice(["en", "en", "fr", None])))
    rows += [(1000, "alpha Beta gamma delta alpha beta gamma delta", "fr")] * 40  # repeated rows, a phrase that overlaps itself
    rows += [(1001, "b " * 3000, "en"), (None, None, "de"), (1002, "", ""), (1003, " .,\t", "es")]
    return rows


@pytest.mark.parametrize("slice_words, budget", [(1 << 21, 1 << 21), (500, 200)])
def test_equals_counting(spark, slice_words, budget):
    rows = rows_of(3, 120, 30)
    got = collocations.collocations(spark.createDataFrame(rows, COLUMNS), least=12, top=60, slice_words=slice_words, budget=budget)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 12, 60)


def test_extends_prefixes(spark, monkeypatch):
    """A small budget extends words, pairs and triples, and the counts stay right."""
    rows = [(i, "a a a a b c a a d " * 30, "en") for i in range(100)]
    plans, plan_of = [], collocations.plan_of
    monkeypatch.setattr(collocations, "plan_of", lambda *given: plans.append(plan_of(*given)) or plans[-1])
    got = collocations.collocations(spark.createDataFrame(rows, COLUMNS), least=30, budget=3000).collect()
    assert all(len(plans[0].levels[depth][0]) for depth in range(3))
    assert sorted(tuple(r) for r in got) == brute(rows, 30, 2000)


def test_scores_beyond_64_bits(spark):
    big = 1 << 50
    words = spark.createDataFrame([(1, big + 7, "x", bytearray(b"p")), (2, big, "x", bytearray(b"q"))], "id long, f long, lang string, word binary")
    nodes = spark.createDataFrame([(1, 2, 0, 0, big - 1)], "a long, b long, c long, d long, f long")
    assert collocations.scored(words, nodes).first()["score"] == 2_000_000 * (big - 1) // (2 * big + 7)


def test_empty_and_other_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert collocations.collocations(empty).collect() == []
    rows = [(1, "x y " * 40, "en", {"a": 1}, "z")] * 2
    extra = spark.createDataFrame(rows, COLUMNS + ", word map<string,int>, `f.id` string")
    assert [tuple(r) for r in collocations.collocations(extra).collect()] == brute([r[:3] for r in rows], 30, 2000)


def test_ties_fall_to_the_smaller_phrase(spark):
    rows = [(1, "b c. a c. é c. z c.", "en")] * 30
    got = [r["phrase"] for r in collocations.collocations(spark.createDataFrame(rows, COLUMNS), top=3).collect()]
    assert sorted(got) == ["a c", "b c", "z c"]
