"""Ranked lexical search against a plain Python version."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from plyspark.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    lists = [(i, terms(t)) for i, t in docs]
    n_docs, total = sum(bool(t) for _, t in lists), sum(len(t) for _, t in lists)
    df = Counter(w for _, t in lists for w in set(t))
    out = []
    for item, text in items:
        found = []
        for doc, words in lists:
            tf = Counter(words)
            m = 100 - 75 + (75 * len(words) * n_docs) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 8 * m))
                for w in terms(text) if tf[w]
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        out += [(item, r + 1, doc, -s) for r, (s, _, _, doc) in enumerate(found[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted([(r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()], key=str)


DOCS = [
    (1, "the cat sat on the mat"), (2, "The CAT; sat-on_the.mat"), (3, None), (4, ""), (5, " .,! "),
    (6, "É é naïve Ünder cat dog"), (7, "dog " * 500), (8, "cat"), (8, "cat"), (None, "cat dog"), (None, None),
    (9, "the the the"), (10, "x" * 5000 + " mat"), (11, "cat 42 mat 42"), (12, "a\x00b\x7fc"),
]
ITEMS = [(1, "cat mat"), (2, "Cat cat DOG 42"), (3, None), (4, ""), (5, "unknown"), (6, "é naïve"), (1, "the"), (None, "c b a")]


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("x")).withColumn("_id", F.lit(0)),
        spark.createDataFrame(items, "item_id long, text string").withColumn("_text", F.lit(1)).withColumn("rank", F.lit(1)),
    )


def test_matches_brute_force(spark):
    assert rows(ls.search(*frames(spark, DOCS, ITEMS))) == brute(DOCS, ITEMS)


def test_many_blocks_and_fewer_results(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert rows(ls.search(docs, items, k=2, block_bytes=8)) == brute(DOCS, ITEMS, 2)


def test_copies_tie_by_identifier(spark):
    docs = [(i, "one two three") for i in range(3000, 0, -1)] + [(0, "four")]
    found = rows(ls.search(*frames(spark, docs, [(1, "two four")])))
    assert found == brute(docs, [(1, "two four")])


def test_empty_tables(spark):
    docs, items = frames(spark, DOCS, ITEMS)
    assert ls.search(docs.limit(0), items).count() == 0
    assert ls.search(docs, items.limit(0)).count() == 0
    assert ls.search(docs.where("doc_id in (3, 4, 5)"), items).count() == 0


@pytest.mark.parametrize("most", [1, 2, 7, 50])
def test_pieces_of_a_long_text_hold_its_terms(most, monkeypatch):
    monkeypatch.setattr(ls, "PIECE_BYTES", most)
    rng = np.random.default_rng(most)
    text = "".join(rng.choice(list("ab é."), 400)) + "z" * 200 + " ab " + "y" * 101
    vocabulary = ls.Vocabulary(["ab a b é bb"])
    import pyarrow as pa

    counts, total = Counter(), 0
    for _, n, _, number, times in ls.term_counts(pa.array([text]), vocabulary):
        total += int(n.sum())
        counts.update({vocabulary.words[i].decode(): int(c) for i, c in zip(number, times)})
    expected = Counter(terms(text))
    assert total == sum(expected.values())
    assert counts == {w: c for w, c in expected.items() if w.encode() in vocabulary.words}


def test_terms_are_cut_below_2_to_the_53():
    weight = np.array([30_000, 20_000, 1, 29_000])
    items = [Counter({0: 400_000, 1: 200_000, 2: 3}), Counter({1: 1, 2: 1, 3: 310_000})]
    tile = ls.ItemTile(items, weight)
    assert len(tile.cuts) > 2
    for a, b in zip(tile.cuts[:-1], tile.cuts[1:]):
        bound = max(sum(int(x) * ls.IMPACT_BOUND for x in column) for column in tile.weights[a:b].T)
        assert bound < 1 << 53 or b - a == 1
    impact = np.array([999_983, 999_979, 7, 123_457])
    scores = tile.scores(1, np.zeros(4, int), np.arange(4), impact)
    exact = [sum(times * int(weight[t]) * int(impact[t]) for t, times in item.items()) for item in items]
    assert scores.tolist() == [exact]
