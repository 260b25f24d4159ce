"""Ranked search next to a plain score of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_llm import ODD, fixture_texts
from pyspark.sql import functions as F

from barsmith.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_ranks(docs, items, k=10):
    found = [(i, Counter(plain_terms(t))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    count, length = len(found), sum(sum(c.values()) for _, c in found)
    holding = Counter(t for _, c in found for t in c)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, c in found:
            n = sum(c.values())
            m = 100 - 90 + (90 * n * count) // length
            score = 0
            for term in set(plain_terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * count + 2) / (2 * holding[term] + 1)))
                score += w * ((1000000000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id))
        scores.sort()
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, doc_id) in enumerate(scores[:k], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({"n": F.lit(1), "terms": F.lit("x")})
    q = spark.createDataFrame(items, "item_id bigint, text string").withColumn("rank", F.lit(3))
    return sorted(map(tuple, lexical.ranked(d, q, **more).collect()), key=str)


def test_terms():
    for text in (*[t for t in ODD if t], "A-b_c'd 1.5é×🙂z\x7fQ\x80 x　y", "\x00a\x00"):
        assert [t.decode() for t in lexical.terms(text.encode())] == plain_terms(text)


def made(rng, n, words=60):
    vocabulary = [f"w{i}" for i in range(words)]
    return [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(words)], k=rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("items_a_pass", [256, 5])
def test_ranks(spark, items_a_pass):
    rng = random.Random(8)
    texts = made(rng, 400) + ODD + fixture_texts(60)
    docs = [(i * 7 % 991, t) for i, t in enumerate(texts)] + [(None, texts[1]), (None, texts[2]), (3, texts[1]), (3, texts[1])]
    items = [(i, t) for i, t in enumerate(made(rng, 18))] + [(90, None), (91, ""), (92, "none of these"), (93, ODD[4]), (94, texts[5])]
    items += [(None, "w3 w4"), (None, "w5"), (95, "w1"), (95, "w2")]
    assert run(spark, docs, items, items_a_pass=items_a_pass) == plain_ranks(docs, items)


def test_equal_items_are_one_and_copies_of_a_document_are_not(spark):
    docs = [(i, "hot passage of some words") for i in range(3000)] + [(9000 + i, f"own{i} words") for i in range(50)]
    items = [(1, "hot passage"), (1, "hot passage"), (2, "own7 words")]
    got = run(spark, docs, items)
    assert got == plain_ranks(docs, items[1:])
    assert [g[2] for g in sorted(got) if g[0] == 1] == list(range(10))


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == [] == run(spark, [(1, "a")], [])
    assert run(spark, [(1, None), (2, "")], [(1, "a")]) == []


def test_blocks_are_skipped_and_nothing_is_lost():
    """Shards searched one after another leave out most documents, and find what a full score finds."""
    rng = np.random.default_rng(3)
    terms, shards = 300, 4
    weights = np.sort(rng.integers(1, 9000, terms))[::-1]
    items = [np.sort(rng.choice(terms, 12, replace=False)) for _ in range(20)]
    search, all_docs = lexical.Search(weights, items), []
    for shard in range(shards):
        matrix = np.zeros((500, terms), np.int32)
        for group in range(10):  # documents of a group are alike
            liked = rng.choice(terms, 25, replace=False)
            for row in range(group * 50, group * 50 + 50):
                matrix[row, rng.choice(liked, 12)] = rng.integers(1, 100_000, 12)
        ids = np.column_stack([np.zeros(500, int), np.arange(500) + 500 * shard])
        search.shard(ids, matrix)
        all_docs.append(matrix.astype(np.int64))
    matrix = np.concatenate(all_docs)
    for places, best in zip(items, search.best):
        scores = matrix[:, places] @ weights[places]
        order = np.lexsort((np.arange(len(matrix)), -scores))[:10]
        order = order[scores[order] > 0]
        assert best.rows[:, 2].tolist() == order.tolist() and best.rows[:, 0].tolist() == scores[order].tolist()
    holding = sum(int((matrix[:, places] > 0).any(axis=1).sum()) for places in items)
    assert search.scored < 0.7 * holding
