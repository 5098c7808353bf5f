"""Ranked search over bit slices against plain sums; the registered query has SQL."""

import collections
import math
import random
import re

import numpy as np
import pytest

from matchloom.llm import impacts

DOCS, ITEMS = "doc_id long, text string, score long, rank int", "item_id long, text string, doc_id long"


def brute_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k):
    terms = [(i, collections.Counter(brute_terms(t))) for i, t, *_ in docs]
    total, length = sum(bool(c) for _, c in terms), sum(c.total() for _, c in terms)
    df = collections.Counter(t for _, c in terms for t in c)
    asked = collections.defaultdict(set)
    for i, t, *_ in items:
        asked[i] |= set(brute_terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for i, c in terms:
            score = 0
            for t in wanted & set(c):
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                m = 100 - 50 + (50 * c.total() * total) // length
                score += w * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(found)[:k], start=1)]
    return sorted(out, key=str)


def tables():
    r = random.Random(2)
    vocabulary = [r.choice("abcXYZ") + str(n) for n in range(150)]
    prose = lambda n: " ".join(r.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=n))
    texts = [prose(r.randint(0, 60)) for _ in range(400)] + [prose(8000), None, "", "...", "ÀÉ àé Straße 你好"]
    texts += [texts[5]] * 90  # ties beyond k
    docs = [(i, t, 1, 1) for i, t in enumerate(texts)] + [(None, texts[5], 1, 1), (5, texts[5], 1, 1)]
    items = [(i, prose(r.randint(1, 40)), 9) for i in range(25)] + [(99, texts[5], 9), (98, None, 9), (97, "unheard-of", 9), (None, "a0 b1 X2 straße", 9), (3, "你好 extra", 9), (96, prose(3000), 9)]
    return docs, items


@pytest.mark.parametrize(("parts", "block_docs", "block_postings", "batch"), [(1, 65_536, 10**6, 10**6), (4, 70, 10**6, 10**6), (3, 1000, 500, 100)])
def test_search(spark, monkeypatch, parts, block_docs, block_postings, batch):
    docs, items = tables()
    monkeypatch.setattr(impacts, "AT_ONCE", 300)
    index = impacts.build_index(spark.createDataFrame(docs, DOCS).repartition(parts), block_docs=block_docs, block_postings=block_postings)
    got = impacts.search(index, spark.createDataFrame(items, ITEMS), batch_terms=batch)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 50)


def test_nothing(spark):
    docs, items = spark.createDataFrame(tables()[0], DOCS), spark.createDataFrame(tables()[1], ITEMS)
    assert impacts.search(impacts.build_index(docs.limit(0)), items).count() == 0
    assert impacts.search(impacts.build_index(docs), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert impacts.search(impacts.build_index(docs), items.limit(0)).count() == 0


def test_carries_and_slices():
    r = np.random.default_rng(1)
    for n, k in ((1, 1), (9, 3), (40, 7)):
        numbers = r.integers(0, 2**20, (n, 64)) * (r.random((n, 64)) < 0.7)
        bits = lambda x: np.stack([np.packbits((x >> s & 1).astype(bool), axis=-1, bitorder="little").view(np.uint64)[:, 0] for s in range(30)])
        keys = np.sort(r.integers(0, 4, n))
        own, slices = impacts.added_up(keys, bits(numbers))
        sums = np.stack([numbers[keys == x].sum(axis=0) for x in own])
        assert (slices == bits(sums)).all()
        column, bit, score = impacts.best(slices, np.arange(len(own)), k)
        for c, row in enumerate(sums):
            want = sorted(((-s, i) for i, s in enumerate(row.tolist()) if s), key=tuple)[:k]
            here = column == c
            assert sorted(zip((-score[here]).tolist(), bit[here].tolist(), strict=True)) == want
