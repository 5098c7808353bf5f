"""The n-gram model against plain dictionaries."""

import collections
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from matchloom.llm import ngrams

SCHEMA = "doc_id long, text string, score double, n_tokens long"


def brute_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", lowered), None]


class Brute:
    """Counts of n-grams as a formula has them, one dictionary for each order."""

    def __init__(self, texts, order):
        self.order, train = order, [brute_words(t) for t in texts]
        self.c = collections.Counter(w for t in train for w in t)
        self.total, self.vocabulary = sum(self.c.values()), len(self.c)
        padded = [["<start>"] * (order - 1) + t for t in train]
        self.grams = {order: collections.Counter(tuple(p[j : j + order]) for p in padded for j in range(len(p) - order + 1))}
        for n in range(order - 1, 0, -1):
            self.grams[n] = collections.Counter(k[1:] for k in self.grams[n + 1])
        self.contexts = {n: collections.defaultdict(list) for n in self.grams}
        for n, grams in self.grams.items():
            for k, v in grams.items():
                self.contexts[n][k[:-1]].append(v)
        self.discounts = {n: self.discount(g.values()) for n, g in self.grams.items()}

    @staticmethod
    def discount(counts):
        n1, n2, n3, n4 = (sum(v == k for v in counts) for k in (1, 2, 3, 4))
        if not (n1 and n2 and n3 and n4):
            return 0.5, 1.0, 1.5
        y = n1 / (n1 + 2 * n2)
        found = 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3
        return tuple(d if 0 < d < k else u for k, d, u in zip((1, 2, 3), found, (0.5, 1.0, 1.5), strict=True))

    def probability(self, before, word, n):
        if n == 0:
            return 1 / (self.vocabulary + 1)
        lower = self.probability(before[1:], word, n - 1)
        seen = self.contexts[n].get(before)
        if not seen:
            return lower
        taken = [self.discounts[n][min(v, 3) - 1] for v in seen]
        count = self.grams[n].get((*before, word), 0)
        own = count - self.discounts[n][min(count, 3) - 1] if count else 0
        return max(own, 0) / sum(seen) + sum(taken) / sum(seen) * lower

    def score(self, text):
        words = brute_words(text)
        padded = ["<start>"] * (self.order - 1) + words
        base = sum(math.log10((self.c[w] + 1) / (self.total + 1 * (self.vocabulary + 1))) for w in words)
        score = sum(math.log10(self.probability(tuple(padded[j : j + self.order - 1]), w, self.order)) for j, w in enumerate(words))
        return len(words), sum(self.c[w] > 0 for w in words), self.total, base, score


def texts():
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdEFG") for _ in range(r.randint(1, 4))) for _ in range(120)]
    prose = lambda n: " ".join(r.choices(vocabulary, weights=range(len(vocabulary), 0, -1), k=n))
    out = [prose(r.randint(0, 90)) for _ in range(120)]
    # one context with a third of all tokens, repeated texts, nothing, white space, a very long text, tokens like the model's own
    return out + [" ".join("hot " + w for w in prose(4000).split())] + [out[7]] * 4 + [None, "", " \t\n", prose(5000), "end start end", " start\x0bEND ", "Ünïcode ÄÖ Äö x"]


def learned(spark, order, bucket_bytes):
    rows = [(i, t, 1.0, 2) for i, t in enumerate(texts())] + [(None, "a null id", 1.0, 2), (3, texts()[3], 1.0, 2)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = ngrams.learn(docs.filter(ngrams.for_training("doc_id")), order=order, bucket_bytes=bucket_bytes)
    return rows, docs, model


@pytest.mark.parametrize(("order", "bucket_bytes"), [(2, 12 << 20), (2, 2000), (3, 4000), (4, 8000)])
def test_scores(spark, order, bucket_bytes):
    rows, docs, model = learned(spark, order, bucket_bytes)
    assert bucket_bytes > 10_000 or len(model.split[1])  # the hot context is split
    trained = [t for i, t, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    brute = Brute(trained, order)
    got = sorted(ngrams.score_documents(docs, model).collect(), key=str)
    assert len(got) == len(rows)
    want = {i: (i is not None and zlib.crc32(str(i).encode()) % 7 == 2, *brute.score(t)) for i, t, *_ in rows}
    for r in got:
        held, n, known, total, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert (r["base_score"], r["score"]) == (pytest.approx(base, rel=1e-12), pytest.approx(score, rel=1e-12))
        assert r["perplexity"] == pytest.approx(10 ** (-score / n))


def test_probabilities_sum_to_one(spark):
    _, _, model = learned(spark, 2, 2000)
    known = sorted({w for t in texts() for w in brute_words(t)[:-1]})
    place = model.folder.removeprefix("file:")
    import numpy as np

    words = [f"hot {w}" for w in known]
    # the words after one context, the end, and a word never seen, whose share stands for all others
    some = np.concatenate([ngrams.tokens(t)[:-1] for t in words] + [ngrams.tokens("hot"), ngrams.tokens("hot neverseen")[:-1]])
    lengths = np.array([2] * len(words) + [2, 2])
    log, raw = ngrams.log_probabilities(model, place, some, lengths)
    counted = {w for t in [x for i, x in enumerate(texts()) if zlib.crc32(str(i).encode()) % 7 != 2] + [texts()[3]] for w in brute_words(t)}
    keep = [w in counted for w in known] + [True, True]
    assert (10 ** log[1::2])[keep].sum() == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(2, "a b", 0.0, 0), (3, None, 0.0, 0)], SCHEMA)
    model = ngrams.learn(docs.limit(0))
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in ngrams.score_documents(docs, model).orderBy("doc_id").collect()] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert ngrams.score_documents(docs.limit(0), model).count() == 0


def test_a_second_write_leaves_the_model_as_it_was(spark):
    rows, docs, model = learned(spark, 2, 2000)
    first = ngrams.score_documents(docs, model).select("doc_id", "score").collect()
    again = learned(spark, 2, 5000)[2]
    assert sorted(map(str, first)) == sorted(map(str, ngrams.score_documents(docs.orderBy(F.desc("doc_id")), again).select("doc_id", "score").collect()))
    ngrams.forget(spark, again)
