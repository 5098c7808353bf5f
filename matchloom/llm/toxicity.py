"""Toxicity scoring with Levenshtein automata over a lexicon trie.

The lexicon is learned from labelled rows and laid out as a trie. For a word of the text, the states of
its Levenshtein automaton (one row of edit distances per trie node) are carried down the trie, and a
branch is left as soon as no state is within the allowed distance; so one walk finds all terms within
that distance, misspelled ones too. Words of four letters or more may have one edit (a swap of two letters
is two edits and is not found). A word that clean rows of the sample use is never taken for a misspelling.
Whether a word can have a hit at all is told before the walk by its forms with one letter left out; the
walk finds which term it is. Each hit is weighed by its surroundings: inside quotation marks, or
near words of reporting, it counts as quoted, otherwise as abuse. A logistic model on the counts gives
the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, may_learn
from .secrets import _arrow_type

#: Digits may stand for letters in misspellings, so they belong to words.
WORD = re.compile(r"[^\W_]+")
QUOTES = "\"'“”„«»‘’"
#: Words that mark reported speech.
REPORTING = frozenset("said says quote quoted quotes called wrote term word words phrase dit mot cité sagte wort zitat dijo palabra cita".split())
WINDOW = 6
FEATURES = 6


class Trie:
    """Nodes as dicts of letters; a term's end carries the term."""

    def __init__(self, terms):
        self.root: dict = {}
        for t in terms:
            node = self.root
            for c in t:
                node = node.setdefault(c, {})
            node[""] = t

    def within(self, word: str) -> tuple[str, int] | None:
        """The nearest term at distance 1 or less (ties: first in order) and its distance.

        The automaton's states are two bit sets, for no edit and for one: bit j says that j letters of the word
        are used up. A branch is left when both are empty.
        """
        places: dict[str, int] = {}
        for j, c in enumerate(word):
            places[c] = places.get(c, 0) | 1 << j
        all_bits, done = (2 << len(word)) - 1, 1 << len(word)
        best: tuple[int, str] | None = None
        work = [(self.root, 1, 3 & all_bits)]
        while work:
            node, none, one = work.pop()
            for c, child in node.items():
                if c == "":
                    if one & done:
                        found = (0 if none & done else 1, child)
                        best = found if best is None else min(best, found)
                    continue
                here = places.get(c, 0)
                none_next = (none & here) << 1
                one_next = ((one & here) << 1 | none | none << 1 | none_next << 1) & all_bits
                if one_next:
                    work.append((child, none_next, one_next))
        return (best[1], best[0]) if best else None


def allowed(word: str) -> int:
    """Edits that a word of this length may have: none below four letters, then one."""
    return 0 if len(word) < 4 else 1


def _shortened(word: str) -> list[str]:
    return [word, *(word[:i] + word[i + 1 :] for i in range(len(word)))]


class _Hits(dict):
    """Word to its hit or None. Forgets everything when full."""

    def __init__(self, owner):
        super().__init__()
        self.owner = owner

    def __missing__(self, word: str):
        if len(self) >= 400_000:
            self.clear()
        hit = self[word] = self.owner.lookup(word)
        return hit


@dataclass(frozen=True)
class Model:
    """Terms with their log-odds, the weights of the logistic model (the last one is the constant), and words near a term that are no misspellings."""

    terms: tuple[tuple[str, float], ...]
    weights: tuple[float, ...] = field(default=())
    clean: frozenset[str] = field(default=frozenset())


class Matcher:
    def __init__(self, model: Model):
        self.model = model
        self.odds = dict(model.terms)
        self.trie = Trie(sorted(self.odds))
        self.known = _Hits(self)
        # Words at distance 1 or less share a form with one letter deleted (or none); others need no walk.
        self.near = {f for t in self.odds for f in _shortened(t)}

    def lookup(self, word: str) -> tuple[str, int] | None:
        if word in self.odds:
            return word, 0
        if allowed(word) and word not in self.model.clean and any(map(self.near.__contains__, _shortened(word))):
            return self.trie.within(word)
        return None

    def features(self, text: str | None) -> list[float]:
        """Log counts of abusive exact hits, abusive misspellings, quoted hits; hits per word; sum of odds; any hit."""
        text = text or ""
        low = text.lower()
        words = WORD.findall(low)
        known = self.known
        if not any(map(known.__getitem__, words)):
            return [0.0] * FEATURES
        exact = wrong = quoted = odds = 0.0
        spans = [(m.start(), m.end()) for m in WORD.finditer(low)]
        opened = _quoted_stretches(low)
        begins = [x for x, _ in opened]
        for i, w in enumerate(words):
            hit = known[w]
            if not hit:
                continue
            a, b = spans[i]
            around = words[max(0, i - WINDOW) : i + WINDOW + 1]
            at = bisect_right(begins, a) - 1  # stretches do not overlap
            if (at >= 0 and b <= opened[at][1]) or any(x in REPORTING for x in around):
                quoted += 1
                continue
            odds += self.odds[hit[0]] * (1 if hit[1] == 0 else 0.6)
            if hit[1] == 0:
                exact += 1
            else:
                wrong += 1
        return [math.log1p(exact), math.log1p(wrong), math.log1p(quoted), math.log1p(100 * (exact + wrong) / len(words)), math.log1p(max(0.0, odds)), float(exact + wrong > 0)]

    def score(self, text: str | None) -> float:
        w = self.model.weights
        if not w:
            return 0.0
        z = sum(a * b for a, b in zip(w, self.features(text), strict=False)) + w[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _quoted_stretches(text: str) -> list[tuple[int, int]]:
    """Stretches of at most 300 characters between quotation marks of one line."""
    if not any(q in text for q in QUOTES):
        return []
    return [m.span() for m in re.finditer(r"[\"“„«][^\"“”„«»\n]{1,300}[\"”“»]|(?<!\w)['‘][^'‘’\n]{1,300}['’](?!\w)", text)]


@lru_cache(maxsize=2)
def _matcher(model: Model) -> Matcher:
    return Matcher(model)


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample_rows: int = 12_000, lexicon_terms: int = 400, min_contexts: int = 3, min_share: float = 0.01) -> Model:
    """A model from a bounded sample of labelled rows.

    Only rows that may be learned from (see ``may_learn``) with a 0/1 label count; of those, about ``sample_rows``
    are drawn by a hash of the id, the same on each run. A word is counted once for each different word before it,
    so that copies of one text count once. A term of the lexicon has at least ``min_contexts`` such contexts, and
    at least ``min_share`` for each toxic row, and is twenty times as frequent in toxic rows as in the others.
    Words of clean rows that are one edit from a term are kept, so that they are not taken for it.
    Without rows of both kinds the model is empty and scores 0.
    """
    labelled = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(may_learn("id") & F.col("label").isin(0, 1)).groupBy("id").agg(F.max("label").alias("label"))
    total = labelled.count()
    if not total:
        return Model(())
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("toxicity")), F.lit(1 << 30)) / float(1 << 30)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(draw < min(1.0, sample_rows / total))
    sample = texts.join(labelled.filter(draw < min(1.0, sample_rows / total)), "id").filter(F.col("text").isNotNull())
    found = sample.select("label", F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)).alias("w"))
    pairs = found.select("label", F.explode(F.arrays_zip(F.col("w").alias("word"), F.concat(F.array(F.lit("")), F.col("w")).alias("before"))).alias("p")).select("label", "p.word", "p.before")
    words = pairs.filter(F.length("word") >= 3).distinct()
    seen = sample.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in seen}
    if len(n) < 2:
        return Model(())
    odds = F.log((F.col("bad") + 0.5) / (n[1] + 1.0)) - F.log((F.col("good") + 0.5) / (n[0] + 1.0))
    top = words.groupBy("word").agg(F.sum("label").alias("bad"), F.sum(1 - F.col("label")).alias("good")).filter(F.col("bad") >= max(min_contexts, min_share * n[1])).withColumn("odds", odds).filter(F.col("odds") > math.log(20.0))
    terms = tuple(sorted((r["word"], float(r["odds"])) for r in top.orderBy(F.desc(F.col("odds") * F.sqrt("bad")), "word").limit(lexicon_terms).collect()))
    if not terms:
        return Model((), (0.0,) * FEATURES + (math.log((n[1] + 0.5) / (n[0] + 0.5)),))
    # words of clean rows that are near a term: at most what the edits of lexicon_terms words give
    near = docs.sparkSession.sparkContext.broadcast(Model(terms))

    def near_terms(found: list) -> list:
        m = _matcher(near.value)
        return [[w for w in found if w not in m.odds and m.known[w]]]

    usual = words.filter("label = 0").select("word").distinct()
    clean = frozenset(r["word"] for r in map_rows(usual, near_terms, [pa.field("word", pa.string())], "word string").collect())
    bare = docs.sparkSession.sparkContext.broadcast(Model(terms, clean=clean))

    def rows(labels_: list, texts_: list) -> list:
        m = _matcher(bare.value)
        return [labels_, [m.features(t) for t in texts_]]

    fields = [pa.field("label", pa.int32()), pa.field("x", pa.list_(pa.float64()))]
    got = map_rows(sample.select("label", "text"), rows, fields, "label int, x array<double>").groupBy("label", "x").count().collect()
    x = np.array([[*r["x"], 1.0] for r in got])
    y = np.array([r["label"] for r in got], float)
    return Model(terms, tuple(_fit(x, y, np.array([r["count"] for r in got], float))), clean)


def _fit(x: np.ndarray, y: np.ndarray, count: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (count * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (count * (y - p)) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, score from 0 to 1, 1 if the score reaches ``threshold``.

    Null and empty texts get the score of a text without any hit. Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by lexicon_terms

    def rows(ids: list, texts: list) -> list:
        m = _matcher(shared.value)
        scores = [m.score(t) for t in texts]
        return [ids, scores, [int(s >= threshold) for s in scores]]

    fields = [pa.field("doc_id", _arrow_type(docs, id_col)), pa.field("score", pa.float64()), pa.field("predicted", pa.int32())]
    return map_rows(docs.select(id_col, text_col), rows, fields, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double, predicted int")
