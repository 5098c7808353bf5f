"""Similarity of many pairs at a time against the functions of one pair, and how long it may take."""

import random
import time

import numpy as np
import pandas as pd

from matchloom.functions import names as N
from matchloom.functions import similarity
from matchloom.functions import vocabulary as V

MEASURES = {
    "plain": (lambda p: p.plain(), N.ratio),
    "strict": (lambda p: p.strict(), N.sort_ratio),
    "sets": (lambda p: p.sets(), N.set_ratio),
    "score": (lambda p: p.score(), lambda a, b: max(N.set_ratio(a, b), N.sort_ratio(a, b))),
}


def room_pair(a, b):
    bare = [" ".join(t for t in n.split() if t not in V.FILLER) for n in (a, b)]
    return max(max(N.set_ratio(x, y), N.sort_ratio(x, y)) for x, y in ((a, b), bare))


def some_names(r, n, most):
    vocabulary = ["room", "rooms", "sea", "view", "king", "été", "酒店", "a", "aa", "suite", "2", "x" * 70, "deluxe", "apartment"]
    return ["", " ", "room"] + [" ".join(r.choices(vocabulary, k=r.randint(0, most))) for _ in range(n)]


def test_equal_to_one_pair():
    r = random.Random(7)
    for most in (3, 9, 45):
        names = some_names(r, 60, most)
        a, b = (pd.Series(r.choices(names, k=500)) for _ in range(2))
        for measure, one in (*MEASURES.values(), (lambda p: p.rooms(frozenset(V.FILLER)), room_pair)):
            got = similarity.pairwise(a, b, measure, N._One)
            assert got.tolist() == [one(x, y) for x, y in zip(a, b)]


def test_nulls_and_nothing():
    got = similarity.pairwise(pd.Series([None, "a", None], dtype=object), pd.Series(["a", None, None], dtype=object), lambda p: p.plain(), N._One)
    assert got.tolist() == [0.0, 0.0, 100.0]
    assert similarity.pairwise(pd.Series([], dtype=object), pd.Series([], dtype=object), lambda p: p.score(), N._One).tolist() == []


def test_faster_than_pair_by_pair():
    r = random.Random(3)
    names = [" ".join(r.choices("large ring economy king standard suite deluxe view accessible blue bolt sea".split(), k=6)) for _ in range(300)]
    a, b = pd.Series(np.repeat(names[:100], 100)), pd.Series(np.tile(names[100:200], 100))
    start = time.process_time()
    many = similarity.pairwise(a, b, lambda p: p.score(), N._One)
    middle = time.process_time()
    one = [MEASURES["score"][1](x, y) for x, y in zip(a, b)]
    assert many.tolist() == one
    assert middle - start < (time.process_time() - middle) / 3


def test_pairs_of_rooms_are_not_shuffled(spark):
    """Rooms go to where their lots meet; no exchange stands above the join that makes the pairs."""
    from matchloom.operators import mapping

    a = spark.createDataFrame([(1, i, f"King Room {i}") for i in range(6)], "hotel_id long, a_id long, room_name string")
    b = spark.createDataFrame([(1, i, f"King Suite {i}") for i in range(6)], "hotel_id long, b_id long, room_name string")
    p = mapping.pairs(a, b)
    assert p.count() == 36
    plan = p._jdf.queryExecution().optimizedPlan().toString().splitlines()
    meets = next(i for i, line in enumerate(plan) if "Join" in line and "_lot" in line)
    assert not any("Repartition" in line or "Aggregate" in line for line in plan[:meets])
