"""Vector codes against plain loops; the registered query has SQL."""

import hashlib
import math
import random

import numpy as np
import pytest

from matchloom.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows, parts=16, entries=64, rounds=2):
    kept = [(i, v, b) for i, v, b, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    whole = lambda v: [math.floor(256 * float(np.float32(x))) for x in v]
    kept = sorted(((i, whole(v), b) for i, v, b in kept), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda p, x: min(range(len(books[p])), key=lambda e: (apart(books[p][e], x), e))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                groups.setdefault(near(p, cut(v, p)), []).append(cut(v, p))
            for e, some in groups.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    coded = []
    for i, v, b in kept:
        codes = [near(p, cut(v, p)) for p in range(parts)]
        coded.append((i, b, "".join(f"{c:02x}" for c in codes), sum(apart(books[p][c], cut(v, p)) for p, c in enumerate(codes))))
    return sorted(((i, c, e, sum(x[3] for x in coded if x[1] == b), digest) for i, b, c, e in coded), key=str)


def vectors(n, dims, seed=1):
    r = random.Random(seed)
    return [(i, [r.uniform(-1, 1) for _ in range(dims)], r.choice([None, 0, 0, 0, 1]), "clash") for i in range(n)]


@pytest.mark.parametrize(("n", "dims"), [(130, 32), (40, 16), (1, 16)])
def test_codes(spark, n, dims):
    rows = vectors(n, dims)
    rows += [(1000, None, 1, ""), (1001, [], 1, ""), (1002, [None] * dims, 1, ""), (1003, [float("nan")] * dims, 2, ""), (1004, [float("-inf")] + [0.0] * (dims - 1), 3, "")]
    rows += [rows[0], (None, rows[0][1], None, ""), (2000, [0.0] * dims, 1, ""), (2001, [0.0] * dims, 1, "")]
    got = vectorcodes.compress(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_many_blocks_and_few(spark, monkeypatch):
    rows = vectors(300, 16, 3)
    want = brute(rows)
    monkeypatch.setattr(vectorcodes, "BLOCK", 16 * 7)
    for parts in (1, 9):
        assert sorted(map(tuple, vectorcodes.compress(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()), key=str) == want


def test_other_lengths_large_components_and_nothing(spark):
    rows = [(i, [float(i)] * 16, 0, "") for i in range(5)] + [(7, [1.0] * 32, 0, ""), (8, [1.0] * 15, 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted(r["vec_id"] for r in vectorcodes.compress(df).collect()) == [0, 1, 2, 3, 4]
    huge = spark.createDataFrame([(0, [3e38] * 16, 0, ""), (1, [-3e38] * 16, 0, ""), (2, [0.0] * 16, 0, "")], SCHEMA)
    assert [r["error"] for r in vectorcodes.compress(huge).collect()] == [0, 0, 0]
    empty = vectorcodes.compress(df.limit(0))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and empty.count() == 0
