"""The multi-index of decontamination: whole within its radius, and what decides."""

import random

from pyspark.sql import functions as F

from matchloom.llm import decontaminate


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_all_within_the_radius(spark, monkeypatch):
    r = random.Random(3)
    items = [(i, r.randint(1, 3), r.getrandbits(64)) for i in range(12)]
    marked, want = [], set()
    for k in range(300):
        i, n, fp = items[k % 12]
        flipped = fp
        for b in r.sample(range(64), r.randint(0, 26)):
            flipped ^= 1 << b
        marked.append((k, 0, n if k % 7 else n + 1, signed(flipped)))
    for k, _, n, fp in marked:
        want |= {(k, i) for i, m, item in items if m == n and bin((fp ^ item) & (2**64 - 1)).count("1") <= decontaminate.RADIUS}
    # fingerprints are given, so that the index is tested on its own
    monkeypatch.setattr(decontaminate, "fingerprint", lambda c: F.get(c, F.lit(0)))
    bench = spark.createDataFrame([(i, n, [signed(fp)]) for i, n, fp in items], "item_id long, n int, item_shingles array<long>")
    index = decontaminate.multi_index(bench, decontaminate.RADIUS)
    got = decontaminate.near_items(spark.createDataFrame(marked, "doc_id long, tk long, n int, fp long"), index, decontaminate.RADIUS)
    assert {(x.doc_id, x.item_id) for x in got.collect()} == want and 100 < len(want) < 300


def test_the_index_decides(spark, monkeypatch):
    text = " ".join(f"w{k}" for k in range(30))
    docs = spark.createDataFrame([(1, text), (2, "other " + text), (3, "nothing of it at all here")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text)], "item_id long, text string")
    assert sorted((x.doc_id, x.start_word) for x in decontaminate.find_leaks(docs, bench).collect()) == [(1, 0), (2, 1)]
    whole = decontaminate.multi_index
    monkeypatch.setattr(decontaminate, "multi_index", lambda b, radius: whole(b, radius).limit(0))
    assert decontaminate.find_leaks(docs, bench).count() == 0
