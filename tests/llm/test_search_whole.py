"""The registered search takes every word of a query's whole text."""

import collections
import math
import random

from matchloom.llm import bm25, queries

from .test_operators import DOCS


def test_whole_texts(spark, tmp_path):
    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join([*r.choices(vocabulary, k=r.randint(30, 300)), f"only{i}"]), "en", "s", 1) for i in range(120)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    tf = {i: collections.Counter(bm25.words(t)) for i, t, *_ in rows}
    size = {i: sum(c.values()) for i, c in tf.items()}
    mean, df = sum(size.values()) / len(rows), collections.Counter(t for c in tf.values() for t in c)
    idf = {t: math.log(1 + (len(rows) - n + 0.5) / (n + 0.5)) for t, n in df.items()}
    want = {}
    for q in (0, 50, 100):
        score = {i: round(sum(idf[t] * c[t] * 2.2 / (c[t] + 1.2 * (0.25 + 0.75 * size[i] / mean)) for t in tf[q] if t in c), 6) for i, c in tf.items()}
        best = sorted((-s, i) for i, s in score.items() if s > 0)[:10]
        want |= {(q, k + 1): (i, -s) for k, (s, i) in enumerate(best)}
    got = {(x.query_id, x.rank): (x.doc_id, x.score) for x in queries.op7_topk_search(spark, str(tmp_path)).collect()}
    assert got.keys() == want.keys()
    assert all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)
