"""A shard looks up each term of a block of queries once, however many queries have it."""

import numpy as np

from matchloom.llm import bm25


def test_queries_strung_together(spark):
    rows = [(i, " ".join(f"w{(i * j) % 31}" for j in range(1, 20))) for i in range(200)] + [(None, "w1 w2"), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    shard = bm25.Shard(*bm25.build_shards(docs, 10**9, "doc_id", "text").first(), 19.0)
    queries = [([b"w1", b"w2", b"none"], np.array([1.0, 2.0, 3.0])), ([], np.zeros(0)), ([b"w2", b"w30"], np.array([2.0, 0.5])), ([b"none"], np.ones(1))]
    want = shard.top(queries, 5)
    assert [len(x) for x in want] == [5, 0, 5, 0]

    class Counted(dict):
        asked = 0

        def get(self, *args):
            Counted.asked += 1
            return super().get(*args)

    shard.number = Counted(shard.number)
    vocabulary = [b"w1", b"w2", b"none", b"w30"]
    here = shard.numbers(vocabulary)
    assert Counted.asked == len(vocabulary) and here[2] == -1
    found = shard.top_of(here[np.array([0, 1, 2, 1, 3, 2])], np.array([1.0, 2.0, 3.0, 2.0, 0.5, 1.0]), np.array([0, 3, 3, 5, 6]), 5, np.zeros(4))
    assert found == want and Counted.asked == len(vocabulary)
