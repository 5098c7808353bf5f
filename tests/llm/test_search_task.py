"""What a task finds in many shards is merged before it leaves the task."""

import random

from matchloom.llm import bm25


def test_shards_of_a_task_give_k_rows_a_query(spark):
    r = random.Random(4)
    rows = [(i, " ".join(r.choices([f"w{n}" for n in range(40)], k=12))) for i in range(120)] + [(None, "w1 w2 w3"), (500, "w1 w2 w3"), (501, "w1 w2 w3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    queries = docs.filter("doc_id % 50 = 0")
    whole = [tuple(x) for x in bm25.search(docs, queries, k=3).orderBy("query_id", "rank").collect()]
    found = bm25.search(docs, queries, k=3, shard_postings=60)
    assert [tuple(x) for x in found.orderBy("query_id", "rank").collect()] == whole
    index = bm25.build_shards(docs, 60, "doc_id", "text")
    assert index.count() > 10

    floors = bm25.np.array([1e9])
    shard = bm25.Shard(*index.first(), 12.0)
    terms = sorted(shard.number)[:5]
    assert shard.top([(terms, bm25.np.ones(5))], 3, floors) == [[]]
    assert len(shard.top([(terms, bm25.np.ones(5))], 3)[0]) == 3
