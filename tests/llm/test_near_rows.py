"""Texts that meet at a shingle and cannot be alike give no rows; what Python workers remember ends with a task."""

import random

from matchloom.llm import bpe, nearcopies, substrings

from .test_nearcopies import brute, edited
from .test_operators import DOCS, prose


def test_pairs_of_a_frequent_shingle_are_told_apart_where_they_meet(spark):
    r = random.Random(8)
    line = prose(30, r)  # most of each text, so that its shingles are in the prefixes
    rows = [(k, f"{line} {prose(12, r)}", "en", "s", 1) for k in range(60)]
    rows += [(100 + k, edited(rows[k][1], r, 1), "en", "s", 1) for k in range(0, 60, 7)]
    docs = spark.createDataFrame(rows, DOCS)
    marked = nearcopies.marks(docs, "doc_id", "text", 5, 0.8).selectExpr("fp", "n", "0L h", "fp root", "true near", "false far")
    links = nearcopies.Links(docs, nearcopies.marks(docs, "doc_id", "text", 5, 0.8), "doc_id", "text", 5, 0.8)
    found = links.met(links.with_bits(marked))
    assert found.count() < len(rows) * (len(rows) - 1) / 2 / 10  # all meet at one shingle
    assert {(x.doc_id, x.text) for x in nearcopies.keep_one(docs).collect()} == brute(rows)


def test_workers_forget(spark):
    docs = spark.createDataFrame([(1, "some words are here", "en", "s", 1)], DOCS).repartition(1)

    def held(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [bpe.tokenizer.cache_info().currsize + len(substrings._hashes)]})

    bpe.encode(docs).collect()
    nearcopies.marks(docs, "doc_id", "text", 5, 0.8).collect()
    assert docs.select("doc_id").mapInArrow(held, "n long").first()[0] == 0
