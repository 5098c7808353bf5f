"""Each stage of the pipeline on its own input, and the pipeline as a whole, against plain Python."""

import random

import pytest

import corpus_pipeline
from matchloom.llm import bpe, langid, secrets

from .test_nearcopies import brute, edited
from .test_operators import DOCS, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    where = tmp_path_factory.mktemp("data")
    r = random.Random(12)
    items = [(i, prose(25, r)) for i in range(8)]
    rows = [(i, prose(r.randint(10, 90), r), "en" if i % 3 else "xx", "s", 1) for i in range(80)]
    rows += [(100 + k, rows[k][1], "en", "s", 1) for k in (2, 2, 5)]
    rows += [(110 + k, edited(rows[k][1], r, 1), "en", "s", 1) for k in range(20, 26)]  # near copies
    rows += [(200 + k, f"{prose(5, r)} {items[k][1]} {prose(7, r)}", "en", "s", 1) for k in range(4)]
    rows += [(300, f"key password=abcdefgh12 {prose(20, r)}", "en", "s", 1), (301, None, "en", "s", 0), (302, "12 34 !!", "en", "s", 1), (303, "", None, None, None), (None, prose(30, r), None, None, None)]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{where}/benchmark.parquet")
    return str(where), rows, items


def test_stages_and_run(spark, folder):
    where, rows, items = folder
    docs = spark.read.parquet(f"{where}/documents.parquet")
    model = langid.Identifier(langid.learn_dictionaries(docs))
    kept = []
    for row in rows:
        lang, _, margin, _ = model.predict(row[1])
        if lang != "und" and margin >= langid.MIN_MARGIN:
            kept.append(row)
    stays = brute(kept)
    kept = [row for row in kept if (row[0], row[1]) in stays]
    kept = [row for row in kept if not any(text in (row[1] or "") for _, text in items)]
    want = {row[0]: bpe.tokenizer(*bpe.default_vocabulary()).encode(secrets.redact(row[1])) for row in kept}
    got = {x.doc_id: list(x.token_ids) for x in corpus_pipeline.run(spark, where).collect()}
    assert got == want
    assert 300 in got and not {301, 302, 303, 102, 105, 200, 201, 202, 203} & set(got)


def test_columns(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder[0]).columns == docs.columns
