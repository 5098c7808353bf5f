"""Language decisions against fresh compressors, and where dictionaries come from."""

import random

import zstandard
from pyspark.sql import functions as F

from matchloom.llm import langid

from .test_operators import DOCS


def language(k, n, r):
    alphabet = "abcdefghijklmnopqrstuvwxyz"[k * 5 : k * 5 + 9]
    pool = random.Random(k)
    words = ["".join(pool.choice(alphabet) for _ in range(pool.randint(2, 8))) for _ in range(120)]
    return " ".join(r.choice(words) for _ in range(n))


def slow(dictionaries, text):
    """(language, margin) by compressing each block with a compressor made for it alone."""
    data = langid.letters(text)
    sizes = {}
    for lang, content in dictionaries.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=langid.PARAMETERS)
        sizes[lang] = sum(len(zstandard.ZstdCompressor(dict_data=d, compression_params=langid.PARAMETERS).compress(data[i : i + 8192])) for i in range(0, len(data), 8192))
    first, second = sorted((n, lang) for lang, n in sizes.items())[:2]
    return first[1], second[0] - first[0]


def test_decisions(spark):
    r = random.Random(6)
    names = ["aa", "bb", "cc"]
    rows = [(i, language(i % 3, r.randint(3, 400), r), names[i % 3], "s", 1) for i in range(240)] + [(900, language(0, 9000, r), "aa", "s", 1), (901, "12 34", None, "s", 1), (902, None, "aa", "s", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    model = langid.learn_dictionaries(docs)
    got = {x.doc_id: x for x in langid.identify(docs, model).collect()}
    for i, text, *_ in rows[:241]:
        lang, margin = slow(model, text)
        assert (got[i].lang_pred, got[i].margin_bytes, got[i].rejected) == (lang, margin, margin < langid.MIN_MARGIN)
    held = [x for x in rows[:240] if got[x[0]].lang_pred == x[2]]
    assert len(held) > 230 and got[901].lang_pred == got[902].lang_pred == "und"
    kept = {x.doc_id for x in langid.keep_identified(docs, model).collect()}
    assert kept == {i for i, x in got.items() if not x.rejected}


def test_slices_come_from_anywhere(spark):
    """Texts that begin alike give dictionaries of what follows too."""
    r = random.Random(2)
    rows = [(i, "same beginning " * 40 + language(1, 300, r), "bb", "s", 1) for i in range(60)]
    (content,) = langid.learn_dictionaries(spark.createDataFrame(rows, DOCS)).values()
    assert content.count(b"beginning") * 14 < 0.6 * len(content)
    assert langid.learn_dictionaries(spark.createDataFrame(rows, DOCS).filter(F.lit(False))) == {}


def test_the_margin_is_chosen_without_held_out_rows(spark):
    r = random.Random(9)
    rows = [(i, language(i % 2, r.randint(2, 60), r), ["aa", "bb"][i % 2], "s", 1) for i in range(160)]
    docs = spark.createDataFrame(rows, DOCS)
    told = sorted(map(tuple, langid.margins_by_fold(docs, 3).collect()))
    learnable = docs.filter(langid.may_learn("doc_id"))
    assert sum(right + wrong for _, right, wrong in told) == learnable.count() < 160
    # labels of held-out rows do not matter
    other = docs.withColumn("lang", F.when(langid.may_learn("doc_id"), F.col("lang")).otherwise("bb"))
    assert sorted(map(tuple, langid.margins_by_fold(other, 3).collect())) == told
    assert langid.narrowest_margin([(0, 1, 5), (1, 2, 3), (2, 9, 1), (3, 0, 9)]) == 2
    assert langid.narrowest_margin([]) == 0 and langid.narrowest_margin([(m, 0, 1) for m in range(20)]) == 8
