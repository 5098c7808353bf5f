"""Hotels verified among the listings around them, by those who pass, against scoring every listing."""

import random

from pyspark.sql import functions as F

from matchloom.functions import names as N
from matchloom.operators import resolution


def test_names_that_may_score(spark):
    r = random.Random(3)
    words = ["palm", "palms", "sea", "see", "酒店", "hotel", "hotels", "marina", "a", "palm palm", "ｅ́"]
    name = lambda: " ".join(r.choices(words, k=r.randint(0, 4)))
    pairs = spark.createDataFrame([(name(), name()) for _ in range(3000)], "a string, b string")
    for least in (60.0, 85.0, 90.0, 100.0):
        a, b = N.word_parts(F.col("a")), N.word_parts(F.col("b"))
        found = pairs.select(N.score("a", "b").alias("score"), N.strict_score("a", "b").alias("strict"), N.may_score(a, b, least).alias("x"), N.may_be_strict(a, b, F.lit(least)).alias("y")).collect()
        assert all(f.x or f.score < least for f in found) and all(f.y or f.strict < least for f in found)
        assert sum(not f.y for f in found) > 500 and (least < 85 or sum(not f.x for f in found) > 100)


def listed(spark, n, seed):
    r = random.Random(seed)
    words = ["Palm", "Palms", "Sea", "Hotel", "Marina", "Inn", "Royal (new)"]
    name = lambda: " ".join(r.choices(words, k=r.randint(1, 3)))
    spot = lambda: (25 + r.uniform(0, 0.008), 55 + r.uniform(0, 0.008))
    hotels = spark.createDataFrame([(h, name(), 1, "Dubai", *spot()) for h in range(n)] + [(900, "  ", 1, "Dubai", 25.0, 55.0), (901, "Palm", 1, "Dubai", None, 55.0)], "id long, name string, city_id long, city_name string, lat double, lon double")
    listings = spark.createDataFrame([(c, name(), 1, *spot()) for c in range(n * 3)] + [(9000, None, 1, 25.0, 55.0), (9001, "Palm", 1, None, None)], "cand_id long, cand_name string, cand_city long, cand_lat double, cand_lon double")
    return hotels, listings


def test_those_who_pass_decide_what_is_scored(spark):
    for seed in (1, 2, 3):
        hotels, listings = listed(spark, 60, seed)
        for most in (1.5, 0.4, 0.1):
            want = resolution.verified(hotels, resolution.nearby(hotels, listings, most)).collect()
            assert sorted(map(tuple, resolution.verified_near(hotels, listings, most).collect())) == sorted(map(tuple, want)) and len(want) > 3


def test_what_nobody_passes_at_is_not_scored(spark, monkeypatch):
    hotels = spark.createDataFrame([(1, "Palm", 1, "Dubai", 25.0, 55.0), (2, "Cliff", 1, "Dubai", 25.0, 55.0)], "id long, name string, city_id long, city_name string, lat double, lon double")
    listings = spark.createDataFrame([(c, "Palm" if c == 7 else f"Nothing {c}", 1, 25.0, 55.0) for c in range(300)], "cand_id long, cand_name string, cand_city long, cand_lat double, cand_lon double")
    named, seen = resolution._named, []
    monkeypatch.setattr(resolution, "_named", lambda met: seen.append(met.count()) or named(met))
    assert [tuple(r)[:2] for r in resolution.verified_near(hotels, listings).collect()] == [(1, 7)]
    assert sum(seen) == 2


def test_few_rows_with_many_pairs_are_dealt_over_all_tasks(spark):
    hotels, listings = listed(spark, 5, 1)
    met = resolution.within(hotels, listings, 1.5)
    assert met._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") == 2
