"""Name functions against published values and worked examples."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import names as N
from matchloom.functions import vocabulary as V
from matchloom.session import cut


def one(spark, rows, *columns, schema="a string, b string"):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(300):
        a, b = ("".join(r.choice("abcd ") for _ in range(r.randint(0, 70))) for _ in "ab")
        assert N.common_subsequence(a, b) == lcs(a, b)


@pytest.mark.parametrize(
    "a, b, strict, loose",
    [
        ("frank porter rimal 3", "frank porter rimal 1", 95.0, 95.0),
        ("frank porter goldcrest views", "frank porter goldcrest views 2", 96.6, 100.0),
        ("frank porter fairmont residences", "frank porter fairmont residence south", 92.8, 92.8),
        ("swissotel al murooj", "roda al murooj", 66.7, 78.3),
        ("t r i p l e", "s u p e r i o r", 69.2, 77.8),
        ("downtown hotel", "millennium plaza downtown hotel dubai", 54.9, 100.0),
        ("prestige twin room with city view", "elite twin room with city view", 88.9, 88.9),
    ],
)
def test_published_scores(a, b, strict, loose):
    assert round(N.sort_ratio(a, b), 1) == strict and round(N.set_ratio(a, b), 1) == loose


def test_fold():
    assert N.fold("Habitaci&#xf3;n  Supérieure & Spa") == "habitacion superieure and spa"
    assert N.fold("T R I P L E room") == "triple room" and N.fold("Room A") == "room a"
    assert N.fold("部屋 101") == "部屋 101" and N.fold(None) == ""


def test_norm_room(spark):
    cases = {
        "Executive Suite [Executive Suite Executive Suite Nrhb]": "executive suite",
        "De Luxe Twin Room RO": "deluxe twin room",
        "Dlx Dbl Room (Non Refundable)": "deluxe double room",
        "Twin Room- 50% off on Water Park (Valid Until August 2026)": "twin room",
        "Offer Room": "room",
        "King Room 41sm 2025": "king room",
        "Club Room with Lounge Access": "club room with",
        "Room - Disability Access": "room disability accessible",
        "Mobility Accessible King": "mobility accessible king",
        "Lounge Accessible": "",
        "": "",
        None: "",
    }
    got = one(spark, [(k, None) for k in cases], "a", N.norm_room(F.col("a")))
    assert dict(got) == cases


def test_features(spark):
    rows = [("presidential suite 2 king beds", None), ("premium twin room city view", None), ("studio", None), ("two bedroom apartment classic", None), ("accessible room", None), ("seaview room", None), ("0 bedroom flat", None)]
    f = N.features(F.col("a"))
    got = {r[0]: r[1] for r in one(spark, rows, "a", f)}
    x = got["presidential suite 2 king beds"]
    assert x["classes"] == ["presidential suite", "suite"] and x["beds"] == ["king"] and x["tiers"] == ["presidential"]
    x = got["premium twin room city view"]
    assert (x["view"], x["tiers"], x["beds"], x["bedrooms"]) == ("city", ["premier"], ["twin"], None)
    assert got["studio"]["bedrooms"] == 0 and got["two bedroom apartment classic"]["bedrooms"] == 2
    assert got["accessible room"]["accessible"] and got["seaview room"]["view"] is None  # joined before views are read
    assert got["0 bedroom flat"]["bedrooms"] == 0


def test_vetoes_and_scores(spark):
    pairs = [
        ("Premier Room 2 Twin Beds", "Premier Double or Twin Room", None),
        ("Family Suite", "Family Room", "class suite vs room disjoint"),
        ("Deluxe Room", "Superior Room", "tiers deluxe vs superior disjoint"),
        ("1 Bedroom Apartment", "2 Bedroom Apartment", "bedrooms 1 != 2"),
        ("King Room City View", "King Room Garden View", "view 'city' vs 'garden' disjoint"),
        ("King Room", "Twin Room", "beds king vs twin disjoint"),
        ("King Room Sea View", "King Room City View", None),  # known: "sea view" is one word by then
    ]
    df = spark.createDataFrame([p[:2] for p in pairs], "a string, b string").select("a", "b", N.norm_room(F.col("a")).alias("na"), N.norm_room(F.col("b")).alias("nb"))
    df = cut(cut(df, "names").withColumn("raw", N.room_score("na", "nb")), "scores")
    df = cut(df.withColumn("fa", N.features(F.col("na"))).withColumn("fb", N.features(F.col("nb"))), "features")
    fa, fb = F.col("fa"), F.col("fb")
    got = df.select("a", "b", N.veto(fa, fb).alias("veto"), N.adjusted(F.col("raw"), fa, fb).alias("s"), N.corroborations(fa, fb, F.col("na"), F.col("nb")).alias("cor")).collect()
    by = {(r.a, r.b): r for r in got}
    for a, b, veto in pairs:
        assert by[a, b].veto == veto, (a, b, by[a, b].veto)
    assert by[pairs[0][:2]].cor[:2] == ["tier", "beds"]
    assert by["Family Suite", "Family Room"].cor == ["word:family"]


def test_prestige_pair(spark):
    a, b = "prestige twin room with city view", "elite twin room with city view"
    df = spark.createDataFrame([(a, b)], "a string, b string").withColumn("fa", N.features(F.col("a"))).withColumn("fb", N.features(F.col("b")))
    assert df.select(N.adjusted(N.strict_score("a", "b"), F.col("fa"), F.col("fb"))).first()[0] == 92.9


def test_accessibility_cap(spark):
    df = spark.createDataFrame([("king room", "accessible king room")], "a string, b string").withColumn("fa", N.features(F.col("a"))).withColumn("fb", N.features(F.col("b")))
    s = df.select(N.adjusted(N.room_score("a", "b"), F.col("fa"), F.col("fb")), F.size(N.corroborations(F.col("fa"), F.col("fb"), F.col("a"), F.col("b")))).first()
    assert s[0] == V.ACCESS_CAP and s[1] == 0


def test_categories(spark):
    cases = {"1 bedroom family suite": "Suite", "royal suite": "Presidential Suite", "junior suite": "Junior Suite", "two bedroom apartment": "Two Bedroom Apartment", "5 bedroom flat": "Multi Bedroom Apartment", "residence": "Apartment", "premier king": "Premium Room", "family room": "Family Room", "captains room": "General", "": "General", "studio two bedrooms": "Studio", "economy double": "Standard Room", "overwater villa": "Overwater Villa"}
    assert dict(one(spark, [(k, None) for k in cases], "a", N.category(F.col("a")))) == cases
    assert len(N.all_categories()) == len(set(N.all_categories())) == 25


def test_listings(spark):
    rows = [("kennedy towers x dubai", "kennedy towers x"), ("frank porter rimal 3", "frank porter rimal 1"), ("luxury burj view 2br in central avenue", "central avenue")]
    got = [r[0] for r in one(spark, rows, N.same_listing(F.col("a"), F.col("b"), drop=F.lit("dubai")))]
    assert got == [True, False, False]


def test_soft(spark):
    got = [r[0] for r in one(spark, [("tiers a vs b", None), ("view x", None), ("beds k vs q", None), (None, None)], N.is_soft(F.col("a")))]
    assert got == [True, True, False, False]


def test_no_duplicate_words():
    for words in (V.TIERS, V.BEDS, V.CLASSES, V.BOARD_CODES):
        assert not [a for a, b in itertools.combinations(words, 2) if a == b]
