"""Payloads whose form drifts, and objects named by their content."""

import glob
import json
import os

import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from matchloom.sources import extract, objects


def test_string_values(spark):
    deep = "x"
    for k in range(20):
        deep = [k, {"m": deep}] if k % 2 else {"n": [deep]}
    bodies = [{"b": ["p", 1, None, True, {"q": "r"}], "a": "s", "/k/hotel/x.html": {}}, "top", deep, [], {}]
    rows = [(i, json.dumps(b)) for i, b in enumerate(bodies)] + [(9, None), (10, "{broken"), (11, "")]
    got = extract.string_values(spark.createDataFrame(rows, "id long, body string"), "id", "body").collect()
    assert sorted((r["id"], r["text"]) for r in got) == [(0, "p"), (0, "r"), (0, "s"), (1, "top"), (2, "x")]
    assert len(next(r["path"] for r in got if r["id"] == 2)) == 40


def test_own_slugs(spark):
    rows = [
        (1, '{"/key/hotel/a.html": 1}'),
        (2, r'{"u": "\/in\/hotel\/a.html"}'),
        (3, '{"u": "see /in/hotel/a.html"}'),
        (4, '["/one/hotel/a.html", ["/two/hotel/a.html", 5], "three"]'),
        (5, None),
    ]
    got = extract.own_slugs(spark.createDataFrame(rows, "id long, body string"), "id", "body")
    assert sorted(map(tuple, got.collect())) == [(1, None), (2, "in"), (3, None), (4, "two"), (5, None)]


def test_suggestions(spark):
    body = {
        "ViewModelList": [{"ObjectId": 1, "CityId": 5, "CountryISO": "AE"}, {"ObjectId": 2, "CityId": 6}, {"ObjectId": "1", "CityId": "7", "CityName": "Dubai", "CountryISO": ""}, {"ObjectId": 0, "CityId": 8}, {}, None, 5],
        "SuggestionList": [{"ObjectTypeID": 1, "ObjectID": 1, "Name": "A"}, {"ObjectTypeID": 9, "ObjectID": 2, "Name": "B"}, {"ObjectTypeID": "1", "ObjectID": 3, "Name": "C"}, {"Name": "D"}, {"ObjectTypeID": 1, "ObjectID": 0, "Name": "E"}],
    }
    rows = [("q", json.dumps(body)), ("none", "{}"), ("odd", '{"SuggestionList": {"ObjectTypeID": 1}}'), ("bad", "<html>"), ("null", None)]
    got = extract.suggestions(spark.createDataFrame(rows, "query string, body string"))
    assert sorted(map(tuple, got.collect())) == [("q", 0, 1, "A", 7, None, "Dubai", None), ("q", 2, 3, "C", None, None, None, None), ("q", 4, 0, "E", None, None, None, None)]


def test_objects(spark, tmp_path):
    rows = [(1, "aa.png", b"x" * 9), (2, "bb.png", b"y"), (3, "aa.png", b"x" * 9), (4, None, b"z"), (5, "cc.png", b"")]
    df = spark.createDataFrame(rows, "id long, key string, content binary").repartition(4)
    got = sorted(map(tuple, objects.store(df, f"file://{tmp_path}").collect()))
    assert got == [(1, "aa.png", 9, False), (2, "bb.png", 1, False), (3, "aa.png", 9, True)]
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/*/*")}
    assert all(r[3] for r in objects.store(df, f"file://{tmp_path}").collect())
    assert {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/*/*")} == before and len(before) == 2
    assert {r["key"]: bytes(r["content"]) for r in objects.stored(spark, f"file://{tmp_path}").collect()} == {"aa.png": b"x" * 9, "bb.png": b"y"}
    assert objects.store(df.limit(0), f"file://{tmp_path}").count() == 0


class Failing:
    """A store that fails some times before it works."""

    def __init__(self, times):
        self.fs, self.left = pyarrow.fs.LocalFileSystem(), times

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def move(self, a, b):
        if self.left:
            self.left -= 1
            raise OSError("busy")
        self.fs.move(a, b)


def test_a_store_that_fails(tmp_path):
    waits = []
    assert objects.put(Failing(3), f"{tmp_path}/a/one", b"1", wait=waits.append) and waits == [0.2, 0.4, 0.8]
    assert not objects.put(Failing(0), f"{tmp_path}/a/one", b"1")
    assert objects.put(Failing(0), f"{tmp_path}/a/one", b"22")  # a file that a run left half is written again
    with pytest.raises(OSError):
        objects.put(Failing(9), f"{tmp_path}/a/two", b"1", wait=waits.append)


def test_mirrored_in_order(spark, tmp_path):
    image = lambda c: b"\xff\xd8" + c * 5000
    fetched = spark.createDataFrame([("u1", "image/png", image(b"1")), ("u2", None, b"<html>"), ("u3.gif", None, image(b"3")), ("u4", "image/jpeg", image(b"1"))], "url string, content_type string, content binary")
    rooms = spark.createDataFrame([(1, "a", ["u3.gif", "u2", "u1"]), (1, "b", ["u2", "lost"]), (2, "c", ["u4", "u1"]), (2, "d", [])], "hotel_id long, room_key string, images array<string>")
    got = {r["room_key"]: (r["thumbnail"], r["images"]) for r in objects.mirror(rooms, fetched, f"file://{tmp_path}", "s/").collect()}
    assert got["a"][0].endswith(".gif") and len(got["a"][1]) == 1 and got["a"][1][0].endswith(".png")
    assert got["b"] == (None, []) and got["d"] == (None, [])
    assert got["c"][0].endswith(".jpg") and got["c"][0][:-4] == got["c"][1][0][:-4] == got["a"][1][0][:-4]
    assert spark.createDataFrame([(1,)], "x int").select(F.lit(len(glob.glob(f"{tmp_path}/*/*")))).first()[0] == 3
