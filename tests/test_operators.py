"""Composite operators: mapping, resolution, ladders, ledgers, publishing, extraction, streaming."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from matchloom.functions import names as N
from matchloom.functions import vocabulary as V
from matchloom.operators import harvest, ledger, mapping, probing, publishing, reports, resolution, rooms, scans, unions
from matchloom.operators.numbering import numbered
from matchloom.operators.store import Store
from matchloom.options import Options
from matchloom.sources import extract, readers
from matchloom.streaming.ledger import outcome_windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


A, B = "hotel_id long, a_id long, room_name string", "hotel_id long, b_id long, room_name string"


def test_mapping_contention_and_order(spark):
    a = [(1, 1, "Deluxe King Room"), (1, 2, "Deluxe King Room City View"), (1, 3, "Captains Room"), (1, 4, "Standard Twin Room"), (2, 5, "Family Suite")]
    b = [(1, 10, "Deluxe King Room"), (1, 11, "Deluxe King City View"), (1, 12, "Royal Penthouse"), (2, 13, "Superior Family Suite"), (2, 14, " ")]
    base = None
    r = random.Random(1)
    for _ in range(4):
        r.shuffle(a)
        r.shuffle(b)
        got = rows(mapping.map_rooms(spark.createDataFrame(a, A).repartition(r.randint(1, 3)), spark.createDataFrame(b, B)))
        assert base is None or got == base
        base = got
    by = {(x[1], x[4]): x for x in base}
    assert by[1, 10][3] == "publish" and by[2, 11][3] == "publish" and (None, 12) in by and (None, 14) not in by
    assert [x[3] for x in base if x[1] == 3] == ["unmatched"]


def test_many_names_share_one_room(spark):
    a = [(1, i, f"Deluxe King Room{s}") for i, s in enumerate(["", " RO", " BB", " (Non Refundable)", " HB"])]
    got = mapping.map_rooms(spark.createDataFrame(a, A), spark.createDataFrame([(1, 10, "Deluxe King Room")], B)).collect()
    assert [(x.status, x.b_id) for x in got] == [("publish", 10)] * 5


def test_assignment_is_greedy(spark):
    from itertools import product

    r = random.Random(5)
    data = [(1, x, y, f"n{x}", f"m{y}", f"n{x}", f"m{y}", float(r.randint(60, 100))) for x, y in product(range(6), range(6))]
    df = spark.createDataFrame(data, "hotel_id long, a_id long, b_id long, a_name string, b_name string, na string, nb string, score double")
    ta, tb, want = set(), set(), []
    for d in sorted(data, key=lambda d: (-d[7], d[5] != d[6], abs(len(d[5]) - len(d[6])), d[3], d[1], d[4], d[2])):
        if d[7] >= V.REVIEW and d[1] not in ta and d[2] not in tb:
            ta.add(d[1])
            tb.add(d[2])
            want.append((1, d[1], d[2]))
    assert rows(mapping.assign(df)) == sorted(want, key=repr)
    assert rows(mapping.assign(df, most=5)) == sorted(want, key=repr)


def test_fixed_window(spark):
    h = spark.createDataFrame([(i,) for i in range(10)], "id long")
    for skip in ([], [0], [0, 1, 2, 3], [9]):
        got = rows(scans.window_minus_skip(h, spark.createDataFrame([(s,) for s in skip], "id long"), 4))
        assert got == [(i,) for i in range(4) if i not in skip]


def test_key_list(spark):
    lines = spark.createDataFrame([(0, "b, a # note"), (1, ""), (2, "# only"), (3, "a\tc")], "pos int, line string")
    assert [r.slug for r in scans.key_list(lines).collect()] == ["b", "a", "c"]


def test_empty_text_is_filled(spark):
    stored = spark.createDataFrame([(1, 1, "King", "", None, None), (2, 1, "Twin", "u", 5, 7)], "id long, hotel_id long, name string, thumbnail string, size_sqft int, category_id long")
    new = spark.createDataFrame([(1, 1, " KING ", "new", 9, 3, ["new", "x"]), (1, 2, "twin", "other", 8, 8, ["o"]), (1, 3, "Suite", "s", None, 1, ["s", "t"]), (1, 4, "suite", "z", 1, 1, [])], "hotel_id long, seq long, room_name string, thumbnail string, size_sqft int, category_id long, images array<string>")
    acted = publishing.actions(new, stored)
    assert {(r.seq, r.action) for r in acted.collect()} == {(1, "fill"), (2, "skip_existing"), (3, "insert"), (4, "skip_duplicate")}
    assert rows(publishing.filled(acted).select("room_key", "thumbnail", "size_sqft", "category_id")) == [("king", "new", 9, 3), ("suite", "s", None, 1), ("twin", "u", 5, 7)]
    assert rows(publishing.gallery(acted)) == [(1, "king", 1, "x"), (1, "suite", 1, "t")]
    again = publishing.filled(acted).select(F.monotonically_increasing_id().alias("id"), "hotel_id", F.col("room_key").alias("name"), "thumbnail", "size_sqft", "category_id")
    twice = publishing.actions(new.filter("seq <> 4"), again)
    assert {r.action for r in twice.collect()} == {"skip_existing"}


def test_ledger(spark):
    lines = [(0, "1,a,x"), (1, "9"), (2, "zz,1,1"), (3, "5,1,b,y"), (4, "6,1,c"), (5, "")]
    got = ledger.read_log(spark.createDataFrame(lines, "seq long, line string"), ["row_id", "hotel_id", "slug", "reason"])
    assert rows(got.select("hotel_id", "row_id", "slug", "reason")) == [(1, "5", "b", "y"), (6, None, "1", "c")]
    log = spark.createDataFrame([(1, "open", 1), (1, "resolved", 2), (2, "open", 3)], "hotel_id long, reason string, row_id long")
    assert rows(ledger.unresolved_ids(log)) == [(2,)]
    grown = ledger.append_rows(log, spark.createDataFrame([(2, "r" * 400)], "hotel_id long, reason string"), ["hotel_id"])
    last = ledger.latest(grown).filter("hotel_id = 2").first()
    assert last.row_id == 4 and len(last.reason) == V.REASON_LENGTH
    assert rows(ledger.unresolved_ids(log.limit(0))) == []


def test_union_shuffle(spark):
    data = [(k % 3, k, k % 2, ["i%d" % (k % 4), "j"]) for k in range(30)]
    results = set()
    for seed in range(3):
        df = spark.createDataFrame(random.Random(seed).sample(data, len(data)), "key int, seq int, rich int, images array<string>").withColumn("name", F.concat(F.lit("n"), F.col("seq").cast("string")))
        results.add(str((rows(unions.first_wins(df, ["key"], ["seq"], ["name"])), rows(unions.richest_wins(df, ["key"], "rich", ["seq"], ["name"])), rows(unions.merge_images(df, ["key"], "seq", "images", "name")))))
    assert len(results) == 1
    assert "['i0', 'j', 'i3', 'i2', 'i1']" in results.pop()


def test_ladders(spark):
    day = spark.createDataFrame([(datetime.date(2024, 6, 8),), (datetime.date(2024, 6, 9),)], "day date")
    assert [r[0] for r in day.select(probing.weekend_checkin(F.col("day"), F.lit(0))).collect()] == [datetime.date(2024, 6, 15)] * 2
    assert day.select(probing.weekend_checkin(F.col("day"), F.lit(2))).first()[0] == datetime.date(2024, 6, 29)
    assert probing.probe_shapes(spark).count() == 12 and probing.probe_shapes(spark, V.WIDER_LADDER).count() == 16
    assert probing.stays(probing.probe_shapes(spark), day).count() == 24
    g = spark.createDataFrame([(1, s, x, 3) for s, x in enumerate([1, 0, 0, 5])] + [(2, s, x, 3) for s, x in enumerate([1, 2, 9])], "hotel_id int, shape int, gained long, n_gaps int")
    assert rows(probing.plateau_stop(g).select("hotel_id", "shape")) == [(1, 0), (1, 1), (1, 2), (2, 0), (2, 1)]


def test_breaker(spark):
    a = spark.createDataFrame([(1, i, i > 1) for i in range(11)] + [(2, i, i % 2 == 0) for i in range(9)], "hotel_id int, n int, failed boolean")
    got = {r.hotel_id: r for r in probing.failure_streaks(a, "hotel_id", ["n"], "failed").collect()}
    assert (got[1].trailing, got[1].degraded, got[1].rotations) == (9, True, 3) and not got[2].degraded


def test_addresses(spark):
    cases = [
        ("vardanants 15/4, 0010, armenia, yerevan", "Armenia", "Yerevan", "vardanants 15 4 yerevan"),
        ("Calle 50, Panama City, Panama", "Panama", "Panama City", "Calle 50 Panama City"),
        ("Panama City, Panama", "Panama", "Panama City", "Panama City"),
        ("1 Marina Road, Singapore 018956", "Singapore", "Singapore", "1 Marina Road Singapore"),
        ("Sheikh Zayed Rd, Dubai, U.A.E.", "United Arab Emirates", "Dubai", "Sheikh Zayed Rd Dubai"),
        ("Sheikh Zayed Rd, UAE, Dubai", "United Arab Emirates", "Dubai", "Sheikh Zayed Rd Dubai"),
        ("10 Rue de Rivoli, France, Paris, FRANCE", "France", None, "10 Rue de Rivoli France Paris"),
        ("x 1", "A", "B", None),
        (None, None, None, None),
        ("Plain Street 12", None, None, "Plain Street 12"),
        ("word " * 40, None, "Y", ("word " * 40).strip()[:80]),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a string, c string, t string, want string")
    for r in df.withColumn("got", resolution.address_query(F.col("a"), F.col("c"), F.col("t"))).collect():
        assert r.got == r.want, r


def test_extraction(spark):
    page = """x {"b_name": "Suite {1}", "k": {"z": "}"}, "b_id": 7} {"b_id": 8, "b_name": "King"} {"b_name": "broken", "b_id": }
    allRoomPhotos: [{id: 1, large_url: 'http://p/1', associated_rooms: ['7','9']}, {id: 2, large_url: 'http://p/]2', associated_rooms: ['7']}]"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id int, html string")
    assert rows(extract.markup_rooms(df)) == [(1, "7", "Suite {1}", ["http://p/1", "http://p/]2"]), (1, "8", "King", [])]
    body = '{"masterRooms": [{"id": 3, "name": " King ", "images": ["//a/b", "http://c"], "features": [{"title": "View"}, {"title": "Room size: 100 m²/1,076.4 ft²"}], "rooms": ["x"]}]}'
    got = extract.property_rooms(spark.createDataFrame([(1, body), (2, "junk")], "hotel_id int, body string")).collect()
    assert len(got) == 1 and got[0].room_name == "King" and got[0].images == ["https://a/b", "http://c"] and got[0].size_sqft == 1076
    r = spark.createDataFrame([("6-7",), ("4",), ("x",), ("7-6",)], "r string").select(extract.parse_range(F.col("r")).alias("p")).collect()
    assert [tuple(x.p) if x.p else None for x in r] == [(2, 5), (4, 0), None, None]


HOTEL = "id long, name string, city_id long, city_name string, lat double, lon double"
CANDIDATE = "hotel_id long, cand_id long, cand_name string, cand_city long, cand_lat double, cand_lon double, is_private boolean, variant int"


def test_resolution_reasons(spark):
    h = spark.createDataFrame([(1, "Grand Palm Hotel", 1, "Dubai", 25.0, 55.0), (2, "Lost Inn", 1, None, 25.0, 55.0), (3, "Nobody", 1, None, None, None), (4, "Royal Plaza", 1, None, 25.0, 55.0), (5, "Blue Bay Inn", 1, None, 25.0, 55.0)], HOTEL)
    c = spark.createDataFrame([
        (1, 10, "Grand Palm Hotel", 1, 25.001, 55.0, False, 0), (1, 11, "Grand Palm Hotel Dubai", 1, 25.0, 55.0, True, 0), (1, 12, "Grand Palm", 2, 25.0005, 55.0, True, 1),
        (2, 13, "Other", 1, 25.0, 55.0, False, 0), (4, 14, "Royal Plaza", 2, 30.0, 55.0, False, 0), (4, 15, "Royal Plaza Suites Tower 9", 2, 25.0, 55.0, True, 0), (5, 16, "Blue Bay Inn Unit 7", 1, 25.0, 55.0, True, 0),
    ], CANDIDATE)
    got = {r.hotel_id: r for r in resolution.match_hotels(h, c).collect()}
    assert (got[1].cand_id, got[1].confidence) == (11, "high")  # a private listing that is the hotel but for the city's name
    assert got[2].reason == "no candidate above name threshold" and got[3].reason == "no suggestion"
    assert got[4].reason.startswith("rejected Royal Plaza name=100% strict=100% dist=5") and got[4].reason.endswith("km same_city=false")
    assert got[5].reason == "rejected Blue Bay Inn Unit 7: private listing"


def test_two_word_city_and_parentheses(spark):
    h = spark.createDataFrame([(1, "Palm Residence (formerly Old Palm)", 1, "Abu Dhabi", 25.0, 55.0), (2, "Sea Inn", None, None, 25.0, 55.0)], HOTEL)
    c = spark.createDataFrame([(1, 10, "Palm Residence Abu Dhabi", 1, 25.0, 55.0, True, 0), (2, 11, "Sea Inn Lodge", None, 26.5, 55.0, False, 0), (2, 12, "Sea Inn", 5, 25.0, 55.0, False, 1)], CANDIDATE)
    got = {r.hotel_id: r for r in resolution.match_hotels(h, c).collect()}
    assert got[1].cand_id == 10
    # without a city on either side the two are not in one city, and a strong name ends the search
    assert got[2].cand_id is None and "same_city=false" in got[2].reason and "Sea Inn Lodge" in got[2].reason


def test_floors_are_not_rounded(spark):
    s = spark.createDataFrame([(71.96, 0.1), (72.0, 0.1), (89.96, 1.0), (90.0, 1.0)], "s double, d double")
    got = [r[0] for r in s.select(resolution.confidence(F.col("s"), F.lit(0.0), F.col("d"), F.lit(False))).collect()]
    assert got == [None, "high", None, "medium"]
    long_a, long_b = "abcdefghijklmnopqrstuvwxy" * 2, "abcdefghijklmnopqrstuvwxy" * 2
    assert resolution.scored(spark.createDataFrame([(1, long_a, 1, None, 0.0, 0.0)], HOTEL), spark.createDataFrame([(1, 1, long_b[:-11] + "zzzzzzzzzzz", 1, 0.0, 0.0, False, 0)], CANDIDATE)).first().score == 78.0


def test_three_best_before_the_floor(spark):
    h = spark.createDataFrame([(1, "Alpha Beach Resort", 1, None, 25.0, 55.0), (2, " ", 1, None, 25.0, 55.0), (3, "Alpha", 1, None, None, 55.0)], HOTEL)
    near = [(1, 20, "Resort Alpha Beach", 1, 25.01, 55.0, False, 0), (1, 21, "Alpha Beach Resorts", 1, 25.02, 55.0, False, 0), (1, 22, "Alpha Beach Resort", 1, 25.03, 55.0, False, 0), (1, 23, "Alpha Beach Resort and Spa and More Rooms", 1, 25.0, 55.0, False, 0)]
    assert resolution.verified(h, spark.createDataFrame(near + [(2, 1, "x", 1, 25.0, 55.0, False, 0), (3, 2, "Alpha", 1, 25.0, 55.0, False, 0)], CANDIDATE)).count() == 0  # the fourth would pass both gates
    assert rows(resolution.verified(h, spark.createDataFrame(near[1:], CANDIDATE)).select("hotel_id", "cand_id")) == [(1, 23)]


def test_unbalanced_page_is_quick():
    import time

    page = "{" * 40 + "it's <p class=\"x\">" * 1000 + '{"b_id": 1, "b_name": "A"}' + ' lorem "ipsum dolor' * 200_000 + "".join(f'{{"b_id": {i}, "q": {{"r": "}}"}}, "b_name": "N"}}' for i in range(2, 18))
    began = time.time()
    assert set(extract._named_rooms(page)) == {str(i) for i in range(1, 18)}
    assert time.time() - began < 5


def test_numbering(spark, monkeypatch):
    df = spark.range(1000).withColumn("k", F.col("id") % 7).repartition(5)
    got = numbered(df, [F.desc("k"), F.asc("id")], "n").collect()
    assert [r.id for r in sorted(got, key=lambda r: r.n)] == sorted(range(1000), key=lambda i: (-(i % 7), i))
    assert sorted(r.n for r in got) == list(range(1, 1001)) and numbered(df.limit(0), [F.asc("id")], "n").count() == 0


def test_store_survives_a_run_that_dies(spark, tmp_path):
    path = str(tmp_path / "store")
    new = spark.createDataFrame([(1, 1, "King", "t", 9, 3, ["t", "g"]), (1, 2, "Twin", None, None, 1, [])], "hotel_id long, seq long, room_name string, thumbnail string, size_sqft int, category_id long, images array<string>")
    assert rooms.stored(spark, path).count() == 0
    first = rooms.publish(new, path).first()
    assert (first["insert"], first["fill"]) == (2, 0)
    Store(spark, path).prepare(new.withColumn("room_name", F.lit("Never")))  # a run that died
    assert rows(rooms.stored(spark, path).select("name", "thumbnail")) == [("King", "t"), ("Twin", None)]
    again = rooms.publish(new.withColumn("thumbnail", F.lit("u")).withColumn("size_sqft", F.lit(5)), path).first()
    assert (again["fill"], again["skip_existing"]) == (1, 1)
    assert rows(rooms.stored(spark, path).select("id", "name", "thumbnail", "size_sqft")) == [(1, "King", "t", 9), (2, "Twin", "u", 5)]
    assert rows(rooms.stored(spark, path, "gallery")) == [(1, "king", 1, "g")]
    assert rooms.publish(new, path).first()["skip_existing"] == 2


def test_checkpoints(spark, tmp_path):
    path, schema = str(tmp_path / "ck"), "hotel_id long, tag string"
    assert harvest.load_checkpoint(spark, path, "a", schema).count() == 0
    harvest.save_checkpoint(spark.createDataFrame([(1, "x")], schema), path, "a")
    harvest.save_checkpoint(spark.createDataFrame([(2, "y")], schema), path, "b")
    harvest.save_checkpoint(spark.createDataFrame([(3, "z")], schema), path, "a")
    assert rows(harvest.load_checkpoint(spark, path, "a", schema)) == [(3, "z")]
    assert harvest.load_checkpoint(spark, path, "a", "other string").count() == 0
    harvest.sweep_scope(spark, path, "a")
    assert harvest.load_checkpoint(spark, path, "a", schema).count() == 0 and harvest.load_checkpoint(spark, path, "b", schema).count() == 1


def test_filling_from_a_third_source(spark):
    gaps = spark.createDataFrame([(1, 1, "Deluxe King Room"), (1, 2, "Captains Cabin"), (2, 3, "Suite"), (3, 4, "Twin Room"), (4, 5, "Family Room")], "hotel_id long, a_id long, room_name string")
    offers = [(1, s, 10 + s, n, ["p"]) for s, n in enumerate(["Deluxe King Room", "Family Suite", "Penthouse"])] + [(1, 3, 11, "Family Suite", ["q"]), (1, 4, 12, "Penthouse", []), (1, 5, 19, "Captains Cabin", ["z"]), (2, 0, 20, "Suite", []), (3, 0, 30, "Presidential Villa", ["v"]), (4, 0, 40, "Family Room", ["f"])]
    o = spark.createDataFrame(offers, "hotel_id long, shape int, b_id long, room_name string, images array<string>")
    verified = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3"), (5, "h5")], "hotel_id long, slug string")
    hotels = spark.createDataFrame([(i,) for i in range(1, 6)], "hotel_id long")
    assert rows(harvest.shapes_needed(gaps.filter("hotel_id = 1"), o, 2)) == [(1, s) for s in range(5)]  # two shapes without a new room end it
    filled, notes = harvest.fill_gaps(gaps, verified, o, hotels, 2)
    assert rows(filled.filter("filled").select("a_id", "images")) == [(1, ["p"])]
    assert rows(notes) == [(1, 1, "h1"), (2, 0, "h2: no photographed rooms"), (3, 0, "h3: 1 rooms, none matched the 1 gap(s)"), (4, 0, "no geo-verified candidate"), (5, 0, "no gaps")]


def test_environment_and_options(spark):
    gone = spark.createDataFrame([("unavailable",)] * 5, "outcome string")
    assert harvest.crossed_environment(gone) and not harvest.crossed_environment(gone.limit(0))
    assert not harvest.crossed_environment(gone.limit(4).union(spark.createDataFrame([("ok",)], "outcome string")))
    o = Options.read({"MATCHLOOM_DESTINATION": "Dubai", "MATCHLOOM_STALE_DAYS": "30", "MATCHLOOM_COUNTRY": " ", "MATCHLOOM_RESCUE_SOFT_VETOES": "no"})
    assert (o.destination, o.stale_days, o.country, o.rescue_soft_vetoes) == ("Dubai", 30, "", False)
    with pytest.raises(ValueError):
        Options.read({"MATCHLOOM_STALE_DAYS": "soon"})


def test_csv_and_lists(spark, tmp_path):
    q = spark.createDataFrame([(1, 7, None, "x")], "row_id long, hotel_id long, decision string, extra string")
    reports.write_csv(q, str(tmp_path / "q"), ["row_id", "hotel_id", "decision", "missing"])
    back = reports.read_queue(spark, str(tmp_path / "q"))
    assert back.columns == ["row_id", "hotel_id", "decision", "missing"] and tuple(back.first()) == (1, 7, None, None)
    lines = spark.createDataFrame([(0, "b, a # note"), (1, "c")], "pos int, line string")
    assert [r.slug for r in scans.keys_of(["c", "z"], lines).collect()] == ["c", "z", "b", "a"]
    h = spark.range(100)
    assert rows(scans.sampled(h, 5, 3)) == rows(scans.sampled(h.repartition(7), 5, 3)) != rows(scans.sampled(h, 5, 4))
    full = scans.with_categories(spark, spark.createDataFrame([(9, "general")], "id long, name string"))
    assert full.count() == len(N.all_categories()) and scans.missing_categories(spark, full).count() == 0 and full.agg(F.min("id")).first()[0] == 9


def test_reports(spark):
    s = spark.createDataFrame([(True, False, False), (False, True, True), (False, False, True)], "resolved boolean, unavailable boolean, errored boolean")
    assert tuple(reports.funnel(s).first()) == (3, 1, 1, 1, "ok")
    assert '"total":3' in reports.manifest("r1", reports.funnel(s)).first()[0]
    bad = spark.createDataFrame([(False, False, False)], s.schema)
    assert reports.funnel(bad).first().reconciled == "MISMATCH"


def test_plan_round_trip(spark, tmp_path):
    path = str(tmp_path / "plan")
    df = spark.createDataFrame([(1, "r", "s1"), (2, "r", "s2")], "hotel_id long, room string, scope string")
    publishing.append_plan(df, path)
    publishing.append_plan(df.filter("hotel_id = 1"), path)
    got = readers.plan_rows(spark, path, "s1", "hotel_id long, room string, scope string")
    assert got.count() == 2 and "PartitionFilters: [isnotnull(scope" in got._jdf.queryExecution().toString()
    assert rows(publishing.resume(df.select("hotel_id"), got, "s1")) == [(2,)]
    assert readers.with_columns(df, {"hotel_id": "long", "size_sqft": "int"}).filter("size_sqft IS NULL").count() == 2


def test_windows_of_outcomes(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert outcome_windows(spark.readStream.schema("ts timestamp, event_type string").parquet(str(tmp_path / "none"))).isStreaming


def test_appending_only():
    names = {n for m in (publishing, ledger) for n in dir(m)}
    assert not [n for n in names if any(w in n.lower() for w in ("delete", "drop", "truncate"))]
