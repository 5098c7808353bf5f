"""The store of rooms: deltas, conflicts, merges."""

import glob
import threading

import pytest
from pyspark.sql import functions as F

from matchloom.operators.store import Conflict, Store, publishing_together

ROOMS = "hotel_id long, seq long, room_name string, thumbnail string, size_sqft int, category_id long, images array<string>"


def rooms_of(spark, *rows):
    return spark.createDataFrame([(h, s, n, t, z, c, [t, "g"] if t else []) for h, s, n, t, z, c in rows], ROOMS)


def state(store, at=None):
    return sorted(map(tuple, store.rooms(at).collect()), key=str)


def files(path):
    return {f: open(f, "rb").read() for f in glob.glob(f"{path}/deltas/**/*.parquet", recursive=True)}


def test_published_files_are_never_touched(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    assert state(store) == [] and store.version() == 0
    store.publish(rooms_of(spark, (1, 1, "King", None, 9, None), (2, 1, "Twin", "t", None, 3), (1, 2, " king ", "late", 1, 1)))
    before = files(tmp_path)
    got = {r["hotel_id"]: r for r in store.publish(rooms_of(spark, (1, 1, "KING", "k", 5, 4), (3, 1, "Loft", "l", 1, 1))).collect()}
    assert (got[1]["fill"], got[3]["insert"]) == (1, 1)
    after = files(tmp_path)
    assert all(after[f] == b for f, b in before.items()) and len(after) > len(before)
    # only the buckets of hotels 1 and 3 got files
    touched = {f.split("bucket=")[1].split("/")[0] for f in after if f not in before and "/rooms/" in f}
    wanted = {str(r["b"]) for r in spark.createDataFrame([(1,), (3,)], "h long").select(store.bucket(F.col("h")).alias("b")).collect()}
    assert touched == wanted
    assert state(store) == [(1, 1, "King", "k", 9, 4), (2, 2, "Twin", "t", None, 3), (3, 3, "Loft", "l", 1, 1)]
    assert [len(state(store, store.snapshot(v))) for v in (1, 2)] == [2, 3]
    assert sorted(map(tuple, store.gallery().collect())) == [(1, "king", 1, "g"), (2, "twin", 1, "g"), (3, "loft", 1, "g")]


def test_who_comes_second(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=64)
    store.load(spark.createDataFrame([(7, 1, "King", "", 3, None)], "id long, hotel_id long, name string, thumbnail string, size_sqft int, category_id long"))
    # different hotels: the delta of the second holds, its new rooms are numbered after those of the first
    first, second = store.prepare(rooms_of(spark, (2, 1, "A", None, 1, 1))), store.prepare(rooms_of(spark, (5, 1, "B", None, 1, 1)))
    assert not set(first.delta.buckets) & set(second.delta.buckets)
    store.commit(second)
    _, kept = store.commit(first)
    assert kept.delta.folder == first.delta.folder
    assert [x[:3] for x in state(store)] == [(7, 1, "King"), (8, 5, "B"), (9, 2, "A")]
    # the same hotel: worked out again against what the other published
    counted = publishing_together(store, [rooms_of(spark, (1, 1, "king", "mine", 1, 1), (1, 2, "New", None, 5, None)), rooms_of(spark, (1, 1, "new", "theirs", None, 2), (1, 2, "king", None, None, 9))])
    assert counted[1] == {"insert": 1, "fill": 1, "skip_existing": 0, "skip_duplicate": 0, "thumbnails": 1}
    assert counted[0] == {"insert": 0, "fill": 2, "skip_existing": 0, "skip_duplicate": 0, "thumbnails": 1}
    assert [x for x in state(store) if x[1] == 1] == [(10, 1, "new", "theirs", 5, 2), (7, 1, "King", "mine", 3, 9)]


def test_writers_at_the_same_time(spark, tmp_path):
    made = [Store(spark, str(tmp_path), buckets=4) for _ in range(3)]
    runs = [rooms_of(spark, *[(h, 1, f"Room {k}", f"t{k}", None, None) for h in range(1, 6)], (9, 1, "Shared", None, k, None)) for k in range(3)]
    errors = []

    def work(store, run):
        try:
            store.publish(run)
        except Exception as e:
            errors.append(e)

    threads = [threading.Thread(target=work, args=x) for x in zip(made, runs, strict=True)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and made[0].version() == 3
    found = state(made[0])
    assert len(found) == 16 and len({x[0] for x in found}) == 16 and max(x[0] for x in found) == 16
    assert sorted((x[1], x[2]) for x in found if x[1] < 9) == sorted((h, f"Room {k}") for h in range(1, 6) for k in range(3))


def test_merging(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=4, fanout=3)
    for k in range(6):
        store.publish(rooms_of(spark, (1, 1, "King", f"t{k}" if k > 2 else None, k if k > 1 else None, None), (k, 2, f"Room {k}", None, None, None)))
        assert len(store.snapshot().deltas) <= 4
    want = state(store)
    assert [x for x in want if x[2] == "King"] == [(2, 1, "King", "t3", 2, None)] and len(want) == 7
    early = store.prepare(rooms_of(spark, (1, 1, "King", None, None, 5)))
    store.compact()
    assert len(store.snapshot().deltas) == 1 and state(store) == want and not store.compact()
    store.commit(early)  # a merge in between changes nothing for it
    assert [x for x in state(store) if x[2] == "King"] == [(2, 1, "King", "t3", 2, 5)]
    assert store.sweep() and state(store) == sorted(((*x[:5], 5) if x[2] == "King" else x for x in want), key=str)
    with pytest.raises(Conflict):
        store.load(store.rooms())


def test_incoming_is_read_once(spark, tmp_path, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    store = Store(spark, str(tmp_path))
    store.publish(rooms_of(spark, (1, 1, "King", "k", 1, 1), (2, 1, "Twin", None, 1, 1)).mapInArrow(count, ROOMS))
    assert read.value == 2 and store.snapshot().counted == {"insert": 2, "fill": 0, "skip_existing": 0, "skip_duplicate": 0, "thumbnails": 1}
