"""Ledgers as files and as a stream."""

import datetime
import glob
import os
import random

import pytest
from pyspark.errors import PySparkException

from matchloom.operators import ledger
from matchloom.sources.logs import LedgerFiles
from matchloom.streaming.ledger import ledger_state, run_ledger

COLUMNS = "row_id long, hotel_id long, reason string, happened timestamp"
AT = datetime.datetime(2024, 1, 1)


@pytest.fixture
def source(spark):
    spark.dataSource.register(LedgerFiles)
    return lambda path, schema=f"{COLUMNS}, _fault string", **o: spark.read.format("ledger").options(key="hotel_id", **o).schema(schema).load(str(path))


def append(spark, path, *rows):
    spark.createDataFrame(rows, COLUMNS).repartition(3, "row_id").sortWithinPartitions("row_id").write.format("ledger").mode("append").save(str(path))


def test_round_trip(spark, source, tmp_path):
    first = [(1, 7, 'a, "b"', AT), (2, None, None, None), (3, 8, "line\nend", AT + datetime.timedelta(microseconds=5)), (4, 9, "é", AT)]
    append(spark, tmp_path, *first)
    append(spark, tmp_path, (5, 7, "later", AT))
    got = {r["row_id"]: r for r in source(tmp_path).collect()}
    assert got[1][2] == 'a, "b"' and got[3][2] == "line end" and got[3][3] == first[2][3] and got[4][2] == "é"
    assert got[2]["_fault"] == "key" and sum(r["_fault"] is None for r in got.values()) == 4
    order = source(tmp_path, f"{COLUMNS}, _file string, _at long").orderBy("_file", "_at").collect()
    assert order[-1]["row_id"] == 5 and len(order) == 4  # rows that do not count are left out where nobody asks for faults
    assert not glob.glob(f"{tmp_path}/_drafts/*")
    with pytest.raises(PySparkException):
        spark.createDataFrame([first[0]], COLUMNS).write.format("ledger").mode("overwrite").save(str(tmp_path))


def test_damage_and_stretches(spark, source, tmp_path):
    good = [f'{k},{k % 5},"r,{k}",2024-01-01T00:00:00' for k in range(200)]
    lines = [*good, "5,1", "9,x1,r,t", "", "3,old reason,2024-01-02 00:00:00", "1,2,3,4,5", "11,2,no time,never", '12,4,"torn', "13"]
    data = ("\r\n".join(lines[:100]) + "\n" + "\n".join(lines[100:])).encode() + b"\xff\xfe"
    (tmp_path / "a.csv").write_bytes(data)
    (tmp_path / ".hidden").write_text("1,1,1,1\n")
    (tmp_path / "empty.csv").write_text("")
    want = None
    for stretch in (1 << 20, 1000, 64, 7):
        rows = sorted(map(tuple, source(tmp_path, f"{COLUMNS}, _at long, _fault string", stretch=stretch).collect()), key=lambda r: r[4])
        assert want is None or rows == want
        want = rows
    assert [r[0] for r in want[:200]] == list(range(200)) and all(r[5] is None and r[2] == f"r,{r[0]}" for r in want[:200])
    assert [r[5] for r in want[200:]] == ["short", "key", "empty", None, "long", None, None, "short"]
    assert want[203][:3] == (None, 3, "old reason") and want[205][3] is None and want[206][:3] == (None, 12, "4")
    assert source(tmp_path / "nowhere").count() == 0


def test_a_run_that_fails_leaves_nothing(spark, source, tmp_path):
    append(spark, tmp_path, (1, 1, "x", AT))

    def fail(batches):
        for b in batches:
            yield b
        raise ValueError("lost")

    with pytest.raises(PySparkException):
        spark.createDataFrame([(2, 2, "y", AT)], COLUMNS).mapInArrow(fail, COLUMNS).write.format("ledger").mode("append").save(str(tmp_path))
    assert [r["row_id"] for r in source(tmp_path).collect()] == [1] and len(glob.glob(f"{tmp_path}/run-*")) == 1


@pytest.mark.parametrize("cuts", [[400], [100, 250, 400], [37, 38, 399, 400]])
def test_stream_equals_batch(spark, tmp_path, cuts):
    r = random.Random(4)
    log = [(k, r.randint(1, 30) if k < 200 else r.randint(1, 12), r.choice(["open", "resolved", None]), AT + datetime.timedelta(hours=k)) for k in range(400)]
    begin, written = 0, {}
    for end in cuts:
        part = spark.createDataFrame(log[begin:end], COLUMNS)
        part.write.mode("append").parquet(str(tmp_path / "in"))
        q = run_ledger(spark.readStream.schema(part.schema).parquet(str(tmp_path / "in")), str(tmp_path), days=2)
        assert q.awaitTermination(120)
        begin = end
        # what was written stays as it is
        now = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/changes/*.parquet")}
        assert written.items() <= now.items()
        written = now
    end = log[-1][3] - datetime.timedelta(hours=1)
    want = {(x["hotel_id"], x["row_id"], x["reason"], x["happened"], x["happened"] + datetime.timedelta(days=2) <= end) for x in ledger.latest(spark.createDataFrame(log, COLUMNS)).collect()}
    got = {tuple(x) for x in ledger_state(spark, str(tmp_path)).collect()}
    assert got == want and any(x[4] for x in got) and not all(x[4] for x in got)
