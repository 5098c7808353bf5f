"""The ledger as a stream: the last row of each hotel is state, and only changes are written."""

from __future__ import annotations

import datetime
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import vocabulary as V
from ..operators.unions import last_per_key

CHANGES = "hotel_id long, row_id long, reason string, happened timestamp, stale boolean, change long"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastRow(StatefulProcessor):
    """Keeps the row of the highest row_id of a hotel, and wakes when it gets stale.

    A change is told when another row becomes the last, and when the last one gets stale; changes of a hotel are numbered.
    """

    def __init__(self, days: int):
        self.days = datetime.timedelta(days=days)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "row_id long, reason string, happened timestamp, change long")

    def _told(self, hotel: int, row: tuple, stale: bool) -> Row:
        return Row(hotel_id=hotel, row_id=row[0], reason=row[1], happened=row[2], stale=stale, change=row[3])

    def _millis(self, happened: datetime.datetime) -> int:
        return int((happened + self.days).timestamp() * 1000)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        old = self.last.get() if self.last.exists() else None
        best = max(((r["row_id"], r["reason"], r["happened"]) for r in rows), key=lambda r: r[0])
        if old is None or best[0] > old[0]:
            now = (*best, (old[3] if old else 0) + 1)
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(self._millis(best[2]))
            self.last.update(now)
            yield self._told(key[0], now, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old = self.last.get()
        now = (old[0], old[1], old[2], old[3] + 1)
        self.last.update(now)
        yield self._told(key[0], now, True)

    def close(self) -> None:
        pass


def changes(log: DataFrame, days: int = V.STALE_DAYS, late: str = "1 hour") -> DataFrame:
    """The changes of a streamed log (hotel_id, row_id, reason, happened).

    A row gets stale once event time (less ``late``, for rows that come late) has passed it by ``days``. Rows older than that
    mark are not looked at. Rows without a hotel or a row_id are left out.
    """
    rows = log.filter("hotel_id IS NOT NULL AND row_id IS NOT NULL AND happened IS NOT NULL").withWatermark("happened", late)
    return rows.groupBy("hotel_id").transformWithState(LastRow(days), CHANGES, "Append", "EventTime")


def run_ledger(log: DataFrame, path: str, days: int = V.STALE_DAYS, late: str = "1 hour") -> StreamingQuery:
    """Take what the stream has now: changes are appended below ``path``, state goes to its checkpoint; later runs go on from there."""
    log.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)
    return changes(log, days, late).writeStream.format("parquet").outputMode("append").option("path", f"{path}/changes").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()


def ledger_state(spark: SparkSession, path: str) -> DataFrame:
    """The last change of each hotel."""
    return last_per_key(spark.read.schema(CHANGES).parquet(f"{path}/changes"), ["hotel_id"], ["change"]).select(*[c.split()[0] for c in CHANGES.split(", ")][:-1])


def outcome_windows(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events per type and window of event time, for streams with late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")
