"""Append-only ledgers where the last row of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from .numbering import numbered
from .unions import last_per_key


def latest(log: DataFrame, key: str = "hotel_id") -> DataFrame:
    return last_per_key(log, [key], ["row_id"])


def fresh_ids(published: DataFrame, today: Column, days: int = V.STALE_DAYS) -> DataFrame:
    """Hotels last published within ``days``."""
    return latest(published).filter(F.to_date("happened") >= F.date_sub(today, days)).select("hotel_id")


def unresolved_ids(log: DataFrame, city_id: int | None = None) -> DataFrame:
    """Hotels whose last outcome is an open failure, of one city if ``city_id`` is given (the log has it then)."""
    open_ = latest(log).filter("reason <> 'resolved'")
    return (open_ if city_id is None else open_.filter(F.col("city_id") == city_id)).select("hotel_id")


def skip_ids(published: DataFrame, log: DataFrame, today: Column, days: int = V.STALE_DAYS) -> DataFrame:
    """Fresh hotels without an open failure: these are not run again."""
    return fresh_ids(published, today, days).join(unresolved_ids(log), "hotel_id", "left_anti")


def append_rows(log: DataFrame, new: DataFrame, order: list[str]) -> DataFrame:
    """The log with rows added; their ids go on from its last, reasons are cut to their length."""
    last = log.agg(F.coalesce(F.max("row_id"), F.lit(0)).alias("last")).first()["last"]
    rows = numbered(new.drop("row_id"), [F.asc(c) for c in order], "row_id").withColumn("row_id", F.col("row_id") + last)
    return log.unionByName(rows.withColumn("reason", F.substring("reason", 1, V.REASON_LENGTH)).select(log.columns))


def read_log(lines: DataFrame, columns: list[str], oldest: int | None = None) -> DataFrame:
    """Rows of a CSV log (seq, line), the last of each key: torn rows are skipped, rows of an older schema (a suffix of the present one, ``oldest`` columns or more) are read as such, ids that are no number are dropped."""
    cells = F.split("line", ",", -1)
    rows = lines.withColumn("cells", cells).withColumn("missing", F.lit(len(columns)) - F.size("cells")).filter(F.col("missing").between(0, len(columns) - (oldest or len(columns) - 1)))
    fields = [F.when(F.col("missing") <= i, F.get("cells", F.lit(i) - F.col("missing"))).alias(c) for i, c in enumerate(columns)]
    typed = rows.select("seq", *fields).withColumn("hotel_id", F.col("hotel_id").try_cast("long")).filter("hotel_id IS NOT NULL")
    return last_per_key(typed, ["hotel_id"], ["seq"])
