"""Ladders of date and occupancy probes, and what they found. Unknown is never taken for zero."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V


def weekend_checkin(day: Column, weeks: Column) -> Column:
    """The next Saturday strictly after ``day``, and ``weeks`` weeks on from there."""
    return F.date_add(F.next_day(day, "SAT"), (weeks * 7).cast("int"))


def probe_shapes(spark: SparkSession, ladder=V.BASE_LADDER) -> DataFrame:
    """Each rung at the weekend and three days later: seq, weeks, adults, nights, shift_days, label."""
    rows = [(2 * i + k, w, a, n, V.MIDWEEK_DAYS * k, f"{'midweek' if k else 'weekend'}+{w}w/{a}ad/{n}n") for i, (w, a, n) in enumerate(ladder) for k in (0, 1)]
    return spark.createDataFrame(rows, "seq int, weeks int, adults int, nights int, shift_days int, label string")


def stays(shapes: DataFrame, days: DataFrame) -> DataFrame:
    """Check-in and check-out of each shape for each day (day)."""
    at = F.date_add(weekend_checkin(F.col("day"), F.col("weeks")), F.col("shift_days"))
    return days.select("day").distinct().crossJoin(F.broadcast(shapes)).select("day", "label", at.alias("check_in"), F.date_add(at, F.col("nights")).alias("check_out"))


def outcome(status: Column, unavailable: list[str], error: list[str]) -> Column:
    """ok, unavailable (a stated fact) or error (never answered); no status is no answer."""
    return F.when(status.isNull() | status.isin(*error), "error").when(status.isin(*unavailable), "unavailable").otherwise("ok")


def outcomes(probes: DataFrame) -> DataFrame:
    """Per hotel: whether it answered, is unavailable, had errors, and its number of answers."""
    return probes.groupBy("hotel_id").agg(F.bool_or(F.col("outcome") == "ok").alias("resolved"), F.bool_or(F.col("outcome") == "unavailable").alias("unavailable"), F.bool_or(F.col("outcome") == "error").alias("errored"), F.count_if(F.col("outcome") == "ok").alias("n_ok"))


def metrics(probes: DataFrame, rooms: DataFrame) -> DataFrame:
    """Per shape: hotels probed, answered, unavailable, errors, and names first seen in it."""
    asked = probes.groupBy("shape").agg(F.countDistinct("hotel_id").alias("hotels_probed"), F.count_if(F.col("outcome") == "ok").alias("answered"), F.count_if(F.col("outcome") == "unavailable").alias("unavailable"), F.count_if(F.col("outcome") == "error").alias("errors"))
    gained = rooms.groupBy("hotel_id", "room_name").agg(F.min("shape").alias("shape")).groupBy("shape").agg(F.count("*").alias("new_rooms"))
    return asked.join(gained, "shape", "left").withColumn("new_rooms", F.coalesce("new_rooms", F.lit(0)))


def needs_wider(hotels: DataFrame, base_rooms: DataFrame, found: DataFrame) -> DataFrame:
    """Hotels that still hold no room after the base ladder and are not known to be unavailable."""
    gone = found.filter("unavailable").select("hotel_id")
    return hotels.join(base_rooms.select("hotel_id").distinct(), "hotel_id", "left_anti").join(gone, "hotel_id", "left_anti")


def ladder_complete(probes: DataFrame) -> DataFrame:
    """Per hotel: complete only if no rung failed; a zero is believed only then."""
    done = F.bool_and(F.col("outcome") != "error")
    n = F.sum("n_rooms")
    return probes.groupBy("hotel_id").agg(done.alias("complete"), n.alias("n_rooms"), F.when(n > 0, "rooms").when(done, "zero").otherwise("unknown").alias("state"))


def fresh_rooms(cache: DataFrame, today: Column, days: int = V.FRESH_DAYS) -> DataFrame:
    """Cached properties; the metadata never expires, rooms of unknown or old age are dropped."""
    fresh = F.coalesce(F.datediff(today, F.to_date("rooms_at")) <= days, F.lit(False))
    return cache.withColumn("rooms", F.when(fresh, F.col("rooms")).otherwise(F.array().cast(cache.schema["rooms"].dataType))).withColumn("fresh", fresh)


def plateau_stop(gains: DataFrame, flat: int = V.FLAT_STOP) -> DataFrame:
    """Of (hotel_id, shape, gained, n_gaps): the shapes up to the stop, which is where the gaps are covered or ``flat`` shapes in a row gained nothing."""
    w = Window.partitionBy("hotel_id").orderBy("shape")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    island = gains.withColumn("covered", F.sum("gained").over(so_far)).withColumn("hits", F.sum(F.when(F.col("gained") > 0, 1).otherwise(0)).over(so_far))
    streak = F.sum(F.when(F.col("gained") > 0, 0).otherwise(1)).over(Window.partitionBy("hotel_id", "hits").orderBy("shape").rowsBetween(Window.unboundedPreceding, 0))
    ended = island.withColumn("flat", streak).withColumn("stop", (F.col("covered") >= F.col("n_gaps")) | (F.col("flat") >= flat))
    before = F.coalesce(F.max(F.col("stop").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return ended.withColumn("stopped", before).filter("stopped = 0").select("hotel_id", "shape", "gained", "covered", "flat")


def failure_streaks(attempts: DataFrame, key: str, order: list[str], failed: str) -> DataFrame:
    """Per key: the longest and the trailing run of failures; degraded at eight in a row, rotations at every third."""
    so_far = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    runs = attempts.withColumn("_isle", F.sum(F.when(F.col(failed), 0).otherwise(1)).over(so_far))
    per_run = runs.groupBy(key, "_isle").agg(F.count_if(F.col(failed)).alias("_n"))
    return per_run.groupBy(key).agg(F.max("_n").alias("longest"), F.max_by("_n", "_isle").alias("trailing"), F.sum(F.floor(F.col("_n") / V.ROTATE_AFTER)).cast("long").alias("rotations")).withColumn("degraded", F.col("trailing") >= V.DEGRADED_AFTER)
