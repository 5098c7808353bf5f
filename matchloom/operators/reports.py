"""Reviews, counters and reports that check themselves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numbering import numbered


def approved(decision: Column) -> Column:
    return F.coalesce(F.lower(F.trim(decision)).isin("y", "yes", "approve", "approved"), F.lit(False))


def review_queue(rows: DataFrame, first_id: int = 0) -> DataFrame:
    """Review rows by falling score, numbered on from ``first_id``."""
    return numbered(rows, [F.desc("score"), F.asc("hotel_id"), F.asc("a_id")], "row_id").withColumn("row_id", F.col("row_id") + first_id)


def remaining(queue: DataFrame, applied: DataFrame) -> DataFrame:
    return queue.join(applied.select("row_id").distinct(), "row_id", "left_anti")


def reason_histogram(log: DataFrame) -> DataFrame:
    return log.groupBy("reason").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "reason")


def runnable(hotels: DataFrame, fresh: DataFrame) -> DataFrame:
    """Per city: hotels, fresh ones, and those left to run."""
    both = hotels.join(fresh.select(F.col("hotel_id").alias("id"), F.lit(True).alias("fresh")).distinct(), "id", "left")
    return both.groupBy("city_id").agg(F.count("*").alias("total"), F.count_if(F.col("fresh").isNotNull()).alias("fresh"), F.count_if(F.col("fresh").isNull()).alias("runnable"))


def funnel(states: DataFrame) -> DataFrame:
    """One row of counts of (unavailable, errored, resolved) states, with the identity that they must satisfy."""
    counts = states.agg(
        F.count("*").alias("total"),
        F.count_if("resolved").alias("resolved"),
        F.count_if(~F.col("resolved") & F.col("unavailable")).alias("unavailable"),
        F.count_if(~F.col("resolved") & ~F.col("unavailable") & F.col("errored")).alias("unanswered"),
    )
    return counts.withColumn("reconciled", F.when(F.col("total") == F.col("resolved") + F.col("unavailable") + F.col("unanswered"), "ok").otherwise("MISMATCH"))


def gate_summary(states: DataFrame, blind: Column, mapped: Column) -> DataFrame:
    """The funnel at the gate before publishing: hotels planned, those mapped, and how many of these without the second source.

    Total and subtotal are both counted at the time of mapping, so that one cannot exceed the other.
    """
    counts = states.agg(F.count("*").alias("planned"), F.count_if(mapped).alias("mapped"), F.count_if(mapped & blind).alias("mapped_blind"), F.count_if(~mapped).alias("not_mapped"))
    ok = (F.col("planned") == F.col("mapped") + F.col("not_mapped")) & (F.col("mapped_blind") <= F.col("mapped"))
    return counts.withColumn("reconciled", F.when(ok, "ok").otherwise("MISMATCH"))


def skip_counts(here: DataFrame, skip: DataFrame, fresh: DataFrame, unresolved: DataFrame) -> DataFrame:
    """Of the hotels in scope (hotel_id): how many there are, are skipped, are fresh but have an open failure, and are left to do."""
    one = lambda df, name: df.select("hotel_id", F.lit(True).alias(name)).distinct()
    flags = here.select("hotel_id").distinct().join(one(skip, "skip"), "hotel_id", "left").join(one(fresh, "fresh"), "hotel_id", "left").join(one(unresolved, "open"), "hotel_id", "left")
    skipped, again = F.col("skip").isNotNull(), F.col("fresh").isNotNull() & F.col("open").isNotNull()
    return flags.agg(F.count("*").alias("in_scope"), F.count_if(skipped).alias("skipped"), F.count_if(again).alias("backfill"), F.count_if(~skipped).alias("todo"))


def run_counters(hotels: DataFrame, rooms: DataFrame) -> DataFrame:
    """The counters of a run in one row.

    ``hotels``: one row per hotel with resolved, unavailable, errored, matched, reachable, blind, requeued (booleans) and
    n_gaps, n_filled; ``rooms``: one row per room with status, action, n_images, sets_thumbnail.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    by_hotel = hotels.agg(
        F.count("*").alias("hotels_total"),
        F.count_if(flag("resolved")).alias("hotels_resolved"),
        F.count_if(~flag("resolved") & flag("unavailable")).alias("hotels_unavailable"),
        F.count_if(~flag("resolved") & ~flag("unavailable") & flag("errored")).alias("hotels_unanswered"),
        F.count_if(flag("matched")).alias("hotels_matched"),
        F.count_if(~flag("matched") & flag("reachable")).alias("hotels_no_match"),
        F.count_if(~flag("matched") & ~flag("reachable")).alias("hotels_unreachable"),
        F.count_if(flag("blind")).alias("hotels_blind"),
        F.count_if(flag("requeued")).alias("hotels_requeued"),
        F.count_if(F.col("n_gaps") > 0).alias("hotels_with_gaps"),
        F.count_if((F.col("n_gaps") > 0) & (F.col("n_filled") >= F.col("n_gaps"))).alias("hotels_gaps_closed"),
        F.coalesce(F.sum("n_gaps"), F.lit(0)).alias("gaps"),
        F.coalesce(F.sum("n_filled"), F.lit(0)).alias("gaps_filled"),
    )
    status = lambda s: F.count_if(F.col("status") == s).alias(f"rooms_{s}")
    action = lambda a: F.count_if(F.col("action") == a).alias(f"published_{a}")
    by_room = rooms.agg(
        F.count("*").alias("rooms_total"),
        *[status(s) for s in ("publish", "review", "unmatched", "leftover")],
        *[action(a) for a in ("insert", "fill", "skip_existing", "skip_duplicate")],
        F.count_if(F.col("n_images") > 0).alias("rooms_with_images"),
        F.count_if(F.coalesce(F.col("n_images"), F.lit(0)) == 0).alias("rooms_without_images"),
        F.count_if(flag("sets_thumbnail")).alias("thumbnails_set"),
    )
    return by_hotel.join(by_room, F.lit(True))


def count_label(n: Column, asked: Column, unavailable: Column, errored: Column) -> Column:
    """A count, or which kind of zero it is."""
    return F.when(~asked, "n/a").when(n > 0, n.cast("string")).when(unavailable, "0(unsellable)").when(errored, "0(no answer)").otherwise("0(verified)")


def mirrored(results: DataFrame) -> DataFrame:
    """Of (hotel_id, room_key, pos, hosted): the first that succeeded is the thumbnail, the rest, in order, the gallery."""
    got = results.groupBy("hotel_id", "room_key").agg(F.array_sort(F.collect_list(F.when(F.col("hosted").isNotNull(), F.struct("pos", "hosted")))).alias("s"))
    urls = F.transform("s", lambda x: x["hosted"])
    return got.select("hotel_id", "room_key", F.get(urls, F.lit(0)).alias("thumbnail"), F.slice(urls, F.lit(2), F.greatest(F.size(urls), F.lit(1))).alias("images"))


def manifest(run_id: str, counts: DataFrame) -> DataFrame:
    return counts.select(F.to_json(F.struct(F.lit(run_id).alias("run_id"), F.struct(*counts.columns).alias("counts"))).alias("manifest"))


def write_csv(rows: DataFrame, path: str, columns: list[str]) -> None:
    """A report with the given columns: others are left out, those that are missing stay blank, as does a null."""
    cells = [F.col(c).cast("string").alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns]
    rows.select(*cells).write.mode("overwrite").option("header", True).option("emptyValue", "").option("nullValue", "").csv(path)


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """A review queue as it was written; a row_id that is no number is none."""
    rows = spark.read.option("header", True).csv(path)
    return rows.withColumn("row_id", F.col("row_id").try_cast("long")).withColumn("hotel_id", F.col("hotel_id").try_cast("long"))
