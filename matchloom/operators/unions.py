"""Unions by key over repeated observations. Each is one aggregate with a total order: no row order matters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, keys: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Per key, the values of the first row by ``order``."""
    first = F.min_by(F.struct(*values), F.struct(*order)).alias("r")
    return rows.groupBy(*keys).agg(first).select(*keys, "r.*")


def richest_wins(rows: DataFrame, keys: list[str], richness: str, order: list[str], values: list[str]) -> DataFrame:
    """Per key, the values of the row with the largest ``richness``; ties go to the first by ``order``."""
    best = F.min_by(F.struct(*values), F.struct((-F.col(richness)).alias("_r"), *order)).alias("r")
    return rows.groupBy(*keys).agg(best).select(*keys, "r.*")


def last_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key, the last row by ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*keys, "r.*")


def merge_images(rows: DataFrame, keys: list[str], order: str, images: str, name: str) -> DataFrame:
    """Per key, the first name, and all images once, in the order of their first appearance."""
    spread = rows.select(*keys, F.col(order).alias("_o"), F.posexplode_outer(images).alias("_p", "_image"))
    firsts = spread.filter("_image IS NOT NULL").groupBy(*keys, "_image").agg(F.min(F.struct("_o", "_p")).alias("_at"))
    merged = firsts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_image"))), lambda s: s["_image"]).alias("images"))
    names = rows.groupBy(*keys).agg(F.min_by(name, order).alias(name))
    return names.join(merged, keys, "left").withColumn("images", F.coalesce("images", F.array().cast("array<string>")))


def collapse_rate_plans(options: DataFrame) -> DataFrame:
    """Distinct rooms of rate plans (hotel_id, option_seq, title, rooms): a blank room name falls back to the option's title.

    Of equal places (options that share a number) the least occupancy counts, so that the order of the rows does not.
    """
    rooms = options.select("hotel_id", "option_seq", "title", F.posexplode("rooms").alias("room_seq", "room"))
    name = F.coalesce(F.nullif(F.trim("room.name"), F.lit("")), F.nullif(F.trim("title"), F.lit("")))
    named = rooms.select("hotel_id", "option_seq", "room_seq", name.alias("room_name"), F.col("room.max_occupancy").alias("max_occupancy")).filter("room_name IS NOT NULL")
    return first_wins(named, ["hotel_id", "room_name"], ["option_seq", "room_seq", "max_occupancy"], ["max_occupancy"])


def matching_ids(payloads: DataFrame) -> DataFrame:
    """Payloads with whether the id inside is the id they were asked for."""
    return payloads.withColumn("id_ok", F.col("payload_id").eqNullSafe(F.col("hotel_id")))


def ingested(options: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms, rejected payloads) of rate plans with payload_id: a payload about another hotel than the one asked for gives no room."""
    checked = matching_ids(options)
    return collapse_rate_plans(checked.filter("id_ok")), checked.filter("NOT id_ok").select("hotel_id", "payload_id").distinct()
