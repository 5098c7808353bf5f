"""Rooms as they are published: made from mapped pairs, plan rows and reviews, and given to the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import vocabulary as V
from . import reports
from .store import Store


def category_ids(rooms: DataFrame, categories: DataFrame, category: str = "category") -> DataFrame:
    """``rooms`` with ``category_id``: that of the category (without regard to case), else that of the fallback.

    ``categories`` (id, name) is a taxonomy of tens of names; of several ids for one name the least counts.
    """
    known = categories.groupBy(F.lower(F.trim("name")).alias("_name")).agg(F.min("id").alias("_id"))
    spare = known.filter(F.col("_name") == V.FALLBACK_CATEGORY.lower()).select(F.col("_id").alias("_spare"))
    with_id = rooms.join(known, F.lower(F.col(category)) == F.col("_name"), "left")
    return with_id.join(spare, F.lit(True), "left").withColumn("category_id", F.coalesce("_id", "_spare")).drop("_name", "_id", "_spare")


def constructed(rows: DataFrame, categories: DataFrame, source: Column | None = None) -> DataFrame:
    """Rooms made of rows (hotel_id, room_name, images, size_sqft and more): category and its id, capped images, where they come from."""
    images = F.slice(F.coalesce("images", F.array().cast("array<string>")), 1, V.IMAGES_PER_ROOM)
    named = rows.withColumn("category", N.category(N.norm(F.col("room_name")))).withColumn("images", images)
    made = category_ids(named, categories)
    return made.withColumn("image_source", F.when(F.size("images") > 0, source if source is not None else F.lit("b")).otherwise(""))


def publishable(mapped: DataFrame, b: DataFrame, categories: DataFrame) -> DataFrame:
    """Rooms to publish of a mapping: matched ones with images and size of their counterpart, unmatched ones without, and leftovers.

    What is up for review is not among them. ``b`` has hotel_id, b_id, images, size_sqft. Rooms are numbered within
    their hotel (seq): those of the catalogue by id, then the leftovers.
    """
    offered = b.select("hotel_id", "b_id", "images", "size_sqft")
    rows = mapped.filter("status <> 'review'").select("hotel_id", "a_id", "room_name", "status", F.when(F.col("status") != "unmatched", F.col("b_id")).alias("b_id"))
    made = constructed(rows.join(offered, ["hotel_id", "b_id"], "left"), categories)
    order = Window.partitionBy("hotel_id").orderBy(F.asc_nulls_last("a_id"), "b_id")
    return made.withColumn("seq", F.row_number().over(order).cast("long"))


def from_plan(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Rooms of plan rows (hotel_id, room_name, images, size_sqft, image_source): the category is worked out anew, the source kept."""
    return constructed(rows, categories, F.col("image_source"))


def from_reviews(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Rooms of approved review rows (row_id, hotel_id, room_name, candidate_images joined by "|", candidate_size_sqft)."""
    images = F.filter(F.split(F.coalesce("candidate_images", F.lit("")), r"\|"), lambda u: u != "")
    yes = rows.filter(reports.approved(F.col("decision"))).withColumn("images", images).withColumn("size_sqft", F.col("candidate_size_sqft").try_cast("int"))
    return constructed(yes, categories)


def apply_reviews(queue: DataFrame, mirrored: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rooms to publish, queue that remains).

    ``mirrored`` (row_id, thumbnail, images) has what the approved rows' images became. A row whose images all failed
    stays in the queue; so does an approved row without row_id, though it is published.
    """
    made = from_reviews(queue, categories).withColumn("had", F.size("images") > 0).drop("images")
    hosted = made.join(mirrored.select("row_id", "thumbnail", F.col("images").alias("images")), "row_id", "left")
    ready = hosted.filter(~F.col("had") | F.col("thumbnail").isNotNull()).drop("had").withColumn("images", F.array_compact(F.concat(F.array("thumbnail"), F.coalesce("images", F.array().cast("array<string>")))))
    return ready, reports.remaining(queue, ready.select("row_id"))


# --- the store


def stored(spark: SparkSession, path: str, what: str = "rooms") -> DataFrame:
    """The rooms (or ``gallery``) of the store's last version; empty if there is none."""
    store = Store(spark, path)
    return store.rooms() if what == "rooms" else store.gallery()


def publish(incoming: DataFrame, path: str) -> DataFrame:
    """Publish rooms: insert new ones, fill what is empty, never change what is there. Returns counters per hotel.

    ``incoming``: hotel_id, seq, room_name, thumbnail, size_sqft, category_id, images. A run that dies leaves the store as
    it was; runs at the same time do not lose what the others wrote.
    """
    return Store(incoming.sparkSession, path).publish(incoming)
