"""Plans, gaps, and publishing that inserts or fills but never changes what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V


def blank(c: Column) -> Column:
    """Null for null, empty and white text."""
    return F.nullif(F.trim(c), F.lit(""))


def room_key(name: Column) -> Column:
    return F.lower(F.substring(F.trim(name), 1, V.NAME_LENGTH))


def gap_rooms(rooms: DataFrame, stored: DataFrame) -> DataFrame:
    """Rooms with neither a candidate image nor a stored one."""
    have = stored.select("hotel_id", "room_key", "has_image").distinct()
    keyed = rooms.withColumn("room_key", room_key(F.col("room_name")))
    return keyed.join(have, ["hotel_id", "room_key"], "left").filter((F.size("images") == 0) & ~F.coalesce("has_image", F.lit(False))).drop("has_image")


def split_for_mirroring(rooms: DataFrame, stored: DataFrame) -> DataFrame:
    """Rooms with ``need_mirror``; images of rooms that have one already are emptied, so that nothing is fetched for them."""
    have = stored.groupBy("hotel_id", "room_key").agg(F.bool_or("has_image").alias("has_image"))
    keyed = rooms.withColumn("room_key", room_key(F.col("room_name"))).join(have, ["hotel_id", "room_key"], "left")
    need = ~F.coalesce("has_image", F.lit(False)) & (F.size("images") > 0)
    return keyed.withColumn("need_mirror", need).withColumn("images", F.when(need, F.slice("images", 1, V.IMAGES_PER_ROOM)).otherwise(F.array().cast("array<string>"))).drop("has_image")


def gap_fill(gaps: DataFrame, offered: DataFrame) -> DataFrame:
    """Gaps filled by name from another source; the first offer wins, no room is added, sizes stay."""
    firsts = offered.withColumn("room_key", room_key(F.col("room_name"))).groupBy("hotel_id", "room_key").agg(F.min_by("images", "seq").alias("found"))
    return gaps.join(firsts, ["hotel_id", "room_key"], "left").withColumn("images", F.coalesce("found", "images")).withColumn("filled", F.coalesce(F.size("found") > 0, F.lit(False))).drop("found")


def actions(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming rooms with what publishing does: insert, fill, skip_existing or skip_duplicate (a key seen before in this run).

    Incoming: hotel_id, seq, room_name, thumbnail, size_sqft, category_id. Stored: hotel_id, name, and the same three.
    """
    key = ["hotel_id", "room_key"]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("seq"))
    new = incoming.withColumn("room_key", room_key(F.col("room_name"))).withColumn("nth", nth)
    old = stored.withColumn("room_key", room_key(F.col("name"))).groupBy(*key).agg(*[F.min(F.struct(F.col("id"), F.col(c))).getField(c).alias(f"old_{c}") for c in ("thumbnail", "size_sqft", "category_id")], F.min("id").alias("old_id"), F.lit(True).alias("known"))
    both = new.join(old, key, "left")
    fills = {c: blank(F.col(f"old_{c}")).isNull() & blank(F.col(c)).isNotNull() if c == "thumbnail" else F.col(f"old_{c}").isNull() & F.col(c).isNotNull() for c in ("thumbnail", "size_sqft", "category_id")}
    action = F.when(F.col("nth") > 1, "skip_duplicate").when(F.col("known").isNull(), "insert").when(fills["thumbnail"] | fills["size_sqft"] | fills["category_id"], "fill").otherwise("skip_existing")
    return both.withColumn("action", action).withColumn("sets_thumbnail", F.col("action").isin("insert", "fill") & fills["thumbnail"])


def filled(acted: DataFrame) -> DataFrame:
    """The rooms as stored afterwards: a value that is there stays, an empty text does not count as one."""
    kept = acted.filter("action <> 'skip_duplicate'")
    return kept.select("hotel_id", "room_key", F.coalesce(blank(F.col("old_thumbnail")), blank(F.col("thumbnail"))).alias("thumbnail"), F.coalesce("old_size_sqft", "size_sqft").alias("size_sqft"), F.coalesce("old_category_id", "category_id").alias("category_id"), "action")


def gallery(acted: DataFrame) -> DataFrame:
    """Gallery rows: images after the first, for new rooms and for those whose thumbnail is newly set."""
    wanted = acted.filter((F.col("action") == "insert") | F.col("sets_thumbnail"))
    return wanted.select("hotel_id", "room_key", F.posexplode(F.slice("images", 1, V.IMAGES_PER_ROOM)).alias("pos", "url")).filter("pos > 0")


def counters(acted: DataFrame) -> DataFrame:
    """Per hotel, rows by action and thumbnails set."""
    one = lambda a: F.count_if(F.col("action") == a).alias(a)
    return acted.groupBy("hotel_id").agg(one("insert"), one("fill"), one("skip_existing"), one("skip_duplicate"), F.count_if("sets_thumbnail").alias("thumbnails"))


def scope(ids: Column, tuning: str) -> Column:
    """Fingerprint of a set of ids and the settings that a plan or probe was made with."""
    return F.md5(F.concat(F.array_join(F.transform(F.array_sort(F.array_distinct(ids)), lambda x: x.cast("string")), ","), F.lit("|" + tuning)))


def resume(todo: DataFrame, plan: DataFrame, scope_id: str) -> DataFrame:
    """Hotels that this scope's plan does not hold yet; the plan is partitioned by scope."""
    return todo.join(plan.filter(F.col("scope") == scope_id).select("hotel_id").distinct(), "hotel_id", "left_anti")


def append_plan(rows: DataFrame, path: str) -> None:
    """Append plan rows, one partition per scope. The writer offers appending only: nothing here updates or deletes."""
    rows.write.mode("append").partitionBy("scope").parquet(path)
