"""Selections from the catalogue. Filters and column lists reach the scan; nothing is read twice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .numbering import numbered


def by_city(hotels: DataFrame, city_ids: list[int]) -> DataFrame:
    """Hotels of the cities, in order of id."""
    return hotels.filter(F.col("city_id").isin(city_ids)).orderBy("id")


def ids(hotels: DataFrame) -> DataFrame:
    """Ids only; no other column is read."""
    return hotels.select("id")


def by_slug(hotels: DataFrame, slugs: DataFrame) -> DataFrame:
    """Hotels whose slug is listed; blank slugs never match."""
    wanted = slugs.select(F.trim("slug").alias("slug")).filter("slug <> ''").distinct()
    return hotels.filter(F.trim("slug") != "").join(wanted, "slug", "left_semi")


def window_minus_skip(hotels: DataFrame, skip: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """A fixed window of the catalogue, by id, and only then without the ids to skip: the window does not slide."""
    return hotels.orderBy("id").offset(offset).limit(limit).join(skip.select("id").distinct(), "id", "left_anti")


def sampled(hotels: DataFrame, n: int, seed: int) -> DataFrame:
    """``n`` hotels drawn at random, the same ones for the same seed whatever the order of the rows."""
    return hotels.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(n)


def keys_of(inline: list[str], text_lines: DataFrame) -> DataFrame:
    """Keys given directly and those of a file, in this order, each once."""
    given = text_lines.sparkSession.createDataFrame([(i - len(inline), k) for i, k in enumerate(inline)], "pos long, line string")
    return key_list(given.unionByName(text_lines.select(F.col("pos").cast("long").alias("pos"), "line")))


def key_list(text_lines: DataFrame) -> DataFrame:
    """Keys of lines (pos, line): comments and blanks dropped, first place of each key kept, in order."""
    parts = text_lines.select("pos", F.posexplode(F.split(F.regexp_replace("line", "#.*$", ""), r"[,\s]+")).alias("at", "slug")).filter("slug <> ''")
    return parts.groupBy("slug").agg(F.min(F.struct("pos", "at")).alias("first")).orderBy("first").select("slug")


def resolve_city(cities: DataFrame, countries: DataFrame, hotels: DataFrame, query: str) -> DataFrame:
    """Cities by id or by a part of the name, with country and number of hotels, most hotels first; deleted ones never."""
    counts = hotels.groupBy(F.col("city_id").alias("id")).agg(F.count("*").alias("n_hotels"))
    wanted = F.col("id") == int(query) if query.isdigit() else F.lower("name_en").contains(query.lower())
    found = cities.filter(wanted & F.col("deleted_at").isNull()).join(countries, "country_id", "left").join(counts, "id", "left")
    return found.select("id", "name_en", "country", F.coalesce("n_hotels", F.lit(0)).alias("n_hotels")).orderBy(F.desc("n_hotels"), "id")


def existing_flags(rooms: DataFrame, hotels: DataFrame | None = None, city_id: int | None = None) -> DataFrame:
    """What is stored of each room: image, size, category; one join for a whole city. A missing size column is null."""
    size = F.col("size_sqft") if "size_sqft" in rooms.columns else F.lit(None).cast("int")
    if hotels is not None:
        inside = hotels.filter(F.col("city_id") == city_id) if city_id is not None else hotels
        rooms = rooms.join(inside.select(F.col("id").alias("hotel_id")), "hotel_id")
    return rooms.select("hotel_id", F.lower(F.substring(F.trim("name"), 1, 191)).alias("room_key"), (F.trim(F.coalesce("thumbnail", F.lit(""))) != "").alias("has_image"), (F.coalesce(size, F.lit(0)) > 0).alias("has_size"), F.col("category_id").isNotNull().alias("has_category"))


def missing_keys(wanted: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Keys asked for that no row has."""
    return wanted.select(key).distinct().join(found.select(key).distinct(), key, "left_anti")


def missing_categories(spark, stored: DataFrame) -> DataFrame:
    """Categories of the taxonomy that have no id yet (compared without case); must be empty before publishing."""
    from ..functions.names import all_categories

    names = spark.createDataFrame([(c,) for c in all_categories()], "name string")
    return names.join(stored.select(F.lower("name").alias("have")).distinct(), F.lower("name") == F.col("have"), "left_anti")


def with_categories(spark, stored: DataFrame) -> DataFrame:
    """The taxonomy (id, name) with the categories that were missing, their ids going on from the last."""
    top = stored.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    new = missing_categories(spark, stored).select("name")
    return stored.select("id", "name").unionByName(numbered(new, [F.asc("name")], "id").select((F.col("id") + top).alias("id"), "name"))


def suggest_join(suggestions: DataFrame, models: DataFrame, kind: int = 7) -> DataFrame:
    """Suggestions of one kind with their view model, where there is one."""
    return suggestions.filter(F.col("kind") == kind).join(models, "object_id", "left")
