"""Harvests over captured probes: ladders, their checkpoints, sources by priority, and filling gaps from a third source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..session import cut
from . import mapping, probing, unions


def sellable(probes: DataFrame) -> DataFrame:
    """Probes of (hotel_id, seq, outcome) up to and with the first that says the hotel is unavailable: later ones are not asked."""
    gone = F.min(F.when(F.col("outcome") == "unavailable", F.col("seq"))).over(Window.partitionBy("hotel_id"))
    return probes.withColumn("_gone", gone).filter(F.col("_gone").isNull() | (F.col("seq") <= F.col("_gone"))).drop("_gone")


def harvest(hotels: DataFrame, probes: DataFrame, rooms: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rooms, states, metrics) of a base ladder and, for hotels that it leaves empty, a wider one.

    ``hotels``: hotel_id, slug; those without a slug are not asked. ``probes``: hotel_id, phase (base or wider), seq,
    outcome; ``rooms``: hotel_id, phase, seq, room_name and more. The wider ladder counts only for hotels without a room
    that are not known to be unavailable. Rooms are united over all shapes, the first to show a name wins. A hotel that
    never answered is errored, not empty.
    """
    asked = hotels.filter(F.trim(F.coalesce("slug", F.lit(""))) != "").select("hotel_id").distinct()
    known = sellable(probes.join(asked, "hotel_id", "left_semi"))
    answered = known.filter("outcome = 'ok'").select("hotel_id", "phase", "seq")
    seen = rooms.join(answered, ["hotel_id", "phase", "seq"], "left_semi")
    base = seen.filter("phase = 'base'")
    wider = cut(probing.needs_wider(asked, base, probing.outcomes(known.filter("phase = 'base'"))), "wider")
    use = lambda df: df.filter("phase = 'base'").unionByName(df.filter("phase = 'wider'").join(wider, "hotel_id", "left_semi"))
    used, found = use(known), use(seen)
    values = [c for c in rooms.columns if c not in ("hotel_id", "room_name")]
    united = unions.first_wins(found, ["hotel_id", "room_name"], ["phase", "seq"], values)
    states = asked.join(probing.outcomes(used), "hotel_id", "left").join(united.groupBy("hotel_id").agg(F.count("*").alias("n_rooms")), "hotel_id", "left")
    states = states.select("hotel_id", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("resolved", "unavailable", "errored")], F.coalesce("n_rooms", F.lit(0)).alias("n_rooms"))
    shape = F.struct("phase", "seq")
    metrics = probing.metrics(used.withColumn("shape", shape), found.withColumn("shape", shape))
    return united, states, metrics.select("shape.phase", "shape.seq", *[c for c in metrics.columns if c != "shape"])


# --- checkpoints: a folder for each scope, overwritten as a whole


def save_checkpoint(state: DataFrame, path: str, scope: str) -> None:
    """Put ``state`` in the place of what the scope had; other scopes are not touched."""
    cut(state, "state").write.mode("overwrite").parquet(f"{path}/scope={scope}")


def load_checkpoint(spark: SparkSession, path: str, scope: str, schema: str) -> DataFrame:
    """What the scope saved last; empty if it saved nothing, or if that is damaged or of another form."""
    empty = spark.createDataFrame([], schema)
    try:
        held = spark.read.parquet(f"{path}/scope={scope}")
        if dict(held.dtypes) != dict(empty.dtypes):
            return empty
        return cut(held.select(empty.columns), "held")  # read at once, so that damage shows here
    except Exception as error:  # noqa: BLE001  what cannot be read is no checkpoint
        if "PATH_NOT_FOUND" in str(error) or "FAILED_READ_FILE" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error) or "CANNOT_READ_FILE" in str(error):
            return empty
        raise


def remaining_shapes(shapes: DataFrame, done: DataFrame) -> DataFrame:
    """Shapes (tag) that a checkpoint does not hold yet."""
    return shapes.join(done.select("tag").distinct(), "tag", "left_anti")


def sweep_scope(spark: SparkSession, path: str, scope: str) -> None:
    """Remove a scope's own folder once its run is complete; other scopes are not touched."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/scope={scope}")
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# --- sources


def by_priority(sources: DataFrame) -> DataFrame:
    """(hotel_id, rooms, source) of rows (hotel_id, source, rooms, complete), source being cache, http, browser or escalation.

    A complete cache that holds rooms settles it. Else http rooms come first, cached ones among them, then the
    browser's; the ladder's take their place only if there are more of them.
    """
    none = F.array().cast(sources.schema["rooms"].dataType)
    of = lambda name: F.coalesce(F.max_by(F.when(F.col("source") == name, F.col("rooms")), F.when(F.col("source") == name, F.size("rooms"))), none).alias(name)
    flags = F.coalesce(F.bool_or((F.col("source") == "cache") & F.coalesce("complete", F.lit(False))), F.lit(False)).alias("settled")
    one = sources.groupBy("hotel_id").agg(*[of(s) for s in ("cache", "http", "browser", "escalation")], flags)
    has = lambda c: F.size(c) > 0
    first = F.when(has("cache"), F.struct(F.col("cache").alias("rooms"), F.lit("http").alias("source"))).when(has("http"), F.struct(F.col("http").alias("rooms"), F.lit("http").alias("source"))).when(has("browser"), F.struct(F.col("browser").alias("rooms"), F.lit("browser").alias("source"))).otherwise(F.struct(none.alias("rooms"), F.lit("http").alias("source")))
    picked = one.withColumn("x", first)
    final = F.when(has("cache") & F.col("settled"), F.struct(F.col("cache").alias("rooms"), F.lit("cache").alias("source"))).when(F.size("escalation") > F.size("x.rooms"), F.struct(F.col("escalation").alias("rooms"), F.lit("escalation").alias("source"))).otherwise(F.col("x"))
    return picked.select("hotel_id", final.alias("r")).select("hotel_id", "r.rooms", "r.source")


def append_cache(rows: DataFrame, path: str, source: str, probe: str, now: Column) -> None:
    """Append property records (property_id, rooms, complete) with where they come from and when."""
    rows.withColumns({"source": F.lit(source), "probe": F.lit(probe), "rooms_at": now.cast("timestamp")}).write.mode("append").parquet(path)


def cached(spark: SparkSession, path: str, schema: str, today: Column, days: int = V.FRESH_DAYS) -> DataFrame:
    """The latest record of each property; its rooms only if they are fresh."""
    rows = spark.read.schema(schema).parquet(path)
    return probing.fresh_rooms(unions.last_per_key(rows, ["property_id"], ["rooms_at", "source"]), today, days)


# --- a third source for what is still without images


def _covered(gaps: DataFrame, shown: DataFrame, names: DataFrame | None) -> DataFrame:
    """(hotel_id, a_id, at) of gaps with a counterpart among the rooms ``shown``, and the first shape that has one."""
    x, y = mapping.sides_numbered(gaps.select("hotel_id", "a_id", "room_name"), shown.select("hotel_id", "b_id", "room_name"), names)
    good = mapping.candidates(x, y.join(shown.select("hotel_id", "b_id", "first"), ["hotel_id", "b_id"])).filter("publishable")
    return good.groupBy("hotel_id", "a_id").agg(F.min("first").alias("at"))


def shapes_needed(gaps: DataFrame, offers: DataFrame, base_shapes: int, flat: int = V.FLAT_STOP, names: DataFrame | None = None) -> DataFrame:
    """(hotel_id, shape) that are probed: the base shapes, then one at a time until every gap has a counterpart or ``flat`` shapes in a row add no photographed room.

    ``gaps``: hotel_id, a_id, room_name; ``offers``: hotel_id, shape, b_id, room_name, images. A gap has a counterpart
    once a photographed room that its name may publish with was shown.
    """
    shown = offers.filter(F.size("images") > 0).groupBy("hotel_id", "b_id").agg(F.min("shape").alias("first"), F.min_by("room_name", "shape").alias("room_name"))
    shown, gaps = cut(shown, "shown"), cut(gaps, "gaps")
    names = mapping.names_of(gaps, shown) if names is None else names
    # what the base shapes cover needs no look at the others
    early = cut(_covered(gaps, shown.filter(F.col("first") < base_shapes), names), "covered")
    late = cut(_covered(gaps.join(early, ["hotel_id", "a_id"], "left_anti"), shown.filter(F.col("first") >= base_shapes), names), "covered")
    covered = early.unionByName(late)
    per_hotel = gaps.join(covered, ["hotel_id", "a_id"], "left").groupBy("hotel_id").agg(F.when(F.count_if(F.col("at").isNull()) == 0, F.max("at")).alias("all_at"))
    gains = shown.groupBy("hotel_id", F.col("first").alias("shape")).agg(F.count("*").alias("gained"))
    asked = offers.select("hotel_id", "shape").distinct().join(gaps.select("hotel_id").distinct(), "hotel_id", "left_semi")
    more = asked.filter(F.col("shape") >= base_shapes).join(gains, ["hotel_id", "shape"], "left").select("hotel_id", "shape", F.coalesce("gained", F.lit(0)).alias("gained"))
    w = Window.partitionBy("hotel_id").orderBy("shape").rowsBetween(Window.unboundedPreceding, 0)
    isles = more.withColumn("isle", F.sum(F.when(F.col("gained") > 0, 1).otherwise(0)).over(w))
    streak = F.sum(F.when(F.col("gained") > 0, 0).otherwise(1)).over(Window.partitionBy("hotel_id", "isle").orderBy("shape").rowsBetween(Window.unboundedPreceding, 0))
    stops = isles.withColumn("flat", streak).filter(F.col("flat") >= flat).groupBy("hotel_id").agg(F.min("shape").alias("flat_at"))
    last = per_hotel.join(stops, "hotel_id", "left").select("hotel_id", F.least("all_at", "flat_at").alias("last"))
    return asked.join(last, "hotel_id", "left").filter((F.col("shape") < base_shapes) | F.col("last").isNull() | (F.col("shape") <= F.col("last"))).select("hotel_id", "shape")


def fill_gaps(gaps: DataFrame, verified: DataFrame, offers: DataFrame, hotels: DataFrame, base_shapes: int) -> tuple[DataFrame, DataFrame]:
    """(gaps with images and whether they are filled, one row per hotel with n_filled and a note).

    Offers of hotels that are not among ``verified`` (hotel_id, slug) do not count. No room is added and no size
    changed. The note tells the four kinds of zero apart.
    """
    gaps, trusted = cut(gaps, "gaps"), cut(offers.join(verified.select("hotel_id"), "hotel_id", "left_semi"), "trusted")
    names = mapping.names_of(gaps, trusted)
    used = trusted.join(shapes_needed(gaps, trusted, base_shapes, names=names), ["hotel_id", "shape"], "left_semi")
    rooms = cut(unions.merge_images(used, ["hotel_id", "b_id"], "shape", "images", "room_name").filter(F.size("images") > 0), "offered")
    got = mapping.published(gaps.select("hotel_id", "a_id", "room_name"), rooms.select("hotel_id", "b_id", "room_name"), names=names).join(rooms.select("hotel_id", "b_id", F.col("images").alias("found")), ["hotel_id", "b_id"]).drop("b_id")
    filled = cut(gaps.join(got, ["hotel_id", "a_id"], "left").withColumn("filled", F.col("found").isNotNull()).withColumn("images", F.coalesce("found", F.array().cast("array<string>"))).drop("found"), "filled")
    per_hotel = filled.groupBy("hotel_id").agg(F.count("*").alias("n_gaps"), F.count_if("filled").alias("n_filled"))
    seen = rooms.groupBy("hotel_id").agg(F.count("*").alias("n_rooms"))
    rows = hotels.select("hotel_id").distinct().join(per_hotel, "hotel_id", "left").join(verified.select("hotel_id", "slug"), "hotel_id", "left").join(seen, "hotel_id", "left")
    note = (
        F.when(F.col("n_gaps").isNull(), "no gaps")
        .when(F.col("slug").isNull(), "no geo-verified candidate")
        .when(F.col("n_rooms").isNull(), F.concat("slug", F.lit(": no photographed rooms")))
        .when(F.col("n_filled") == 0, F.concat("slug", F.lit(": "), F.col("n_rooms").cast("string"), F.lit(" rooms, none matched the "), F.col("n_gaps").cast("string"), F.lit(" gap(s)")))
        .otherwise(F.col("slug"))
    )
    return filled, rows.select("hotel_id", F.coalesce("n_filled", F.lit(0)).alias("n_filled"), note.alias("note"))


def settled(attempts: DataFrame) -> DataFrame:
    """Per hotel of (hotel_id, attempt, outcome): its state. Who could not be reached is asked once more; only the second time counts."""
    two = attempts.filter("attempt <= 2")
    last = unions.last_per_key(two.select("hotel_id", "attempt", "outcome"), ["hotel_id"], ["attempt"])
    return last.withColumn("state", F.when((F.col("outcome") == "unreachable") & (F.col("attempt") < 2), "requeued").otherwise(F.col("outcome")))


def crossed_environment(sampled: DataFrame) -> bool:
    """Whether all sampled hotels (outcome; five of them) are stated to be unavailable: the sign of ids from another environment."""
    row = sampled.limit(5).agg(F.count("*").alias("n"), F.count_if(F.col("outcome") == "unavailable").alias("gone")).first()
    return row["n"] > 0 and row["n"] == row["gone"]
