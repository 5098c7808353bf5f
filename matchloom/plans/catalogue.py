"""The registered queries of the entity-resolution operators, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import vocabulary as V
from ..operators import harvest, ledger, mapping, probing, publishing, reports, resolution, rooms, scans, unions
from ..operators.store import Store, publishing_together
from ..session import fresh_path, shared_dir
from ..sources import extract, objects
from ..sources.logs import LedgerFiles
from ..streaming.ledger import ledger_state, run_ledger
from . import oracles as O
from .fixtures import cte, view

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
TODAY = "2024-01-31"


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        _QUERIES[fn.__name__] = fn
        if sql:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


# --- scans


@query(cte("hotel") + "SELECT id, slug, city_id FROM hotel WHERE city_id IN (1, 3, 5)")
def scan_by_city(spark, d):
    return scans.by_city(view(spark, d, "hotel"), [1, 3, 5]).select("id", "slug", "city_id")


@query(cte("hotel") + "SELECT slug, id FROM hotel WHERE id % 9 = 0")
def scan_by_slug(spark, d):
    h = view(spark, d, "hotel")
    slugs = h.filter("id % 9 = 0").select(F.concat(F.lit(" "), "slug").alias("slug")).union(spark.createDataFrame([("",), ("  ",), ("no-such",)], "slug string"))
    return scans.by_slug(h, slugs).select("slug", "id")


@query("SELECT s_suppkey AS id FROM supplier")
def scan_ids(spark, d):
    return scans.ids(view(spark, d, "hotel"))


@query(cte("hotel") + "SELECT id FROM (SELECT id FROM hotel ORDER BY id LIMIT 40) WHERE id % 3 > 0")
def fixed_window_minus_skip(spark, d):
    h = view(spark, d, "hotel")
    return scans.window_minus_skip(h.select("id"), h.filter("id % 3 = 0"), 40)


@query(cte("city", "country", "hotel") + "SELECT c.id, name_en, country, count(h.id) AS n_hotels FROM city c LEFT JOIN country USING (country_id) LEFT JOIN hotel h ON h.city_id = c.id WHERE deleted_at IS NULL AND lower(name_en) LIKE '%nation_1%' GROUP BY ALL")
def resolve_city_counts(spark, d):
    return scans.resolve_city(view(spark, d, "city"), view(spark, d, "country"), view(spark, d, "hotel"), "Nation_1")


_FLAGS = "hotel_id, lower(substr(trim(name), 1, 191)) AS room_key, trim(coalesce(thumbnail, '')) <> '' AS has_image, coalesce(size_sqft, 0) > 0 AS has_size, category_id IS NOT NULL AS has_category"


@query(cte("room") + f"SELECT {_FLAGS} FROM room")
def existing_rooms_flags(spark, d):
    return scans.existing_flags(view(spark, d, "room"))


@query(cte("room", "hotel") + f"SELECT {_FLAGS} FROM room WHERE hotel_id IN (SELECT id FROM hotel WHERE city_id = 7)")
def existing_rooms_bulk(spark, d):
    return scans.existing_flags(view(spark, d, "room"), view(spark, d, "hotel"), 7)


@query("SELECT o_orderkey AS suggestion, o_custkey AS object_id, p_name AS label FROM orders LEFT JOIN part ON o_custkey = p_partkey WHERE o_orderkey % 10 = 7")
def suggest_join(spark, d):
    s = _table(spark, d, "orders").selectExpr("o_orderkey AS suggestion", "o_custkey AS object_id", "o_orderkey % 10 AS kind")
    return scans.suggest_join(s, _table(spark, d, "part").selectExpr("p_partkey AS object_id", "p_name AS label")).select("suggestion", "object_id", "label")


@query("SELECT s_suppkey AS id FROM supplier WHERE s_suppkey % 4 = 0")
def missing_keys(spark, d):
    h = view(spark, d, "hotel")
    return scans.missing_keys(h, h.filter("id % 4 <> 0"), "id")


# --- names


@query("SELECT c_custkey AS id, trim(regexp_replace(replace(lower(c_name || ' & ' || c_mktsegment), '&', ' and '), '[^a-z0-9]+', ' ', 'g')) AS norm FROM customer")
def name_normalise(spark, d):
    return _table(spark, d, "customer").select(F.col("c_custkey").alias("id"), N.norm(F.concat("c_name", F.lit(" & "), "c_mktsegment")).alias("norm"))


@query(cte("room_b")[:-1] + ", " + O.room_norms("room_b", "nr") + " SELECT b_id, norm FROM room_b JOIN nr USING (room_name)")
def room_normalise(spark, d):
    return view(spark, d, "room_b").select("b_id", N.norm_room(F.col("room_name")).alias("norm"))


_STATED = ["lounge access", "wheelchair accessible", "access", "club lounge access", "mobility access", "accessible"]


@query(f"WITH t AS (SELECT p_partkey, {_list(_STATED)}[p_partkey % {len(_STATED)} + 1] AS stated, lower(p_type) || ' room ' || stated AS x FROM part), w AS (SELECT *, string_split(regexp_replace(x, '{V.DISABILITY_PHRASE}', 'disabled', 'g'), ' ') AS ts FROM t) SELECT p_partkey, stated, array_to_string({O.resolved_access('ts')}, ' ') AS resolved FROM w")
def access_sense(spark, d):
    p = _table(spark, d, "part")
    end = F.get(N.words(_STATED), (F.col("p_partkey") % len(_STATED)).cast("int"))
    return p.select("p_partkey", end.alias("stated"), N.resolve_access(F.concat_ws(" ", F.lower("p_type"), F.lit("room"), end)).alias("resolved"))


_PAIRED = "WITH n AS (SELECT DISTINCT p_name, lower(p_type) AS p_type, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS nth FROM part QUALIFY nth = 1), q AS (SELECT x.p_name AS a, y.p_name || CASE WHEN length(x.p_name) % 2 = 0 THEN ' ' || y.p_type ELSE '' END AS b FROM n x JOIN n y ON substr(x.p_name, 1, 1) = substr(y.p_name, 1, 1)), " + O.similarities("q", "a", "b", "sim")


def _name_pairs(spark, d):
    p = _table(spark, d, "part").groupBy("p_name").agg(F.lower(F.min_by("p_type", "p_partkey")).alias("p_type"))
    x, y = p.alias("x"), p.alias("y")
    tail = F.when(F.length("x.p_name") % 2 == 0, F.concat(F.lit(" "), "y.p_type")).otherwise("")
    return x.join(y, F.substring("x.p_name", 1, 1) == F.substring("y.p_name", 1, 1)).select(F.col("x.p_name").alias("a"), F.concat("y.p_name", tail).alias("b"))


@query(_PAIRED + " SELECT a, b, round_even(plain, 1) AS ratio FROM sim")
def ratio_pairs(spark, d):
    return _name_pairs(spark, d).withColumn("ratio", F.bround(N.plain_ratio("a", "b"), 1))


@query(_PAIRED + " SELECT a, b, round_even(strict, 1) AS strict FROM sim")
def strict_score(spark, d):
    return _name_pairs(spark, d).withColumn("strict", F.bround(N.strict_score("a", "b"), 1))


@query(_PAIRED + " SELECT a, b, round_even(both_ways, 1) AS set_score FROM sim")
def set_score(spark, d):
    return _name_pairs(spark, d).withColumn("set_score", F.bround(N.set_score("a", "b"), 1))


_P = cte("room_a", "room_b")[:-1] + ", " + O.pairs()
_M = cte("room_a", "room_b")[:-1] + ", " + O.mapping()


@query(_P + " SELECT a_id, b_id, round_even(raw, 1) AS room_score FROM p")
def room_score(spark, d):
    p = mapping.pairs(view(spark, d, "room_a"), view(spark, d, "room_b"))
    return p.select("a_id", "b_id", F.bround("raw", 1).alias("room_score"))


@query("SELECT c_custkey AS id, list_aggregate(list_sort(list_distinct(regexp_extract_all(n, '[0-9]+') || list_filter(string_split(n, ' '), lambda t: list_contains(['north', 'south', 'east', 'west'], t)))), 'string_agg', ',') AS marks FROM (SELECT c_custkey, lower(replace(c_name, '#', ' ')) || CASE c_custkey % 3 WHEN 0 THEN ' north' WHEN 1 THEN ' east 12' ELSE '' END AS n FROM customer)")
def unit_marks(spark, d):
    tail = F.when(F.col("c_custkey") % 3 == 0, " north").when(F.col("c_custkey") % 3 == 1, " east 12").otherwise("")
    c = _table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.concat(N.norm("c_name"), tail).alias("n"))
    return c.select("id", F.array_join(N.unit_marks(F.col("n")), ",").alias("marks"))


_K = cte("hotel", "candidate")[:-1] + ", "


@query(_K + O.candidates() + ", " + O.same_listings("'abu dhabi'") + " SELECT hotel_id, cand_id, listed AS same FROM l")
def same_listing(spark, d):
    c = resolution.scored(view(spark, d, "hotel"), view(spark, d, "candidate"))
    return c.select("hotel_id", "cand_id", N.same_listing(F.col("n1"), F.col("n2"), drop=F.lit("abu dhabi")).alias("same"))


def _parsed_b(spark, d):
    return mapping.parsed(view(spark, d, "room_b"))


@query(f"WITH t AS (SELECT p_partkey, string_split(lower(p_type) || ' ' || p_name || CASE p_partkey % 3 WHEN 0 THEN ' 2 sea' WHEN 1 THEN ' king' ELSE '' END || ' view room', ' ') AS ts FROM part) SELECT p_partkey, {O.view('ts')} AS view FROM t")
def view_of(spark, d):
    return _table(spark, d, "part").select("p_partkey", N.view_of(F.concat(F.lower("p_type"), F.lit(" "), "p_name", F.when(F.col("p_partkey") % 3 == 0, " 2 sea").when(F.col("p_partkey") % 3 == 1, " king").otherwise(""), F.lit(" view room"))).alias("view"))


@query(f"SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 + p_partkey % 9 WHEN 2 THEN 2 END::INT AS bedrooms FROM part")
def bedrooms(spark, d):
    k = F.col("p_partkey") % 4
    stated = F.when(k == 0, F.lit("studio")).when(k == 1, F.concat((1 + F.col("p_partkey") % 9).cast("string"), F.lit(" bhk flat"))).when(k == 2, F.lit("two bedrooms")).otherwise(F.lit("room"))
    return _table(spark, d, "part").select("p_partkey", N.bedrooms(F.concat_ws(" ", "p_name", stated)).cast("int").alias("bedrooms"))


@query(cte("room_b")[:-1] + ", " + O.room_norms("room_b", "nr") + ", " + O.features("nr", "fs") + " SELECT b_id, array_to_string(classes, ',') AS classes, view, array_to_string(beds, ',') AS beds, bedrooms, array_to_string(tiers, ',') AS tiers, accessible FROM room_b JOIN nr USING (room_name) JOIN fs USING (norm)")
def room_features(spark, d):
    f = F.col("f")
    return _parsed_b(spark, d).select("b_id", F.array_join(f["classes"], ",").alias("classes"), f["view"].alias("view"), F.array_join(f["beds"], ",").alias("beds"), f["bedrooms"].alias("bedrooms"), F.array_join(f["tiers"], ",").alias("tiers"), f["accessible"].alias("accessible"))


def _category_sql(n: str) -> str:
    out = [f"WHEN {n} = '' THEN 'General'"]
    words = " ".join(f"WHEN '{w}' THEN {k}" for w, k in V.NUMBERS.items())
    number = f"regexp_extract({n}, '([0-9]+|{'|'.join(V.NUMBERS)})\\s*(?:bed\\s?rooms?|br|bhk)\\b', 1)"
    for label, pattern in V.CATEGORY_RULES:
        if label == "Apartment":
            count = f"CASE {number} {words} ELSE try_cast({number} AS INT) END"
            out += [f"WHEN ({count}) = {k} THEN '{c}'" for k, c in enumerate(V.BEDROOM_CATEGORIES[:3], 1)] + [f"WHEN ({count}) > 3 THEN '{V.BEDROOM_CATEGORIES[3]}'"]
        out.append(f"WHEN regexp_matches({n}, '{pattern}') THEN '{label}'")
    return f"CASE {' '.join(out)} ELSE 'General' END"


@query(cte("room_b")[:-1] + ", " + O.room_norms("room_b", "nr") + f" SELECT b_id, {_category_sql('norm')} AS category FROM room_b JOIN nr USING (room_name)")
def room_category(spark, d):
    return _parsed_b(spark, d).select("b_id", N.category(F.col("norm")).alias("category"))


def _pairs(spark, d):
    return mapping.pairs(view(spark, d, "room_a"), view(spark, d, "room_b"))


@query(_P + " SELECT a_id, b_id, score, veto FROM p")
def room_match_veto(spark, d):
    return _pairs(spark, d).select("a_id", "b_id", "score", "veto")


@query(_P + " SELECT a_id, b_id, array_to_string(cor, ',') AS corroborated FROM p")
def corroboration(spark, d):
    return _pairs(spark, d).select("a_id", "b_id", F.array_join("cor", ",").alias("corroborated"))


@query(_P + " SELECT a_id, b_id, soft FROM p")
def soft_veto(spark, d):
    return _pairs(spark, d).select("a_id", "b_id", N.is_soft(F.col("veto")).alias("soft"))


# --- mapping


def _mapped(spark, d):
    return mapping.map_rooms(view(spark, d, "room_a"), view(spark, d, "room_b"))


@query(_M + " SELECT * FROM m")
def room_mapping(spark, d):
    return _mapped(spark, d)


@query(_M + " SELECT * FROM m WHERE status = 'review'")
def mapping_review(spark, d):
    return _mapped(spark, d).filter("status = 'review'")


@query(_M + " SELECT * FROM m WHERE status = 'unmatched'")
def mapping_unmatched(spark, d):
    return _mapped(spark, d).filter("status = 'unmatched'")


@query(_M + " SELECT hotel_id, b_id, room_name FROM m WHERE status = 'leftover'")
def mapping_leftover(spark, d):
    return _mapped(spark, d).filter("status = 'leftover'").select("hotel_id", "b_id", "room_name")


@query(cte("hotel", "candidate") + f"SELECT hotel_id, cand_id, round({O.KM}, 6) AS km FROM hotel JOIN candidate ON hotel.id = hotel_id")
def haversine_km(spark, d):
    both = view(spark, d, "hotel").withColumnRenamed("id", "hotel_id").join(view(spark, d, "candidate"), "hotel_id")
    return both.select("hotel_id", "cand_id", F.round(resolution.km(F.col("lat"), F.col("lon"), F.col("cand_lat"), F.col("cand_lon")), 6).alias("km"))


_BAND = "CASE WHEN km <= 0.35 AND s >= 72 THEN 'high' WHEN same AND s2 >= 88 THEN 'medium' WHEN km <= 1.5 AND s >= 90 THEN 'medium' WHEN km IS NULL AND s >= 90 THEN 'medium' END"


@query("SELECT l_orderkey, l_linenumber, " + _BAND + " AS band FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 > 0 THEN l_partkey % 200 / 100.0 END AS km, 50 + l_suppkey % 51 AS s, 50 + l_partkey % 51 AS s2, l_orderkey % 2 = 0 AS same FROM lineitem)")
def confidence_band(spark, d):
    c = _table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "CASE WHEN l_partkey % 5 > 0 THEN l_partkey % 200 / 100.0 END AS km", "50 + l_suppkey % 51 AS s", "50 + l_partkey % 51 AS s2", "l_orderkey % 2 = 0 AS same")
    return c.select("l_orderkey", "l_linenumber", resolution.confidence(F.col("s"), F.col("s2"), F.col("km"), F.col("same")).alias("band"))


@query(_K + O.matches() + " SELECT * FROM r WHERE reason IS NULL")
def hotel_match(spark, d):
    return resolution.match_hotels(view(spark, d, "hotel"), view(spark, d, "candidate")).filter("reason IS NULL")


@query(_K + O.matches() + " SELECT hotel_id, reason FROM r WHERE reason IS NOT NULL")
def hotel_match_near_miss(spark, d):
    return resolution.match_hotels(view(spark, d, "hotel"), view(spark, d, "candidate")).filter("reason IS NOT NULL").select("hotel_id", "reason")


# a third of the hotels has candidates whose pages mostly failed; searches failed for every second one of these
_FETCH = "CASE WHEN hotel_id % 3 = 1 AND cand_id % 8 < 7 OR cand_id % 9 = 4 THEN 'error' WHEN cand_id % 9 = 5 THEN 'empty' ELSE 'ok' END"
_FAILED = "SELECT s_suppkey AS hotel_id, CAST(s_suppkey % 4 AS INT) AS seq, 'timeout ' || CAST(s_suppkey % 4 AS STRING) AS error FROM supplier WHERE s_suppkey % 2 = 1"


@query(_K.replace("candidate AS (", f"candidate AS (SELECT *, {_FETCH} AS got FROM (").rstrip(", ") + "), failure AS (" + _FAILED + "), " + O.resolutions() + " SELECT * FROM o")
def hotel_fetch_outcomes(spark, d):
    """Hotels resolved where searches and fetches fail: what nobody could tell is not a refusal."""
    failures = spark.sql(_FAILED.replace("FROM supplier", "FROM {supplier}"), supplier=_table(spark, d, "supplier"))
    found = resolution.resolve_hotels(view(spark, d, "hotel"), view(spark, d, "candidate").withColumn("fetch", F.expr(_FETCH)), failures)
    return found.select("hotel_id", "cand_id", "confidence", "reason", "unreachable")


_LISTING = "SELECT c_custkey AS cand_id, CASE WHEN c_custkey % 3 = 0 THEN 'Supplier#' || lpad(CAST(1 + c_custkey % 97 AS STRING), 9, '0') ELSE c_name END AS cand_name, c_nationkey AS cand_city, CASE WHEN c_custkey % 8 > 0 THEN CAST(25.0 + (c_custkey % 97) * 0.001 + (c_custkey % 13) * 0.0007 AS DOUBLE) END AS cand_lat, CAST(55.0 + (c_custkey % 89) * 0.001 + (c_custkey % 7) * 0.0005 AS DOUBLE) AS cand_lon FROM {customer}"
_NEAR = cte("hotel")[:-1] + ", listing AS (" + _LISTING.replace("{customer}", "customer") + "), met AS (SELECT h.id AS hotel_id, l.*, " + O.KM.replace("c.", "l.") + " AS distance FROM hotel h JOIN listing l ON l.cand_lat BETWEEN h.lat - 0.02 AND h.lat + 0.02)"


def _listings(spark, d):
    return spark.sql(_LISTING, customer=_table(spark, d, "customer"))


@query(_NEAR + f" SELECT hotel_id, count(*) FILTER (distance <= {V.VERIFIED_KM}) AS at_hand, count(*) AS near, round(min(distance), 4) AS nearest_km FROM met WHERE distance <= {V.FAR_KM} GROUP BY hotel_id")
def nearby_listings(spark, d):
    """Listings near each hotel, counted by cells of a grid."""
    hotels = view(spark, d, "hotel").select(F.col("id").alias("hotel_id"), "lat", "lon")
    return resolution.counted_near(hotels, _listings(spark, d), V.VERIFIED_KM, V.FAR_KM).select("hotel_id", "at_hand", "near", F.round("nearest", 4).alias("nearest_km"))


@query(_NEAR + ", candidate AS (SELECT hotel_id, cand_id, cand_name, cand_city, cand_lat, cand_lon FROM met WHERE distance <= 1.5), " + O.candidates() + ", t AS (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY strict DESC, score DESC, cand_id) AS nth FROM k), g AS (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY distance, nth) AS r FROM t WHERE nth <= 3 AND score >= 90 AND distance <= 0.25) SELECT hotel_id, cand_id, round_even(score, 1) AS score, round_even(distance, 4) AS distance FROM g WHERE r = 1")
def verified_nearby(spark, d):
    """The dual gate over candidates that coordinates give."""
    return resolution.verified_near(view(spark, d, "hotel"), _listings(spark, d))


@query(_K + O.candidates() + ", t AS (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY strict DESC, score DESC, cand_id) AS nth FROM k WHERE lat IS NOT NULL), g AS (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY distance, nth) AS r FROM t WHERE nth <= 3 AND score >= 90 AND distance <= 0.25) SELECT hotel_id, cand_id, round_even(score, 1) AS score, round_even(distance, 4) AS distance FROM g WHERE r = 1")
def verified_dual_gate(spark, d):
    return resolution.verified(view(spark, d, "hotel"), view(spark, d, "candidate"))


@query("SELECT hotel_id, CASE WHEN (n_considered > 0 AND n_failed >= n_considered) OR (n_errors > 0 AND (n_candidates = 0 OR n_viable = 0)) THEN 'unreachable' ELSE 'no_match' END AS outcome FROM (SELECT event_id // 6 AS hotel_id, count(*) FILTER (event_type = 'view') AS n_candidates, count(*) FILTER (event_type = 'error') AS n_errors, count(*) FILTER (event_type = 'click') AS n_considered, count(*) FILTER (event_type = 'click' AND value < 20) AS n_failed, count(*) FILTER (event_type = 'purchase') AS n_viable FROM events GROUP BY event_id // 6)")
def unreachable_or_no_match(spark, d):
    is_ = lambda t: F.col("event_type") == t
    a = _table(spark, d, "events").groupBy(F.floor(F.col("event_id") / 6).alias("hotel_id")).agg(F.count_if(is_("view")).alias("n_candidates"), F.count_if(is_("error")).alias("n_errors"), F.count_if(is_("click")).alias("n_considered"), F.count_if(is_("click") & (F.col("value") < 20)).alias("n_failed"), F.count_if(is_("purchase")).alias("n_viable"))
    return resolution.unreachable(a).select("hotel_id", "outcome")


#: Kinds of addresses: text after the street, country, city, and what is left of that text.
_PLACES = (
    (", 10115 Berlin, United Nation Land", "United Nation Land", "Berlin", " Berlin"),
    (", Panama City, Panama", "Panama", "Panama City", " Panama City"),
    (" Singapore 018956", "Singapore", "Singapore", " Singapore"),
    (", Dubai, U.A.E.", "United Arab Emirates", "Dubai", " Dubai"),
    (", Dubai, UAE", "United Arab Emirates", "Dubai", " Dubai"),
    (", armenia, Yerevan", "Armenia", "Yerevan", " Yerevan"),
    (", Kuwait, Kuwait City", "Kuwait", None, " Kuwait City"),
    ("", None, None, ""),
)
_STREET = "trim(regexp_replace(regexp_replace(c_name, '[^a-zA-Z0-9_\\s-]', ' ', 'g') || ' ' || c_mktsegment || ' street ' || (c_custkey % 90), '\\b[0-9]{4,}\\b', ' ', 'g'))"


@query(f"SELECT c_custkey AS id, substr(regexp_replace({_STREET} || CASE c_custkey % {len(_PLACES)} " + " ".join(f"WHEN {k} THEN '{p[3]}'" for k, p in enumerate(_PLACES)) + " END, '\\s+', ' ', 'g'), 1, 80) AS query FROM customer")
def address_query(spark, d):
    at = (F.col("c_custkey") % len(_PLACES)).cast("int")
    one = lambda k: F.get(F.array(*[F.lit(p[k]).cast("string") for p in _PLACES]), at)
    address = F.concat("c_name", F.lit(", "), "c_mktsegment", F.lit(" street "), (F.col("c_custkey") % 90).cast("string"), one(0))
    return _table(spark, d, "customer").select(F.col("c_custkey").alias("id"), resolution.address_query(address, one(1), one(2)).alias("query"))


_BARE = "trim(regexp_replace(name, '\\s*\\([^)]*\\)', '', 'g'))"


@query(cte("hotel")[:-1] + f", v AS (SELECT id, unnest([{_BARE}, CASE WHEN {_BARE} <> name THEN name END, CASE WHEN city_name IS NOT NULL AND NOT contains(lower({_BARE}), lower(city_name)) THEN {_BARE} || ' ' || city_name END, CASE WHEN id % 2 = 0 THEN 'Marina Road ' || id END]) AS query, unnest([0, 1, 2, 3]) AS k FROM hotel) SELECT id AS hotel_id, (row_number() OVER (PARTITION BY id ORDER BY k) - 1)::INT AS variant, query FROM v WHERE query IS NOT NULL")
def query_variants(spark, d):
    h = view(spark, d, "hotel").withColumn("address", F.when(F.col("id") % 2 == 0, F.concat(F.lit("Marina Road, "), F.col("id").cast("string"), F.lit(", Oman")))).withColumn("country", F.lit("Oman"))
    return resolution.query_variants(h.withColumnRenamed("city_name", "destination"))


_SUGGESTED = "WITH s AS (SELECT o_custkey AS query, o_orderkey AS seq, CASE WHEN o_orderkey % 5 < 2 THEN 1 ELSE 2 END AS kind, o_orderkey % 40 AS object_id FROM orders), m AS (SELECT o_custkey AS query, o_orderkey AS seq, o_orderkey % 40 AS object_id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 END AS city_id, CASE o_orderkey % 40 % 4 WHEN 0 THEN 'AE' WHEN 1 THEN 'om' WHEN 2 THEN '' END AS iso FROM orders), "


@query(_SUGGESTED + "i AS (SELECT query, object_id, arg_min(nullif(lower(iso), ''), seq) FILTER (nullif(iso, '') IS NOT NULL) AS country FROM m GROUP BY ALL), a AS (SELECT * FROM (SELECT s.query, s.object_id AS city_id, i.country, row_number() OVER (PARTITION BY s.query ORDER BY coalesce(i.country = 'om', false) DESC, s.seq) AS r FROM s LEFT JOIN i ON i.query = s.query AND i.object_id = s.object_id WHERE kind = 1) WHERE r = 1), b AS (SELECT * FROM (SELECT query, city_id, nullif(lower(iso), '') AS country, row_number() OVER (PARTITION BY query ORDER BY seq) AS r FROM m WHERE city_id IS NOT NULL) WHERE r = 1) SELECT q.query, CASE WHEN a.query IS NOT NULL THEN a.city_id ELSE b.city_id END AS city_id, CASE WHEN a.query IS NOT NULL THEN a.country ELSE b.country END AS country FROM (SELECT DISTINCT query FROM s) q LEFT JOIN a USING (query) LEFT JOIN b USING (query)")
def resolve_destination(spark, d):
    o = _table(spark, d, "orders")
    s = o.selectExpr("o_custkey AS query", "o_orderkey AS seq", "CASE WHEN o_orderkey % 5 < 2 THEN 1 ELSE 2 END AS kind", "o_orderkey % 40 AS object_id")
    m = o.selectExpr("o_custkey AS query", "o_orderkey AS seq", "o_orderkey % 40 AS object_id", "CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 7 END AS city_id", "CASE o_orderkey % 40 % 4 WHEN 0 THEN 'AE' WHEN 1 THEN 'om' WHEN 2 THEN '' END AS iso")
    return resolution.destinations(s, m, F.lit("OM"))


# --- ladders and unions


@query("WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders) SELECT day, (day + ((5 - dayofweek(day) + 7) % 7 + 1)::INT + 7 * w::INT)::DATE AS check_in, w::INT AS weeks FROM d, (SELECT unnest([0, 1, 2]) AS w)")
def weekend_dates(spark, d):
    days = _table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("weeks")).select("day", probing.weekend_checkin(F.col("day"), F.col("weeks")).alias("check_in"), "weeks")


_LADDER = ", ".join(f"({i}, {w}, {a}, {n})" for i, (w, a, n) in enumerate(V.BASE_LADDER))


@query(f"WITH d AS (SELECT DISTINCT o_orderdate::DATE AS day FROM orders), l AS (SELECT CASE k WHEN 0 THEN 'weekend' ELSE 'midweek' END || '+' || w || 'w/' || a || 'ad/' || n || 'n' AS label, w * 7 + 3 * k AS later, n AS nights FROM (VALUES {_LADDER}) t(i, w, a, n), (VALUES (0), (1)) s(k)) SELECT day, label, day + ((12 - dayofweek(day)) % 7 + 1 + later)::INT AS check_in, day + ((12 - dayofweek(day)) % 7 + 1 + later + nights)::INT AS check_out FROM d, l")
def probe_stays(spark, d):
    """The stays that the ladder asks for on each day of the orders."""
    return probing.stays(probing.probe_shapes(spark), _table(spark, d, "orders").select(F.to_date("o_orderdate").alias("day")))


_OBS = cte("observation")


@query(_OBS + "SELECT hotel_id, room_no, seq AS first_seq, shape AS first_shape FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, room_no ORDER BY seq, shape) AS r FROM observation) WHERE r = 1")
def union_first_wins(spark, d):
    return unions.first_wins(view(spark, d, "observation"), ["hotel_id", "room_no"], ["seq", "shape"], ["seq", "shape"]).withColumnsRenamed({"seq": "first_seq", "shape": "first_shape"})


@query(_OBS + "SELECT hotel_id, room_no, richness, seq, shape FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, room_no ORDER BY richness DESC, seq, shape) AS r FROM observation) WHERE r = 1")
def union_richest_wins(spark, d):
    return unions.richest_wins(view(spark, d, "observation"), ["hotel_id", "room_no"], "richness", ["seq", "shape"], ["richness", "seq", "shape"])


@query(_OBS + ", f AS (SELECT hotel_id, room_no, flag, min(seq * 10 + shape) AS place FROM observation GROUP BY ALL) SELECT hotel_id, room_no, string_agg(flag, ',' ORDER BY place, flag) AS images FROM f GROUP BY ALL")
def union_images(spark, d):
    o = view(spark, d, "observation").select("hotel_id", "room_no", (F.col("seq") * 10 + F.col("shape")).alias("o"), F.array("flag").alias("images"), F.lit("x").alias("name"))
    flags = unions.merge_images(o, ["hotel_id", "room_no"], "o", "images", "name")
    return flags.select("hotel_id", "room_no", F.array_join("images", ",").alias("images"))


@query("SELECT hotel_id, room_name, max_occupancy FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id, room_name ORDER BY seq, pos) AS r FROM (SELECT l_suppkey AS hotel_id, l_orderkey * 10 + l_linenumber AS seq, 0 AS pos, CASE WHEN l_partkey % 3 = 0 THEN 'plan ' || l_shipmode_ ELSE 'room ' || (l_partkey % 20) END AS room_name, (1 + l_partkey % 4)::INT AS max_occupancy FROM (SELECT *, l_returnflag AS l_shipmode_ FROM lineitem))) WHERE r = 1")
def collapse_rate_plans(spark, d):
    li = _table(spark, d, "lineitem")
    name = F.when(F.col("l_partkey") % 3 == 0, F.lit("  ")).otherwise(F.concat(F.lit("room "), (F.col("l_partkey") % 20).cast("string")))
    options = li.select(F.col("l_suppkey").alias("hotel_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("option_seq"), F.concat(F.lit("plan "), "l_returnflag").alias("title"), F.array(F.struct(name.alias("name"), (1 + F.col("l_partkey") % 4).cast("int").alias("max_occupancy"))).alias("rooms"))
    return unions.collapse_rate_plans(options)


_PROBE = cte("probe")


@query(_PROBE + "SELECT hotel_id, bool_or(outcome = 'ok') AS resolved, bool_or(outcome = 'unavailable') AS unavailable, bool_or(outcome = 'error') AS errored, count(*) FILTER (outcome = 'ok') AS n_ok FROM probe GROUP BY hotel_id")
def probe_outcomes(spark, d):
    return probing.outcomes(view(spark, d, "probe").drop("outcome").withColumn("outcome", probing.outcome(F.col("event_type"), ["signup"], ["error"])))


@query(cte("probe", "observation") + ", g AS (SELECT shape, count(*) AS n FROM (SELECT hotel_id, room_no, min(shape) AS shape FROM observation GROUP BY ALL) GROUP BY shape) SELECT p.shape, count(DISTINCT hotel_id) AS hotels_probed, count(*) FILTER (outcome = 'ok') AS answered, count(*) FILTER (outcome = 'unavailable') AS unavailable, count(*) FILTER (outcome = 'error') AS errors, coalesce(any_value(g.n), 0) AS new_rooms FROM probe p LEFT JOIN g ON g.shape = p.shape GROUP BY p.shape")
def probe_metrics(spark, d):
    rooms = view(spark, d, "observation").select("hotel_id", F.col("room_no").alias("room_name"), "shape")
    return probing.metrics(view(spark, d, "probe"), rooms)


@query(cte("stage_probe") + "SELECT DISTINCT hotel_id FROM stage_probe WHERE hotel_id NOT IN (SELECT hotel_id FROM stage_probe WHERE phase = 'base' AND has_room) AND hotel_id NOT IN (SELECT hotel_id FROM stage_probe WHERE phase = 'base' AND outcome = 'unavailable')")
def zero_escalation(spark, d):
    p = view(spark, d, "stage_probe")
    base = p.filter("phase = 'base'")
    return probing.needs_wider(p.select("hotel_id").distinct(), base.filter("has_room"), probing.outcomes(base))


_HARVEST = cte("stage_probe")[:-1] + """, ranked AS (SELECT *, CASE phase WHEN 'base' THEN 0 ELSE 10 END + seq AS place FROM stage_probe),
gone AS (SELECT hotel_id, min(place) AS gone FROM ranked WHERE outcome = 'unavailable' GROUP BY hotel_id),
known AS (SELECT r.* FROM ranked r LEFT JOIN gone USING (hotel_id) WHERE gone IS NULL OR place <= gone),
held AS (SELECT DISTINCT hotel_id FROM known WHERE phase = 'base' AND has_room AND outcome = 'ok'),
wider AS (SELECT DISTINCT hotel_id FROM stage_probe WHERE hotel_id NOT IN (SELECT hotel_id FROM held) AND hotel_id NOT IN (SELECT hotel_id FROM gone WHERE gone < 10)),
used AS (SELECT * FROM known WHERE phase = 'base' OR hotel_id IN (SELECT hotel_id FROM wider)),
shown AS (SELECT * FROM used WHERE has_room AND outcome = 'ok'),
firsts AS (SELECT hotel_id, room_name, min(place) AS place FROM shown GROUP BY ALL)"""


def _harvested(spark, d):
    p = view(spark, d, "stage_probe").withColumn("seq", F.col("seq") + F.when(F.col("phase") == "wider", 10).otherwise(0))
    hotels = p.select("hotel_id", F.lit("slug").alias("slug")).distinct()
    return harvest.harvest(hotels, p.select("hotel_id", "phase", "seq", "outcome"), p.filter("has_room").select("hotel_id", "phase", "seq", "room_name"))


@query(_HARVEST + " SELECT hotel_id, room_name, CASE WHEN place < 10 THEN 'base' ELSE 'wider' END AS phase, place::INT AS seq FROM firsts")
def harvest_rooms(spark, d):
    return _harvested(spark, d)[0]


@query(_HARVEST + " SELECT u.hotel_id, bool_or(outcome = 'ok') AS resolved, bool_or(outcome = 'unavailable') AS unavailable, bool_or(outcome = 'error') AS errored, coalesce(any_value(n), 0) AS n_rooms FROM used u LEFT JOIN (SELECT hotel_id, count(*) AS n FROM firsts GROUP BY hotel_id) f USING (hotel_id) GROUP BY u.hotel_id")
def harvest_states(spark, d):
    return _harvested(spark, d)[1]


@query(_HARVEST + " SELECT phase, u.place::INT AS seq, count(DISTINCT hotel_id) AS hotels_probed, count(*) FILTER (outcome = 'ok') AS answered, count(*) FILTER (outcome = 'unavailable') AS unavailable, count(*) FILTER (outcome = 'error') AS errors, coalesce(any_value(n), 0) AS new_rooms FROM used u LEFT JOIN (SELECT place, count(*) AS n FROM firsts GROUP BY place) f ON f.place = u.place GROUP BY ALL")
def harvest_metrics(spark, d):
    return _harvested(spark, d)[2]


@query(_HARVEST + " SELECT DISTINCT phase, place::INT AS seq FROM used WHERE place % 2 = 1 EXCEPT SELECT phase, place::INT FROM used WHERE place < 3")
def harvest_resume(spark, d):
    """The shapes with odd numbers that a checkpoint of the first three does not hold."""
    m = _harvested(spark, d)[2].select("phase", "seq", F.concat_ws(":", "phase", "seq").alias("tag"))
    path = f"{shared_dir(spark)}/probes-{uuid.uuid4().hex}"
    harvest.save_checkpoint(m.filter("seq < 3").select("tag"), path, "s1")
    done = harvest.load_checkpoint(spark, path, "s1", "tag string")
    return harvest.remaining_shapes(m.filter("seq % 2 = 1"), done).select("phase", "seq")


_SOURCED = "WITH e AS (SELECT event_id // 4 AS hotel_id, CASE event_id % 4 WHEN 0 THEN 'cache' WHEN 1 THEN 'http' WHEN 2 THEN 'browser' ELSE 'escalation' END AS source, event_id % 7 * (event_id % 3 > 0)::INT AS n, event_id % 8 < 4 AS complete FROM events), w AS (SELECT hotel_id, max(n) FILTER (source = 'cache') AS c, max(n) FILTER (source = 'http') AS h, max(n) FILTER (source = 'browser') AS b, max(n) FILTER (source = 'escalation') AS e, coalesce(bool_or(source = 'cache' AND complete), false) AS done FROM e GROUP BY hotel_id), f AS (SELECT *, CASE WHEN c > 0 THEN c WHEN h > 0 THEN h WHEN b > 0 THEN b ELSE 0 END AS n0, CASE WHEN coalesce(c, 0) = 0 AND coalesce(h, 0) = 0 AND b > 0 THEN 'browser' ELSE 'http' END AS s0 FROM w)"


@query(_SOURCED + " SELECT hotel_id, (CASE WHEN c > 0 AND done THEN c WHEN coalesce(e, 0) > n0 THEN e ELSE n0 END)::INT AS n_rooms, CASE WHEN c > 0 AND done THEN 'cache' WHEN coalesce(e, 0) > n0 THEN 'escalation' ELSE s0 END AS source FROM f")
def source_priority(spark, d):
    e = _table(spark, d, "events").selectExpr("floor(event_id / 4) AS hotel_id", "CASE event_id % 4 WHEN 0 THEN 'cache' WHEN 1 THEN 'http' WHEN 2 THEN 'browser' ELSE 'escalation' END AS source", "CASE WHEN event_id % 3 > 0 AND event_id % 7 > 0 THEN sequence(1L, event_id % 7) ELSE array() END AS rooms", "event_id % 8 < 4 AS complete")
    return harvest.by_priority(e).select("hotel_id", F.size("rooms").alias("n_rooms"), "source")


@query(f"SELECT property_id, kind AS source, date_diff('day', ts::DATE, DATE '{TODAY}') <= 7 AS fresh, CASE WHEN date_diff('day', ts::DATE, DATE '{TODAY}') <= 7 THEN 1 ELSE 0 END AS n_rooms FROM (SELECT user_id AS property_id, CASE event_type WHEN 'view' THEN 'http' ELSE 'browser' END AS kind, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS r FROM events) WHERE r = 1")
def property_cache(spark, d):
    """Records of two sources appended to the cache, and the latest of each property with rooms that are fresh."""
    e = _table(spark, d, "events").select("event_type", F.col("user_id").alias("property_id"), F.array(F.lit("room")).alias("rooms"), F.lit(True).alias("complete"), "ts")
    path = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    harvest.append_cache(e.filter("event_type = 'view'").drop("event_type"), path, "http", "p1", F.col("ts"))
    harvest.append_cache(e.filter("event_type <> 'view'").drop("event_type"), path, "browser", "p1", F.col("ts"))
    found = harvest.cached(spark, path, "property_id long, rooms array<string>, complete boolean, source string, probe string, rooms_at timestamp", F.lit(TODAY).cast("date"))
    return found.select("property_id", "source", "fresh", F.size("rooms").alias("n_rooms"))


@query("SELECT hotel_id, attempt, outcome, CASE WHEN outcome = 'unreachable' AND attempt < 2 THEN 'requeued' ELSE outcome END AS state FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY attempt DESC) AS r FROM (SELECT event_id // 3 * 2 + (event_id % 3 = 2)::INT AS hotel_id, (event_id % 3 = 1)::BIGINT + 1 AS attempt, CASE event_type WHEN 'error' THEN 'unreachable' WHEN 'view' THEN 'no_match' ELSE 'matched' END AS outcome FROM events)) WHERE r = 1")
def requeue_once(spark, d):
    a = _table(spark, d, "events").selectExpr("floor(event_id / 3) * 2 + CAST(event_id % 3 = 2 AS INT) AS hotel_id", "CAST(event_id % 3 = 1 AS BIGINT) + 1 AS attempt", "CASE event_type WHEN 'error' THEN 'unreachable' WHEN 'view' THEN 'no_match' ELSE 'matched' END AS outcome")
    return harvest.settled(a)


@query(_PROBE + "SELECT event_id // 3 AS hotel_id, bool_and(outcome <> 'error') AS complete, sum(n_rooms)::BIGINT AS n_rooms, CASE WHEN sum(n_rooms) > 0 THEN 'rooms' WHEN bool_and(outcome <> 'error') THEN 'zero' ELSE 'unknown' END AS state FROM probe GROUP BY event_id // 3")
def ladder_complete(spark, d):
    return probing.ladder_complete(view(spark, d, "probe").withColumn("hotel_id", F.floor(F.col("event_id") / 3)))


@query(f"SELECT event_id, coalesce(date_diff('day', ts::DATE, DATE '{TODAY}') <= 7, false) AS fresh, CASE WHEN date_diff('day', ts::DATE, DATE '{TODAY}') <= 7 THEN event_type ELSE '' END AS rooms FROM (SELECT event_id, event_type, CASE WHEN event_id % 6 > 0 THEN ts END AS ts FROM events)")
def fresh_rooms_cache(spark, d):
    e = _table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 6 > 0, F.col("ts")).alias("rooms_at"), F.array("event_type").alias("rooms"))
    return probing.fresh_rooms(e, F.lit(TODAY).cast("date")).select("event_id", "fresh", F.array_join("rooms", ",").alias("rooms"))


@query(_PROBE + ", g AS (SELECT hotel_id, shape, sum(n_rooms)::BIGINT % 3 AS gained FROM probe GROUP BY ALL), c AS (SELECT *, sum(gained) OVER w AS covered, sum((gained > 0)::INT) OVER w AS hits FROM g WINDOW w AS (PARTITION BY hotel_id ORDER BY shape)), f AS (SELECT *, sum((gained = 0)::INT) OVER (PARTITION BY hotel_id, hits ORDER BY shape) AS flat FROM c), s AS (SELECT *, coalesce(max((covered >= 5 OR flat >= 2)::INT) OVER (PARTITION BY hotel_id ORDER BY shape ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped FROM f) SELECT hotel_id, shape, gained, covered::BIGINT AS covered, flat::BIGINT AS flat FROM s WHERE stopped = 0")
def plateau_stop(spark, d):
    g = view(spark, d, "probe").groupBy("hotel_id", "shape").agg((F.sum("n_rooms") % 3).alias("gained")).withColumn("n_gaps", F.lit(5))
    return probing.plateau_stop(g)


# --- ledgers

_LOG = cte("log") + ", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY row_id DESC) AS r FROM log) WHERE r = 1)"
# every row is in one of two ledgers: what was published, and what else became of a hotel
_TOLD = "reason IN ('view', 'click')"
_OTHER = cte("log") + f", latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY hotel_id ORDER BY row_id DESC) AS r FROM log WHERE NOT {_TOLD}) WHERE r = 1)"
_PUB = f", pub AS (SELECT hotel_id, max(happened) AS happened FROM log WHERE {_TOLD} GROUP BY hotel_id), fresh AS (SELECT hotel_id FROM pub WHERE happened::DATE >= DATE '" + TODAY + "' - 3)"


def _published(spark, d):
    return view(spark, d, "log").filter(_TOLD)


def _attempts(spark, d):
    return view(spark, d, "log").filter(f"NOT {_TOLD}")


def _fresh(spark, d):
    return ledger.fresh_ids(_published(spark, d), F.lit(TODAY).cast("date"), 3)


@query(_LOG + " SELECT hotel_id, reason, row_id FROM latest")
def ledger_latest(spark, d):
    return ledger.latest(view(spark, d, "log")).select("hotel_id", "reason", "row_id")


@query(_LOG + _PUB + " SELECT hotel_id FROM fresh")
def fresh_ids(spark, d):
    return _fresh(spark, d)


@query(_LOG + " SELECT hotel_id FROM latest WHERE reason <> 'resolved'")
def unresolved_ids(spark, d):
    return ledger.unresolved_ids(view(spark, d, "log"))


@query(_OTHER + _PUB + " SELECT hotel_id FROM fresh WHERE hotel_id NOT IN (SELECT hotel_id FROM latest WHERE reason <> 'resolved')")
def phase2_skip(spark, d):
    return ledger.skip_ids(_published(spark, d), _attempts(spark, d), F.lit(TODAY).cast("date"), 3)


@query(cte("log")[:-1] + ", h AS (SELECT count(*) // 2 AS n FROM log) SELECT hotel_id, reason, happened, row_id FROM log, h WHERE row_id < n UNION ALL SELECT hotel_id, reason, happened, n - 1 + row_number() OVER (ORDER BY happened DESC, row_id) AS row_id FROM log, h WHERE row_id >= n")
def ledger_append(spark, d):
    """The later half of the log added to its first half, in another order."""
    log = view(spark, d, "log")
    half = log.count() // 2
    new = log.filter(F.col("row_id") >= half).withColumns({"old": F.col("row_id"), "recent": -F.unix_micros(F.col("happened").cast("timestamp"))})
    return ledger.append_rows(log.filter(F.col("row_id") < half), new, ["recent", "old"])


_LEDGER = "row_id long, hotel_id long, reason string, happened timestamp"
_HALVES = cte("log")[:-1] + ", h AS (SELECT count(*) // 2 AS n FROM log)"


def _halves(spark, d):
    log = view(spark, d, "log").withColumn("happened", F.col("happened").cast("timestamp"))
    half = log.count() // 2
    return log, [log.filter(F.col("row_id") < half), log.filter(F.col("row_id") >= half)]


def _ledger_files(spark, d):
    """A ledger that two runs appended to, and a third left in a bad state: short, long and empty rows, keys that are no number, rows of an older form."""
    spark.dataSource.register(LedgerFiles)
    path = fresh_path(spark, "ledger")
    log, halves = _halves(spark, d)
    for half in halves:
        rows = half.select("row_id", "hotel_id", F.concat("reason", F.lit(', "so"')).alias("reason"), "happened")
        rows.repartitionByRange("row_id").sortWithinPartitions("row_id").write.format("ledger").mode("append").save(path)
    at, kind = F.col("happened").cast("string"), F.col("row_id") % 5
    older = F.concat_ws(",", "hotel_id", F.concat("reason", F.lit(" once")), at)
    line = F.when(kind == 0, F.concat_ws(",", "row_id", "hotel_id")).when(kind == 1, F.concat_ws(",", "row_id", F.lit("n/a"), "reason", at)).when(kind == 2, older).when(kind == 3, "").otherwise(F.concat_ws(",", "row_id", "hotel_id", "reason", at, F.lit("more")))
    log.repartitionByRange("row_id").sortWithinPartitions("row_id").select(line).write.text(f"{path}/run-{3:012d}")
    return spark.read.format("ledger").option("key", "hotel_id").schema(f"{_LEDGER}, _file string, _at long, _fault string").load(path)


@query(_HALVES + """, told AS (
  SELECT row_id, hotel_id, reason || ', "so"' AS reason, happened, CASE WHEN row_id < n THEN 1 ELSE 2 END AS run, row_id AS nth FROM log, h
  UNION ALL SELECT NULL, hotel_id, reason || ' once', happened, 3, row_id FROM log WHERE row_id % 5 = 2)
SELECT hotel_id, row_id, reason, happened FROM told QUALIFY row_number() OVER (PARTITION BY hotel_id ORDER BY run DESC, nth DESC) = 1""")
def ledger_files(spark, d):
    """The last row of each hotel, in the order in which rows were appended."""
    return unions.last_per_key(_ledger_files(spark, d).filter("_fault IS NULL"), ["hotel_id"], ["_file", "_at"]).select("hotel_id", "row_id", "reason", "happened")


@query(cte("log") + "SELECT fault, count(*) AS n FROM (SELECT CASE row_id % 5 WHEN 0 THEN 'short' WHEN 1 THEN 'key' WHEN 2 THEN 'none' WHEN 3 THEN 'empty' ELSE 'long' END AS fault FROM log UNION ALL SELECT 'none' FROM log) GROUP BY fault")
def ledger_faults(spark, d):
    return _ledger_files(spark, d).groupBy(F.coalesce("_fault", F.lit("none")).alias("fault")).agg(F.count("*").alias("n"))


@query(cte("log") + "SELECT hotel_id, row_id, reason, happened, epoch_ms(happened) + 3 * 86400000 <= (SELECT max(epoch_ms(happened)) - 3600000 FROM log) AS stale FROM log QUALIFY row_number() OVER (PARTITION BY hotel_id ORDER BY row_id DESC) = 1")
def ledger_stream(spark, d):
    """The ledger as a stream that stops after the first half of the log, and goes on later."""
    path = fresh_path(spark, "ledger-stream")
    for half in _halves(spark, d)[1]:
        half.write.mode("append").parquet(f"{path}/in")
        log = spark.readStream.schema(half.schema).parquet(f"{path}/in")
        run_ledger(log, path, 3).awaitTermination()
    return ledger_state(spark, path)


@query(_OTHER.replace("WITH ", cte("hotel")[:-1] + ", ", 1) + _PUB + ", op AS (SELECT hotel_id FROM latest WHERE reason <> 'resolved'), s AS (SELECT hotel_id FROM fresh WHERE hotel_id NOT IN (SELECT hotel_id FROM op)) SELECT count(*) AS in_scope, count(*) FILTER (id IN (SELECT hotel_id FROM s)) AS skipped, count(*) FILTER (id IN (SELECT hotel_id FROM fresh) AND id IN (SELECT hotel_id FROM op)) AS backfill, count(*) FILTER (id NOT IN (SELECT hotel_id FROM s)) AS todo FROM hotel")
def skip_counts(spark, d):
    log = _attempts(spark, d)
    skip = ledger.skip_ids(_published(spark, d), log, F.lit(TODAY).cast("date"), 3)
    return reports.skip_counts(view(spark, d, "hotel").select(F.col("id").alias("hotel_id")), skip, _fresh(spark, d), ledger.unresolved_ids(log))


# --- gaps and publishing

_STORED = cte("room", "incoming") + ", s AS (SELECT hotel_id, lower(substr(trim(name), 1, 191)) AS room_key, bool_or(trim(coalesce(thumbnail, '')) <> '') AS has_image FROM room GROUP BY ALL), i AS (SELECT *, lower(substr(trim(room_name), 1, 191)) AS room_key FROM incoming)"


def _incoming(spark, d):
    urls = F.transform(F.sequence(F.lit(1), F.col("n_images").cast("int")), lambda k: F.concat(F.lit("u"), k.cast("string")))
    return view(spark, d, "incoming").withColumn("images", F.when(F.col("n_images") > 0, urls).otherwise(F.array().cast("array<string>")))


def _stored_flags(spark, d):
    f = scans.existing_flags(view(spark, d, "room"))
    return f.groupBy("hotel_id", "room_key").agg(F.bool_or("has_image").alias("has_image"))


@query(_STORED + " SELECT hotel_id, seq FROM i LEFT JOIN s USING (hotel_id, room_key) WHERE n_images = 0 AND NOT coalesce(has_image, false)")
def gap_rooms(spark, d):
    return publishing.gap_rooms(_incoming(spark, d), _stored_flags(spark, d)).select("hotel_id", "seq")


@query(_STORED + " SELECT hotel_id, seq, n_images > 0 AND NOT coalesce(has_image, false) AS need_mirror, CASE WHEN NOT coalesce(has_image, false) THEN n_images ELSE 0 END::INT AS n_left FROM i LEFT JOIN s USING (hotel_id, room_key)")
def split_for_mirroring(spark, d):
    return publishing.split_for_mirroring(_incoming(spark, d), _stored_flags(spark, d)).select("hotel_id", "seq", "need_mirror", F.size("images").alias("n_left"))


@query(_STORED + ", g AS (SELECT hotel_id, room_key, seq FROM i LEFT JOIN s USING (hotel_id, room_key) WHERE n_images = 0 AND NOT coalesce(has_image, false)), o AS (SELECT hotel_id, room_key, n_images, row_number() OVER (PARTITION BY hotel_id, room_key ORDER BY seq) AS r FROM i WHERE n_images > 0) SELECT g.hotel_id, seq, coalesce(o.n_images, 0)::INT AS n_images, o.n_images IS NOT NULL AS filled FROM g LEFT JOIN o ON o.hotel_id = g.hotel_id AND o.room_key = g.room_key AND r = 1")
def gap_fill(spark, d):
    i = _incoming(spark, d)
    gaps = publishing.gap_rooms(i, _stored_flags(spark, d))
    return publishing.gap_fill(gaps, i.filter("n_images > 0")).select("hotel_id", "seq", F.size("images").alias("n_images"), "filled")


_ACT = cte("room", "incoming") + """, o AS (SELECT hotel_id, lower(substr(trim(name), 1, 191)) AS room_key, arg_min(struct_pack(t := thumbnail, z := size_sqft, c := category_id), id) AS v FROM room GROUP BY ALL),
i AS (SELECT *, lower(substr(trim(room_name), 1, 191)) AS room_key FROM incoming),
n AS (SELECT *, row_number() OVER (PARTITION BY hotel_id, room_key ORDER BY seq) AS nth FROM i),
j AS (SELECT n.*, o.v IS NOT NULL AS known, nullif(trim(v.t), '') AS ot, v.z AS oz, v.c AS oc FROM n LEFT JOIN o USING (hotel_id, room_key)),
k AS (SELECT *, ot IS NULL AND nullif(trim(thumbnail), '') IS NOT NULL AS ft, CASE WHEN nth > 1 THEN 'skip_duplicate' WHEN NOT known THEN 'insert' WHEN (ot IS NULL AND nullif(trim(thumbnail), '') IS NOT NULL) OR (oz IS NULL AND size_sqft IS NOT NULL) OR (oc IS NULL AND category_id IS NOT NULL) THEN 'fill' ELSE 'skip_existing' END AS action FROM j)"""


def _acted(spark, d):
    return publishing.actions(_incoming(spark, d), view(spark, d, "room"))


@query(_ACT + " SELECT hotel_id, seq, action FROM k")
def publish_actions(spark, d):
    return _acted(spark, d).select("hotel_id", "seq", "action")


@query(_ACT + " SELECT hotel_id, room_key, coalesce(ot, nullif(trim(thumbnail), '')) AS thumbnail, coalesce(oz, size_sqft) AS size_sqft, coalesce(oc, category_id) AS category_id, action FROM k WHERE action <> 'skip_duplicate'")
def fill_only(spark, d):
    return publishing.filled(_acted(spark, d))


@query(_ACT + " SELECT hotel_id, room_key, (p - 1)::INT AS pos, 'u' || p AS url FROM k, unnest(range(2, n_images + 1)) t(p) WHERE action = 'insert' OR (action = 'fill' AND ft)")
def gallery_rows(spark, d):
    return publishing.gallery(_acted(spark, d))


@query(_ACT + " SELECT hotel_id, seq FROM k WHERE action = 'skip_duplicate'")
def intra_run_duplicates(spark, d):
    return _acted(spark, d).filter("action = 'skip_duplicate'").select("hotel_id", "seq")


@query(_ACT + " SELECT hotel_id, count(*) FILTER (action = 'insert') AS \"insert\", count(*) FILTER (action = 'fill') AS fill, count(*) FILTER (action = 'skip_existing') AS skip_existing, count(*) FILTER (action = 'skip_duplicate') AS skip_duplicate, count(*) FILTER (action IN ('insert', 'fill') AND ft) AS thumbnails FROM k GROUP BY hotel_id")
def publish_counters(spark, d):
    return publishing.counters(_acted(spark, d))


@query("SELECT p_brand, md5(string_agg(p_partkey::VARCHAR, ',' ORDER BY p_partkey) || '|t=1') AS scope FROM part GROUP BY p_brand")
def scope_fingerprint(spark, d):
    return _table(spark, d, "part").groupBy("p_brand").agg(F.collect_list("p_partkey").alias("ids")).select("p_brand", publishing.scope(F.col("ids"), "t=1").alias("scope"))


# --- extraction


@query("SELECT page_id, md5(html) || '.html' AS object_key FROM pages")
def content_key(spark, d):
    return _table(spark, d, "pages").select("page_id", extract.content_key(F.col("html").cast("binary"), F.lit(".html")).alias("object_key"))


@query("SELECT page_id, octet_length(encode(CASE page_id % 3 WHEN 0 THEN 'GIF8' WHEN 1 THEN 'RIFF' ELSE '' END || html)) >= 4096 AND page_id % 3 < 2 AS usable FROM pages")
def usable_blob(spark, d):
    head = F.when(F.col("page_id") % 3 == 0, "GIF8").when(F.col("page_id") % 3 == 1, "RIFF").otherwise("")
    return _table(spark, d, "pages").select("page_id", extract.usable_image(F.concat(head, F.col("html")).cast("binary")).alias("usable"))


@query("SELECT page_id, CASE page_id % 4 WHEN 0 THEN '.png' WHEN 1 THEN '.jpg' WHEN 2 THEN '.gif' ELSE '.jpg' END AS extension FROM pages")
def image_extension(spark, d):
    k = F.col("page_id") % 4
    url = F.when(k == 2, F.concat(F.col("url"), F.lit("/a.GIF"))).otherwise(F.col("url"))
    clean = F.regexp_replace(url, r"[?#].*?(/a\.GIF)?$", "$1")
    return _table(spark, d, "pages").select("page_id", extract.image_extension(clean, F.when(k == 0, "image/png; q=1").when(k == 1, "image/jpeg")).alias("extension"))


@query("SELECT p_partkey AS hotel_id, p_partkey * 10 AS b_id, p_name AS room_name, (1 + p_size % 4)::INT AS max_occupancy, (p_size % 3)::INT AS rate_plan_count, CASE WHEN p_partkey % 2 = 0 THEN 'https://img/' || p_partkey END AS image, CASE WHEN p_partkey % 3 = 0 THEN 1000 + p_size END::INT AS size_sqft FROM part WHERE p_partkey % 5 > 0")
def json_props(spark, d):
    """Rooms of property payloads; a stay of no night (one in five) gives none."""
    p = _table(spark, d, "part")
    image = F.when(F.col("p_partkey") % 2 == 0, F.array(F.concat(F.lit("//img/"), F.col("p_partkey").cast("string")))).otherwise(F.array().cast("array<string>"))
    title = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Room size: 93 m²/1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(" ft²"))).otherwise("Balcony")
    plans = F.transform(F.sequence(F.lit(1), F.lit(2)), lambda k: k.cast("string"))
    room = F.struct((F.col("p_partkey") * 10).alias("id"), F.concat(F.lit(" "), "p_name").alias("name"), (1 + F.col("p_size") % 4).alias("maxOccupancy"), F.slice(plans, F.lit(1), F.col("p_size") % 3).alias("rooms"), image.alias("images"), F.array(F.struct(title.alias("title"))).alias("features"))
    bodies = p.select(F.col("p_partkey").alias("hotel_id"), F.to_json(F.struct(F.array(room).alias("masterRooms"))).alias("body"), F.lit("2024-06-01").alias("check_in"), F.when(F.col("p_partkey") % 5 > 0, "2024-06-03").otherwise("2024-06-01").alias("check_out"))
    return extract.property_rooms(bodies).select("hotel_id", "b_id", "room_name", "max_occupancy", "rate_plan_count", F.get("images", F.lit(0)).alias("image"), "size_sqft")


def _plans(spark, d):
    li = _table(spark, d, "lineitem")
    option = F.struct(F.concat(F.lit("plan "), "l_returnflag").alias("Title"), F.array(F.struct(F.when(F.col("l_partkey") % 3 > 0, F.concat(F.lit("room "), (F.col("l_partkey") % 20).cast("string"))).otherwise(" ").alias("Name"), (1 + F.col("l_partkey") % 4).cast("int").alias("MaxOccupancy"))).alias("Rooms"))
    options = F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", option.alias("o")))), lambda x: x["o"])
    body = F.to_json(F.struct(F.struct(options.alias("Options"), F.struct((F.first("l_suppkey") + F.when(F.first("l_suppkey") % 4 == 0, 1).otherwise(0)).alias("CommonID")).alias("Property")).alias("Itinerary")))
    return extract.availability(li.groupBy(F.col("l_suppkey").alias("hotel_id")).agg(body.alias("body")))


@query("SELECT hotel_id, room_name, max_occupancy FROM (SELECT l_suppkey AS hotel_id, CASE WHEN l_partkey % 3 > 0 THEN 'room ' || l_partkey % 20 ELSE 'plan ' || l_returnflag END AS room_name, (1 + l_partkey % 4)::INT AS max_occupancy, row_number() OVER (PARTITION BY l_suppkey, CASE WHEN l_partkey % 3 > 0 THEN 'room ' || l_partkey % 20 ELSE 'plan ' || l_returnflag END ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem WHERE l_suppkey % 4 > 0) WHERE r = 1")
def availability_ingest(spark, d):
    """Rooms of captured availability payloads; those about another hotel than the one asked for give none."""
    return unions.ingested(_plans(spark, d))[0]


@query("SELECT DISTINCT l_suppkey AS hotel_id, l_suppkey + 1 AS payload_id FROM lineitem WHERE l_suppkey % 4 = 0")
def id_mismatch(spark, d):
    return unions.ingested(_plans(spark, d))[1]


@query("SELECT event_id AS hotel_id FROM events WHERE event_id % 3 = 0")
def landing_check(spark, d):
    e = _table(spark, d, "events")
    url = F.concat(F.lit("https://host/search?x=1&hotel="), F.when(F.col("event_id") % 3 == 0, F.col("event_id").cast("string")).when(F.col("event_id") % 3 == 1, "7777777").otherwise("none"))
    return extract.landed(e.select(F.col("event_id").alias("hotel_id"), F.col("event_id").alias("property_id"), url.alias("final_url"))).select("hotel_id")


@query("SELECT p_partkey AS page_id, p_partkey::VARCHAR AS room_id, p_name AS room_name FROM part WHERE p_partkey % 4 > 0")
def redirect_reject(spark, d):
    p = _table(spark, d, "part")
    html = F.concat(F.lit('{"b_id": '), F.col("p_partkey").cast("string"), F.lit(', "b_name": "'), "p_name", F.lit('"}'))
    url = F.when(F.col("p_partkey") % 4 > 0, F.concat(F.lit("https://host/hotel/ae/inn-"), F.col("p_partkey").cast("string"), F.lit(".html"))).otherwise("https://host/searchresults.html")
    return extract.dated_rooms(p.select(F.col("p_partkey").alias("page_id"), html.alias("html"), url.alias("final_url"))).select("page_id", "room_id", "room_name")


# what a payload holds varies: a slug as a value (its slashes escaped or not), as a name of a member, at another depth, not at all
@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 < 3 THEN lower(replace(s_name, '#', '-')) || '_2' WHEN s_suppkey % 5 = 3 THEN 'last' END AS slug, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS local FROM supplier")
def own_slug(spark, d):
    kind, quoted = F.col("s_suppkey") % 5, lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    page = F.concat(F.lit("/"), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.lit("_2/hotel/town-ae.html"))
    other = '{"/key/hotel/a.html": ["help", "see /no/hotel/b.html"], "n": 7, "x": [null, true'
    body = (
        F.when(kind == 0, F.concat(F.lit(other + ", "), quoted(page), F.lit("]}")))
        .when(kind == 1, F.concat(F.lit(other + ', {"a": {"b": [['), quoted(F.replace(page, F.lit("/"), F.lit("\\/"))), F.lit("]]}}]}")))
        .when(kind == 2, F.concat(F.lit("[" * 9), quoted(page), F.lit("]" * 9)))
        .when(kind == 3, F.concat(F.lit('{"a": {"links": ['), quoted(page), F.lit(', "/last/hotel/c.html"]}}')))
        .otherwise(F.lit(other + "]}"))
    )
    names = F.to_json(F.struct(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise("").alias("en"), F.lit("x").alias("ar")))
    rows = _table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), body.alias("body"), extract.local_name(names).alias("local"))
    return rows.join(extract.own_slugs(rows, "id", "body"), "id").select("id", "slug", "local")


@query("SELECT o_custkey AS query, nth AS seq, o_orderkey AS object_id, 'inn ' || o_orderkey AS name, CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey % 50 END AS city_id, CASE WHEN o_orderkey % 6 IN (1, 2) THEN 'ae' END AS country_iso FROM (SELECT *, (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1)::INT AS nth FROM orders) WHERE o_orderkey % 4 > 0")
def suggestion_payloads(spark, d):
    """Suggestions with their view models, both arrays of one payload; ids as numbers or as text, a view model given twice, or not at all."""
    o, k = _table(spark, d, "orders"), F.col("o_orderkey")
    text = k.cast("string")
    ident = F.when(k % 2 == 0, F.concat(F.lit('"'), text, F.lit('"'))).otherwise(text)
    suggestion = F.concat(F.lit('{"ObjectID": '), ident, F.lit(', "ObjectTypeID": '), F.when(k % 4 > 0, "1").otherwise('"9"'), F.lit(', "Name": "inn '), text, F.lit('"}'))
    iso = F.when(k % 6 == 1, '"AE"').when(k % 6 == 2, '"ae"').when(k % 6 == 4, '""').otherwise("null")
    model = F.when(k % 3 > 0, F.concat(F.lit('{"ObjectId": '), text, F.lit(', "CityId": -1}, {"ObjectId": "'), text, F.lit('", "CityId": '), (k % 50).cast("string"), F.lit(', "CountryISO": '), iso, F.lit('}, {"ObjectId": 0, "CityId": 5}')))
    listed = lambda c: F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.when(c.isNotNull(), F.struct(k, c.alias("c"))))), lambda x: x["c"]))
    bodies = o.groupBy(F.col("o_custkey").alias("query")).agg(F.concat(F.lit('{"ViewModelList": ['), listed(model), F.lit('], "SuggestionList": ['), listed(suggestion), F.lit("]}")).alias("body"))
    return extract.suggestions(bodies).select("query", "seq", "object_id", "name", "city_id", "country_iso")


@query("SELECT l_suppkey AS hotel_id, l_suppkey AS payload_id, (row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag) - 1)::INT AS option_seq, CASE WHEN l_partkey % 7 > 0 THEN 'plan ' || l_returnflag END AS title, CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE 1 END::INT AS n_rooms, CASE WHEN l_partkey % 5 IN (1, 2) THEN (1 + l_partkey % 4)::INT END AS max_occupancy FROM lineitem")
def availability_drift(spark, d):
    """Availability payloads whose form drifts: numbers as text, values of another kind, members that are missing."""
    k = F.col("l_partkey")
    most = F.when(k % 5 == 1, (1 + k % 4).cast("string")).when(k % 5 == 2, F.concat(F.lit('"'), (1 + k % 4).cast("string"), F.lit('"'))).when(k % 5 == 3, '"many"').otherwise("{}")
    room = F.when(k % 5 == 0, '"none"').otherwise(F.concat(F.lit('[{"Name": "r", "MaxOccupancy": '), most, F.lit("}]")))
    option = F.concat(F.lit("{"), F.when(k % 7 > 0, F.concat(F.lit('"Title": "plan '), "l_returnflag", F.lit('", '))).otherwise(""), F.lit('"Rooms": '), room, F.lit("}"))
    options = F.concat_ws(", ", F.transform(F.array_sort(F.collect_list(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", option.alias("o")))), lambda x: x["o"]))
    h = F.col("hotel_id").cast("string")
    ident = F.when(F.col("hotel_id") % 2 == 0, F.concat(F.lit('"'), h, F.lit('"'))).otherwise(h)
    rows = _table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("hotel_id")).agg(options.alias("options"))
    bodies = rows.select("hotel_id", F.concat(F.lit('{"Itinerary": {"Options": ['), "options", F.lit('], "Property": {"CommonID": '), ident, F.lit("}}}")).alias("body"))
    plans = extract.availability(bodies)
    return plans.select("hotel_id", "payload_id", "option_seq", "title", F.size("rooms").alias("n_rooms"), F.get("rooms", F.lit(0))["max_occupancy"].alias("max_occupancy"))


_OBJECTS = "WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), k AS (SELECT page_id, md5(html) || '.html' AS key, octet_length(encode(html))::BIGINT AS size, page_id > min(page_id) OVER (PARTITION BY html) AS reused FROM p WHERE html <> '')"


@query(_OBJECTS + " SELECT page_id, key, size, reused, true AS reused_again, size AS stored_size, true AS intact FROM k")
def object_store(spark, d):
    """Pages stored as objects, twice, and what the folder holds of them afterwards; an empty page is none."""
    folder = fresh_path(spark, "objects")
    content = F.coalesce("html", F.lit("")).cast("binary")
    rows = _table(spark, d, "pages").select(F.col("page_id").alias("id"), extract.content_key(content, F.lit(".html")).alias("key"), content.alias("content"))
    first, again = (objects.store(rows, folder) for _ in range(2))
    there = objects.stored(spark, folder).select("key", F.col("size").alias("stored_size"), (F.md5("content") == F.substring_index("key", ".", 1)).alias("intact"))
    return first.select(F.col("id").alias("page_id"), "key", "size", "reused").join(again.select(F.col("id").alias("page_id"), F.col("reused").alias("reused_again")), "page_id").join(there, "key")


@query("WITH f AS (SELECT page_id, '\\xFF\\xD8'::BLOB || encode(coalesce(html, '')) AS c FROM pages), k AS (SELECT page_id, CASE WHEN octet_length(c) >= 4096 THEN md5(c) || (CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.webp' ELSE '.gif' END) END AS key FROM f), r AS (SELECT page_id % 40 AS hotel_id, 'r' || page_id % 2 AS room_key, list('s/' || key ORDER BY page_id DESC) FILTER (key IS NOT NULL) AS s FROM k GROUP BY ALL) SELECT hotel_id, room_key, s[1] AS thumbnail, coalesce(array_to_string(s[2:], ','), '') AS gallery FROM r")
def mirrored_rooms(spark, d):
    """Rooms whose images are stored and hosted, in the order of their addresses; what is too small is no image."""
    p = _table(spark, d, "pages").withColumn("url", F.concat(F.lit("http://i/"), F.col("page_id").cast("string"), F.lit(".gif?x=1")))
    kind = F.when(F.col("page_id") % 3 == 0, "image/png").when(F.col("page_id") % 3 == 1, "image/webp; q=1")
    fetched = p.select("url", kind.alias("content_type"), F.concat(F.unhex(F.lit("FFD8")), F.coalesce("html", F.lit("")).cast("binary")).alias("content"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("page_id", "url")), asc=False), lambda x: x["url"])
    wanted = p.groupBy((F.col("page_id") % 40).alias("hotel_id"), F.concat(F.lit("r"), (F.col("page_id") % 2).cast("string")).alias("room_key")).agg(listed.alias("images"))
    return objects.mirror(wanted, fetched, fresh_path(spark, "images"), "s/").select("hotel_id", "room_key", "thumbnail", F.array_join("images", ",").alias("gallery"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN (1000 + p_size)::INT END AS size_sqft FROM part")
def parse_size(spark, d):
    stated = F.concat(F.lit("Room size: 93 m²/1,"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(" ft²"))
    titles = F.array(F.lit("Balcony"), F.when(F.col("p_partkey") % 3 > 0, stated), F.lit("No size"))
    return _table(spark, d, "part").select("p_partkey", extract.size_sqft(titles).alias("size_sqft"))


@query(cte("hotel") + "SELECT id, slug, trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') AS derived FROM hotel")
def slug_from_url(spark, d):
    h = view(spark, d, "hotel")
    url = F.concat(F.lit("https://host.example/"), "slug", F.lit("/hotel/town-ae.html?x=1"))
    return h.select("id", extract.slug_of(url).alias("slug"), extract.slugified(F.col("name")).alias("derived"))


@query("SELECT s_nationkey::BIGINT AS page_id, lower(replace(s_name, '#', '-')) AS slug, 'ae' AS country, s_name AS name, round(25 + s_suppkey % 97 / 1000.0, 3)::DOUBLE AS lat FROM supplier")
def html_cards(spark, d):
    lat = F.format_number(25 + F.col("s_suppkey") % 97 / 1000, 3)
    card = F.concat(F.lit('<div data-testid="property-card"><a href="/hotel/ae/'), F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))), F.lit('.html">x</a><div data-testid="title" class="t"> '), "s_name", F.lit(' <</div>{"latitude": '), lat, F.lit(', "longitude": 55.1}'))
    pages = _table(spark, d, "supplier").groupBy(F.col("s_nationkey").cast("long").alias("page_id")).agg(F.concat(F.lit("<html>"), F.array_join(F.collect_list(card), "")).alias("html"))
    return extract.cards(pages).select("page_id", "slug", "country", "name", "lat")


@query("SELECT p_partkey % 100 AS page_id, p_partkey::VARCHAR AS room_id, p_name AS room_name, (p_partkey % 3)::INT AS n_images FROM part")
def parse_rooms_html(spark, d):
    p = _table(spark, d, "part")
    one = F.concat(F.lit('{"b_id": '), F.col("p_partkey").cast("string"), F.lit(', "x": {"y": "}"}, "b_name": "'), "p_name", F.lit('"}'))
    photo = lambda k: F.when(F.col("p_partkey") % 3 >= k, F.concat(F.lit(f"{{id: {k}, large_url: 'http://i/{k}', associated_rooms: ['"), F.col("p_partkey").cast("string"), F.lit("']},")))
    pages = p.groupBy((F.col("p_partkey") % 100).alias("page_id")).agg(F.concat(F.lit("rooms = ["), F.array_join(F.collect_list(one), ","), F.lit("]; allRoomPhotos: ["), F.array_join(F.collect_list(photo(1)), ""), F.array_join(F.collect_list(photo(2)), ""), F.lit("];")).alias("html"))
    return extract.markup_rooms(pages).select("page_id", "room_id", "room_name", F.size("images").alias("n_images"))


# --- reviews and reports

_QUEUE = "WITH q AS (SELECT o_custkey AS hotel_id, o_orderkey AS a_id, round(o_totalprice / 10000, 1) AS score, CASE o_orderkey % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'approve' WHEN 2 THEN 'no' END AS decision FROM orders), n AS (SELECT *, row_number() OVER (ORDER BY score DESC, hotel_id, a_id) + 100 AS row_id FROM q) "


def _queue(spark, d):
    rows = _table(spark, d, "orders").selectExpr("o_custkey AS hotel_id", "o_orderkey AS a_id", "round(o_totalprice / 10000, 1) AS score", "CASE o_orderkey % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'approve' WHEN 2 THEN 'no' END AS decision")
    return reports.review_queue(rows, 100)


@query(_QUEUE + "SELECT hotel_id, a_id, row_id FROM n")
def review_queue(spark, d):
    return _queue(spark, d).select("hotel_id", "a_id", "row_id")


@query(_QUEUE + "SELECT row_id FROM n WHERE a_id % 4 < 2")
def apply_reviews(spark, d):
    return _queue(spark, d).filter(reports.approved(F.col("decision"))).select("row_id")


@query(_QUEUE + "SELECT row_id FROM n WHERE a_id % 4 >= 2")
def queue_remaining(spark, d):
    q = _queue(spark, d)
    return reports.remaining(q, q.filter(reports.approved(F.col("decision")))).select("row_id")


_STATES = _PROBE + ", s AS (SELECT h, bool_or(outcome = 'ok') AS r, bool_or(outcome = 'unavailable') AS u, bool_or(outcome = 'error') AS e FROM (SELECT *, event_id // 4 AS h FROM probe) GROUP BY h)"


@query(_STATES + " SELECT count(*) AS total, count(*) FILTER (r) AS resolved, count(*) FILTER (NOT r AND u) AS unavailable, count(*) FILTER (NOT r AND NOT u AND e) AS unanswered, 'ok' AS reconciled FROM s")
def run_funnel(spark, d):
    return reports.funnel(probing.outcomes(view(spark, d, "probe").withColumn("hotel_id", F.floor(F.col("event_id") / 4))))


@query(cte("log") + "SELECT reason, count(*) AS n FROM log GROUP BY reason")
def reason_histogram(spark, d):
    return reports.reason_histogram(view(spark, d, "log"))


@query(_LOG + _PUB.replace(", pub", ", hotel AS (" + cte("hotel").split("AS (", 1)[1].rsplit(")", 1)[0] + "), pub") + " SELECT city_id, count(*) AS total, count(f.hotel_id) AS fresh, count(*) - count(f.hotel_id) AS runnable FROM hotel LEFT JOIN fresh f ON f.hotel_id = hotel.id GROUP BY city_id")
def runnable_counts(spark, d):
    return reports.runnable(view(spark, d, "hotel").select("id", "city_id"), _fresh(spark, d))


@query(_PROBE + "SELECT event_id // 2 AS hotel_id, CASE WHEN sum(n_rooms) > 0 THEN sum(n_rooms)::BIGINT::VARCHAR WHEN bool_or(outcome = 'unavailable') THEN '0(unsellable)' WHEN bool_or(outcome = 'error') THEN '0(no answer)' ELSE '0(verified)' END AS label FROM probe GROUP BY event_id // 2")
def bm_label(spark, d):
    p = view(spark, d, "probe").groupBy(F.floor(F.col("event_id") / 2).alias("hotel_id")).agg(F.sum("n_rooms").alias("n"), F.bool_or(F.col("outcome") == "unavailable").alias("u"), F.bool_or(F.col("outcome") == "error").alias("e"))
    return p.select("hotel_id", reports.count_label(F.col("n"), F.lit(True), F.col("u"), F.col("e")).alias("label"))


@query(_PROBE + ", r AS (SELECT *, sum((outcome <> 'error')::INT) OVER (PARTITION BY hotel_id ORDER BY event_id) AS isle FROM probe), n AS (SELECT hotel_id, isle, count(*) FILTER (outcome = 'error') AS n FROM r GROUP BY ALL) SELECT hotel_id, max(n) AS longest, arg_max(n, isle) AS trailing, sum(n // 3)::BIGINT AS rotations, arg_max(n, isle) >= 8 AS degraded FROM n GROUP BY hotel_id")
def failure_streaks(spark, d):
    p = view(spark, d, "probe").withColumn("failed", F.col("outcome") == "error")
    return probing.failure_streaks(p, "hotel_id", ["event_id"], "failed")


@query("SELECT hotel_id, room_key, CASE WHEN n > 0 THEN first END AS thumbnail, greatest(n - 1, 0)::INT AS n_gallery FROM (SELECT o_custkey AS hotel_id, o_orderpriority AS room_key, count(*) FILTER (o_orderkey % 3 > 0) AS n, arg_min('h' || o_orderkey, o_orderkey) FILTER (o_orderkey % 3 > 0) AS first FROM orders GROUP BY ALL)")
def mirror_fan_out(spark, d):
    r = _table(spark, d, "orders").select(F.col("o_custkey").alias("hotel_id"), F.col("o_orderpriority").alias("room_key"), F.col("o_orderkey").alias("pos"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("h"), F.col("o_orderkey").cast("string"))).alias("hosted"))
    return reports.mirrored(r).select("hotel_id", "room_key", "thumbnail", F.size("images").alias("n_gallery"))


# --- rooms as they are published


def _categories(spark):
    names = N.all_categories()
    return spark.createDataFrame([(k + 1, c.upper() if k % 2 else c) for k, c in enumerate(names)], "id long, name string")


_TAXONOMY = "taxonomy AS (SELECT * FROM (VALUES " + ", ".join(f"({k + 1}::BIGINT, '{c}')" for k, c in enumerate(N.all_categories())) + ") t(category_id, category))"
_PUBLISHED = _M + f""", {_TAXONOMY}, ready AS (SELECT hotel_id, a_id, CASE WHEN status <> 'unmatched' THEN m.b_id END AS b_id, room_name, status FROM m WHERE status <> 'review'),
dressed AS (SELECT r.*, coalesce(b.n_images, 0) AS n_images, {O.norm('r.room_name')} AS norm FROM ready r LEFT JOIN room_b b ON b.hotel_id = r.hotel_id AND b.b_id = r.b_id),
made AS (SELECT *, {_category_sql('norm')} AS category FROM dressed)"""


def _publishable(spark, d):
    b = view(spark, d, "room_b")
    urls = F.when(F.col("n_images") > 0, F.transform(F.sequence(F.lit(1), F.col("n_images").cast("int")), lambda k: F.concat(F.lit("u"), k.cast("string")))).otherwise(F.array().cast("array<string>"))
    offered = b.withColumn("images", urls).withColumn("size_sqft", F.when(F.col("b_id") % 3 == 0, 300).cast("int"))
    return rooms.publishable(mapping.map_rooms(view(spark, d, "room_a"), b), offered, _categories(spark))


@query(_PUBLISHED + " SELECT hotel_id, a_id, b_id, room_name, status, category, category_id, n_images::INT AS n_images, CASE WHEN b_id % 3 = 0 THEN 300 END::INT AS size_sqft, CASE WHEN n_images > 0 THEN 'b' ELSE '' END AS image_source, row_number() OVER (PARTITION BY hotel_id ORDER BY a_id NULLS LAST, b_id) AS seq FROM made LEFT JOIN taxonomy USING (category)")
def publishable_rooms(spark, d):
    return _publishable(spark, d).select("hotel_id", "a_id", "b_id", "room_name", "status", "category", "category_id", F.size("images").alias("n_images"), "size_sqft", "image_source", "seq")


_STORE = _ACT + ", top AS (SELECT max(id) AS top FROM room), firsts AS (SELECT hotel_id, lower(substr(trim(name), 1, 191)) AS room_key, min(id) AS id FROM room GROUP BY ALL), f AS (SELECT x.id, k.* FROM k JOIN firsts x USING (hotel_id, room_key) WHERE action = 'fill')"


def _loaded_store(spark, d):
    """A store that holds the rooms there are."""
    store = Store(spark, fresh_path(spark, "store"))
    store.load(view(spark, d, "room"))
    return store


def _published_store(spark, d):
    """A store that was published to twice: the rooms there are, then the incoming ones."""
    store = _loaded_store(spark, d)
    store.publish(_incoming(spark, d))
    return store


@query(_STORE + " SELECT r.id, r.hotel_id, r.name, CASE WHEN f.id IS NULL THEN nullif(trim(r.thumbnail), '') ELSE coalesce(nullif(trim(r.thumbnail), ''), nullif(trim(f.thumbnail), '')) END AS thumbnail, CASE WHEN f.id IS NULL THEN r.size_sqft ELSE coalesce(r.size_sqft, f.size_sqft) END AS size_sqft, CASE WHEN f.id IS NULL THEN r.category_id ELSE coalesce(r.category_id, f.category_id) END AS category_id FROM room r LEFT JOIN f ON f.id = r.id UNION ALL SELECT top + row_number() OVER (ORDER BY hotel_id, seq, room_key), hotel_id, substr(trim(room_name), 1, 191), nullif(trim(thumbnail), ''), size_sqft, category_id FROM k, top WHERE action = 'insert'")
def publish_store(spark, d):
    return _published_store(spark, d).rooms()


# three runs: the first two are made against the same version, and the second of them is committed first
_RUNS = cte("incoming", "room")[:-1] + """, top AS (SELECT max(id) AS top FROM room), turn AS (
  SELECT *, lower(substr(trim(room_name), 1, 191)) AS room_key, CASE seq % 3 WHEN 1 THEN 1 WHEN 0 THEN 2 ELSE 3 END AS run FROM incoming
), firsts AS (SELECT * FROM turn QUALIFY row_number() OVER (PARTITION BY hotel_id, room_key, run ORDER BY seq) = 1
), had AS (SELECT hotel_id, lower(substr(trim(name), 1, 191)) AS room_key, min(id) AS id FROM room GROUP BY ALL
), offered AS (
  SELECT hotel_id, room_key, arg_min(nullif(trim(thumbnail), ''), run) AS thumbnail, arg_min(size_sqft, run) AS size_sqft, arg_min(category_id, run) AS category_id,
    min(run) AS run, arg_min(seq, run) AS seq, arg_min(substr(trim(room_name), 1, 191), run) AS name FROM firsts GROUP BY ALL
), new AS (SELECT o.* FROM offered o ANTI JOIN had USING (hotel_id, room_key))"""


def _three_runs(spark, d):
    store = _loaded_store(spark, d)
    one, two, three = (_incoming(spark, d).filter(F.col("seq") % 3 == k) for k in (0, 1, 2))
    counted = publishing_together(store, [one, two])
    return store, [counted[1], counted[0], store.commit(store.prepare(three))[0].counted]


@query(_RUNS + """
SELECT r.id, r.hotel_id, r.name, coalesce(nullif(trim(r.thumbnail), ''), o.thumbnail) AS thumbnail, coalesce(r.size_sqft, o.size_sqft) AS size_sqft, coalesce(r.category_id, o.category_id) AS category_id
FROM room r LEFT JOIN had ON had.id = r.id LEFT JOIN offered o ON o.hotel_id = had.hotel_id AND o.room_key = had.room_key
UNION ALL SELECT top + row_number() OVER (ORDER BY run, hotel_id, seq, room_key), hotel_id, name, thumbnail, size_sqft, category_id FROM new, top""")
def publish_three_times(spark, d):
    return _three_runs(spark, d)[0].rooms()


@query(_RUNS + """
, dup AS (SELECT run, count(*) AS n FROM turn GROUP BY run), kinds AS (
  SELECT f.run, count(*) AS n, count(*) FILTER (WHERE had.id IS NULL AND o.run = f.run) AS inserted FROM firsts f LEFT JOIN had USING (hotel_id, room_key) JOIN offered o USING (hotel_id, room_key) GROUP BY f.run
) SELECT run::INT AS run, inserted AS inserted, dup.n - kinds.n AS skip_duplicate FROM kinds JOIN dup USING (run)""")
def publish_observed(spark, d):
    """What each run counted as it was written, and committed."""
    counted = _three_runs(spark, d)[1]
    return spark.createDataFrame([(i, c["insert"], c["skip_duplicate"]) for i, c in enumerate(counted, start=1)], "run int, inserted long, skip_duplicate long")


@query(_ACT + " SELECT hotel_id, room_key, (p - 1)::INT AS pos, 'u' || p AS url FROM k, unnest(range(2, n_images + 1)) t(p) WHERE action = 'insert' OR (action = 'fill' AND ft)")
def publish_gallery(spark, d):
    return _published_store(spark, d).gallery()


@query(f"WITH {_TAXONOMY}, n AS (SELECT p_partkey, p_brand, p_name || CASE p_partkey % 4 WHEN 0 THEN ' Suite' WHEN 1 THEN ' 2 Bedroom Apartment' WHEN 2 THEN '' ELSE ' Deluxe Room' END AS room_name, p_size FROM part), m AS (SELECT *, lower(room_name) AS norm FROM n), c AS (SELECT *, {_category_sql('norm')} AS category FROM m) SELECT p_partkey AS row_id, room_name, category, category_id, CASE WHEN p_size % 20 > 0 THEN least(p_size % 20, 15) ELSE 0 END::INT AS n_images, CASE WHEN p_size % 20 > 0 THEN 'c' ELSE '' END AS image_source FROM c LEFT JOIN taxonomy USING (category)")
def plan_rooms(spark, d):
    p = _table(spark, d, "part")
    name = F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, " Suite").when(F.col("p_partkey") % 4 == 1, " 2 Bedroom Apartment").when(F.col("p_partkey") % 4 == 2, "").otherwise(" Deluxe Room"))
    images = F.when(F.col("p_size") % 20 > 0, F.transform(F.sequence(F.lit(1), F.col("p_size") % 20), lambda k: k.cast("string"))).otherwise(F.array().cast("array<string>"))
    rows = p.select(F.col("p_partkey").alias("row_id"), F.lit(1).alias("hotel_id"), name.alias("room_name"), images.alias("images"), F.lit(None).cast("int").alias("size_sqft"), F.lit("c").alias("image_source"))
    return rooms.from_plan(rows, _categories(spark)).select("row_id", "room_name", "category", "category_id", F.size("images").alias("n_images"), "image_source")


@query(f"WITH {_TAXONOMY}, n AS (SELECT p_name || CASE p_partkey % 4 WHEN 0 THEN ' Suite' WHEN 1 THEN ' 2 Bedroom Apartment' WHEN 2 THEN '' ELSE ' Deluxe Room' END AS room_name FROM part), m AS (SELECT lower(room_name) AS norm FROM n), c AS (SELECT DISTINCT {_category_sql('norm')} AS category FROM m) SELECT category AS name FROM taxonomy WHERE category NOT IN (SELECT category FROM c)")
def category_completeness(spark, d):
    """The categories that none of the rooms has."""
    name = F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, " Suite").when(F.col("p_partkey") % 4 == 1, " 2 Bedroom Apartment").when(F.col("p_partkey") % 4 == 2, "").otherwise(" Deluxe Room"))
    there = _table(spark, d, "part").select(F.upper(N.category(N.norm(name))).alias("name")).distinct()
    return scans.missing_categories(spark, there).select("name")


@query("SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 4 WHEN 1 THEN o_orderkey % 9 + 1 WHEN 2 THEN CASE WHEN o_orderkey % 9 > 0 THEN 1 END END::INT AS n, CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 9 WHEN o_orderkey % 5 = 1 OR (o_orderkey % 5 = 2 AND o_orderkey % 9 > 0) THEN 0 END::INT AS start FROM orders")
def parse_range(spark, d):
    """Ranges of a selection as somebody typed them: "4-7", "4", "0-0", in the wrong order, and words."""
    k = F.col("o_orderkey")
    text = lambda c: c.cast("string")
    low = k % 9
    reply = F.when(k % 5 == 0, F.concat(F.lit(" "), text(low + 1), F.lit(" - "), text(low + 4))).when(k % 5 == 1, text(low + 1)).when(k % 5 == 2, F.when(low > 0, "1-1").otherwise("0-0")).when(k % 5 == 3, F.concat(text(low + 2), F.lit("-"), text(low + 1))).otherwise("all of them")
    return _table(spark, d, "orders").select(k.alias("id"), extract.parse_range(reply).alias("r")).select("id", F.col("r.count").alias("n"), F.col("r.offset").alias("start"))


_REVIEWS = "WITH q AS (SELECT o_orderkey AS row_id, o_custkey AS hotel_id, CASE o_orderkey % 4 WHEN 0 THEN ' Yes' WHEN 1 THEN 'approve' WHEN 2 THEN 'no' END AS decision, o_orderkey % 5 AS n_images, o_orderkey % 3 > 0 AS hosted FROM orders), y AS (SELECT *, n_images = 0 OR hosted AS done FROM q WHERE row_id % 4 < 2)"


def _reviewed(spark, d):
    o = _table(spark, d, "orders")
    decision = F.when(F.col("o_orderkey") % 4 == 0, " Yes").when(F.col("o_orderkey") % 4 == 1, "approve").when(F.col("o_orderkey") % 4 == 2, "no")
    urls = F.when(F.col("o_orderkey") % 5 > 0, F.array_join(F.transform(F.sequence(F.lit(1), (F.col("o_orderkey") % 5).cast("int")), lambda k: k.cast("string")), "|"))
    queue = o.select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("hotel_id"), F.lit("King Suite").alias("room_name"), decision.alias("decision"), urls.alias("candidate_images"), F.lit("120").alias("candidate_size_sqft"))
    hosted = queue.filter("candidate_images IS NOT NULL").select("row_id", F.when(F.col("row_id") % 3 > 0, "t").alias("thumbnail"), F.when((F.col("row_id") % 3 > 0) & (F.col("row_id") % 5 > 1), F.array(F.lit("g"))).otherwise(F.array().cast("array<string>")).alias("images"))
    return rooms.apply_reviews(queue, hosted, _categories(spark))


@query(_REVIEWS + " SELECT row_id, hotel_id, 'Suite' AS category, 120 AS size_sqft, CASE WHEN n_images = 0 THEN 0 WHEN n_images = 1 THEN 1 ELSE 2 END AS n_hosted FROM y WHERE done")
def reviewed_rooms(spark, d):
    return _reviewed(spark, d)[0].select("row_id", "hotel_id", "category", "size_sqft", F.size("images").alias("n_hosted"))


@query(_REVIEWS + " SELECT row_id FROM q WHERE row_id NOT IN (SELECT row_id FROM y WHERE done)")
def reviews_left(spark, d):
    return _reviewed(spark, d)[1].select("row_id")


@query("SELECT count(*) AS planned, count(*) FILTER (c_custkey % 3 > 0) AS mapped, count(*) FILTER (c_custkey % 3 > 0 AND c_custkey % 5 = 0) AS mapped_blind, count(*) FILTER (c_custkey % 3 = 0) AS not_mapped, 'ok' AS reconciled FROM customer")
def gate_summary(spark, d):
    return reports.gate_summary(_table(spark, d, "customer"), F.col("c_custkey") % 5 == 0, F.col("c_custkey") % 3 > 0)


@query("SELECT (SELECT count(*) FROM customer) AS hotels_total, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 0) AS hotels_resolved, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 = 0) AS hotels_unavailable, (SELECT count(*) FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 > 0 AND c_custkey % 5 = 0) AS hotels_unanswered, (SELECT count(*) FROM customer WHERE c_custkey % 4 = 0) AS hotels_matched, (SELECT count(*) FROM customer WHERE c_custkey % 4 > 0 AND c_custkey % 7 > 0) AS hotels_no_match, (SELECT count(*) FROM customer WHERE c_custkey % 4 > 0 AND c_custkey % 7 = 0) AS hotels_unreachable, (SELECT sum(c_custkey % 3)::BIGINT FROM customer) AS gaps, (SELECT sum(c_custkey % 2)::BIGINT FROM customer) AS gaps_filled, (SELECT count(*) FROM customer WHERE c_custkey % 3 > 0 AND c_custkey % 2 >= c_custkey % 3) AS hotels_gaps_closed, (SELECT count(*) FROM k) AS rooms_total, (SELECT count(*) FROM k WHERE action = 'insert') AS published_insert, (SELECT count(*) FROM k WHERE action = 'fill') AS published_fill, (SELECT count(*) FROM k WHERE n_images > 0) AS rooms_with_images".replace("SELECT (SELECT", _ACT + " SELECT (SELECT", 1))
def run_counters(spark, d):
    h = _table(spark, d, "customer").selectExpr("c_custkey % 2 = 0 AS resolved", "c_custkey % 3 = 0 AS unavailable", "c_custkey % 5 = 0 AS errored", "c_custkey % 4 = 0 AS matched", "c_custkey % 7 > 0 AS reachable", "false AS blind", "false AS requeued", "c_custkey % 3 AS n_gaps", "c_custkey % 2 AS n_filled")
    r = _acted(spark, d).withColumn("status", F.lit("publish"))
    return reports.run_counters(h, r).select("hotels_total", "hotels_resolved", "hotels_unavailable", "hotels_unanswered", "hotels_matched", "hotels_no_match", "hotels_unreachable", "gaps", "gaps_filled", "hotels_gaps_closed", "rooms_total", "published_insert", "published_fill", "rooms_with_images")


def _filling(spark, d):
    """Rooms of the catalogue as gaps, offers of six shapes, and a verified counterpart for most hotels."""
    gaps, o = view(spark, d, "room_a"), view(spark, d, "offer")
    urls = F.when(F.col("n_images") > 0, F.transform(F.sequence(F.lit(1), F.col("n_images")), lambda k: F.concat(F.col("b_id").cast("string"), F.lit("/"), k.cast("string")))).otherwise(F.array().cast("array<string>"))
    hotels = gaps.select("hotel_id").union(o.select("hotel_id")).distinct()
    verified = hotels.filter("hotel_id % 5 > 0").select("hotel_id", F.concat(F.lit("h-"), F.col("hotel_id").cast("string")).alias("slug"))
    return harvest.fill_gaps(gaps, verified, o.withColumn("images", urls), hotels, 2)


@query()
def third_source_fill(spark, d):
    return _filling(spark, d)[0].select("hotel_id", "a_id", "filled", F.array_join("images", ",").alias("images"))


@query()
def third_source_notes(spark, d):
    return _filling(spark, d)[1]
