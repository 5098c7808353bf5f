"""Stand-ins for catalogue, rooms, probes and ledgers, derived from the driver's tables.

Each view is one text that Spark and DuckDB both understand; ``{part}`` and the like are the base tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..session import spread


def _div(k: str, n: int) -> str:
    return f"CAST(floor({k} / {n}) AS BIGINT)"


_GROUP = "CAST(CAST(replace(p_brand, 'Brand#', '') AS BIGINT) * 100 + p_size AS BIGINT)"
_BED = f"CASE {_div('p_partkey', 4)} % 5 WHEN 0 THEN 'King' WHEN 1 THEN 'Queen' WHEN 2 THEN 'Twin' WHEN 3 THEN 'Double' ELSE '2 Bedroom' END"
_CLASS = f"CASE {_div('p_partkey', 2)} % 4 WHEN 0 THEN 'Room' WHEN 1 THEN 'Suite' WHEN 2 THEN 'Room Sea View' ELSE 'Studio' END"
_ACCESS = f"CASE {_div('p_partkey', 2)} % 9 WHEN 0 THEN ' wheelchair access' WHEN 1 THEN ' Club Lounge Access' WHEN 2 THEN ' accessible' WHEN 3 THEN ' Élite' ELSE '' END"
_NOISE = f"CASE {_div('p_partkey', 2)} % 3 WHEN 0 THEN ' (Package Rate)' WHEN 1 THEN ' [' || p_name || ' RO]' ELSE '' END"
_ROOM = f"p_type || ' ' || {_BED} || ' ' || p_name || ' ' || {_CLASS} || {_ACCESS}"

VIEWS = {
    "hotel": "SELECT s_suppkey AS id, lower(replace(s_name, '#', '-')) AS slug, CASE s_suppkey % 7 WHEN 1 THEN 'Hôtel ' || s_name WHEN 2 THEN s_name || ' (formerly Palm)' WHEN 3 THEN '酒店 ' || s_name ELSE s_name END AS name, CASE WHEN s_suppkey % 11 <> 5 THEN s_nationkey END AS city_id, CASE s_suppkey % 3 WHEN 0 THEN 'Dubai' WHEN 1 THEN 'Abu Dhabi' END AS city_name, CAST(25.0 + (s_suppkey % 97) * 0.001 AS DOUBLE) AS lat, CAST(55.0 + (s_suppkey % 89) * 0.001 AS DOUBLE) AS lon FROM {supplier}",
    "city": "SELECT n_nationkey AS id, n_name AS name_en, n_regionkey AS country_id, CAST(CASE WHEN n_nationkey % 11 = 10 THEN 1 END AS INT) AS deleted_at FROM {nation}",
    "country": "SELECT r_regionkey AS country_id, r_name AS country FROM {region}",
    "offer": f"SELECT {_GROUP} AS hotel_id, CAST(p_partkey % 6 AS INT) AS shape, {_div('p_partkey', 2)} AS b_id, {_ROOM} AS room_name, CAST(p_partkey % 3 AS INT) AS n_images FROM {{part}}",
    "stage_probe": "SELECT CAST(floor(event_id / 12) AS BIGINT) AS hotel_id, CASE WHEN event_id % 12 < 6 THEN 'base' ELSE 'wider' END AS phase, CAST(event_id % 6 AS INT) AS seq, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'unavailable' ELSE 'ok' END AS outcome, event_type || CAST(event_id % 5 AS STRING) AS room_name, event_id, event_type = 'view' AND event_id % 3 = 0 AS has_room FROM {events}",
    "room_a": f"SELECT {_GROUP} AS hotel_id, p_partkey AS a_id, {_ROOM} AS room_name FROM {{part}} WHERE p_partkey % 2 = 0",
    "room_b": f"SELECT {_GROUP} AS hotel_id, p_partkey AS b_id, {_ROOM} || {_NOISE} AS room_name, {_div('p_partkey', 8)} % 4 AS n_images FROM {{part}} WHERE p_partkey % 2 = 1",
    "room": f"SELECT p_partkey AS id, 1 + p_partkey % 50 AS hotel_id, p_name || ' ' || CAST(p_size AS STRING) AS name, CAST(CASE p_partkey % 3 WHEN 0 THEN 'http://img/' || CAST(p_partkey AS STRING) WHEN 2 THEN '' END AS STRING) AS thumbnail, CAST(CASE WHEN p_partkey % 4 = 0 THEN 100 + p_size END AS INT) AS size_sqft, CAST(CASE WHEN p_partkey % 5 > 0 THEN p_partkey % 25 END AS BIGINT) AS category_id FROM {{part}} WHERE p_partkey % 7 < 5",
    "incoming": f"SELECT 1 + p_partkey % 50 AS hotel_id, p_partkey AS seq, p_name || ' ' || CAST(p_size AS STRING) AS room_name, CAST(CASE WHEN p_partkey % 2 = 0 THEN 'http://new/' || CAST(p_partkey AS STRING) END AS STRING) AS thumbnail, CAST(CASE WHEN p_partkey % 3 = 0 THEN 200 + p_size END AS INT) AS size_sqft, CAST(p_partkey % 25 AS BIGINT) AS category_id, {_div('p_partkey', 8)} % 4 AS n_images FROM {{part}} WHERE p_partkey % 7 > 1",
    "observation": "SELECT l_suppkey AS hotel_id, l_partkey % 40 AS room_no, l_linenumber AS shape, l_orderkey AS seq, l_quantity AS richness, l_returnflag AS flag FROM {lineitem}",
    "probe": "SELECT user_id AS hotel_id, CAST(event_id % 12 AS INT) AS shape, event_type, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'unavailable' ELSE 'ok' END AS outcome, CASE WHEN event_type IN ('error', 'signup') THEN 0 ELSE CAST(floor(value) AS BIGINT) % 4 END AS n_rooms, event_id FROM {events}",
    "log": "SELECT user_id AS hotel_id, CASE WHEN event_type = 'purchase' THEN 'resolved' ELSE event_type END AS reason, ts AS happened, event_id AS row_id FROM {events}",
    "candidate": "SELECT s_suppkey AS hotel_id, c_custkey AS cand_id, CASE WHEN s_suppkey % 5 = 4 THEN s_name || ' Tower Residences' WHEN s_suppkey % 10 = 3 THEN s_name || ' Unit ' || CAST(c_custkey % 9 AS STRING) WHEN c_custkey % 4 = 0 THEN s_name WHEN c_custkey % 4 = 1 THEN s_name || CASE WHEN c_custkey % 8 = 1 THEN ' Dubai' ELSE ' Abu Dhabi' END WHEN c_custkey % 4 = 2 THEN 'The ' || c_mktsegment || ' ' || s_name ELSE c_name END AS cand_name, CASE WHEN s_suppkey % 5 = 4 OR c_custkey % 5 = 0 THEN -1 ELSE c_nationkey END AS cand_city, CASE WHEN s_suppkey % 5 = 4 THEN CAST(27.0 + (c_custkey % 13) * 0.0007 AS DOUBLE) WHEN c_custkey % 6 > 0 THEN CAST(25.0 + (s_suppkey % 97) * 0.001 + (c_custkey % 13) * 0.0007 AS DOUBLE) END AS cand_lat, CASE WHEN s_suppkey % 5 = 4 OR c_custkey % 6 > 0 THEN CAST(55.0 + (s_suppkey % 89) * 0.001 AS DOUBLE) END AS cand_lon, s_suppkey % 10 = 3 OR c_custkey % 7 = 0 AS is_private, CAST(c_custkey % 3 AS INT) AS variant FROM {supplier} JOIN {customer} ON s_nationkey = c_nationkey",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in set(re.findall(r"\{(\w+)\}", text))}
    if name == "candidate":  # each customer meets many suppliers, and the file may be one task's
        tables["customer"] = spread(tables["customer"], "c_custkey")
    return spark.sql(text, **tables)


def cte(*names: str) -> str:
    """A WITH clause of the views, for DuckDB."""
    return "WITH " + ", ".join(f"{n} AS ({re.sub(r'{(\w+)}', r'\1', VIEWS[n])})" for n in names) + " "
