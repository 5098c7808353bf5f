"""Benchmark decontamination, in DataFrame functions only.

Documents and benchmark items are hashed word shingle by word shingle. Windows of a document are as long as an item
that it shares one of the item's rarest shingles with, and stand where these would lie over each other: to reach
``least``, a window must hold one of the rarest n - ceil(least * n) + 1 shingles of an item of n. Windows and items get
SimHash fingerprints, and a multi-index tells which items of the window's length are within ``radius`` bits. It has four
blocks of sixteen bits. Of two fingerprints that differ in at most ``radius`` bits, some block differs in at most a
quarter of these; items, which are few, stand in the index with all neighbours of their blocks that near, and a window
looks up its four blocks, so none within the radius is missed. Equal windows are looked up once.

Only what the index returns is verified, by the exact weighted similarity of the shingles (weights are their
multiplicities), in all windows of the document at once: the k-th place of a shingle that an item has c times adds to
the windows that hold it but not the place c before it. These are intervals of starts, and a running sum over their ends
gives the shared shingles of each window in time linear in the document.

At a similarity of 0.8 the mean distance is about 9 of 64 bits with a deviation of 3, so the radius holds all but the
outermost; it has to be that wide, as no radius holds all.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, persisted

#: Windows of a document that are fingerprinted for each length of one item.
STEPS = 32
#: Bits of a block of the multi-index, and bits that fingerprints of a candidate may differ in.
BLOCK, RADIUS = 16, 19


def hashed(df: DataFrame, id_col: str, text_col: str, size: int, id_name: str) -> DataFrame:
    """(id, hashes of the word shingles); words are runs of letters and digits in lower case.

    Null texts and texts of fewer than ``size`` words have no shingle. The words are bound to a lambda's variable:
    a column of their own would be merged into the expression below and worked out again for each shingle.
    """
    words = F.transform(F.split(F.trim(F.regexp_replace(F.lower(text_col), r"[^\p{L}\p{N}]+", " ")), " "), lambda w: F.xxhash64(w))

    def grams(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - size)
        return F.when(F.size(w) >= size, F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])))

    return df.select(F.col(id_col).alias(id_name), F.get(F.transform(F.array(words), grams), 0).alias("shingles"))


def fingerprint(hashes: Column) -> Column:
    """A bit is 1 if it is set in over half of the hashes."""

    def voted(j: int) -> Column:
        bit = F.lit((1 << j) - (1 << 64 if j == 63 else 0))
        ones = F.size(F.filter(hashes, lambda x: x.bitwiseAND(bit) != 0))
        return F.when(2 * ones > F.size(hashes), bit).otherwise(F.lit(0).cast("long"))

    return reduce(Column.bitwiseOR, map(voted, range(64)))


def blocks(fp: Column) -> Column:
    """The fingerprint in blocks of bits, as (block, value)."""
    return F.array(*[F.struct(F.lit(k).alias("block"), F.shiftrightunsigned(fp, BLOCK * k).bitwiseAND(F.lit((1 << BLOCK) - 1)).alias("value")) for k in range(64 // BLOCK)])


def neighbours(value: Column, most: int) -> Column:
    """All values of a block that differ from ``value`` in at most ``most`` bits."""
    # a constant, worked out once when the query is planned
    masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BLOCK) - 1)), lambda m: F.bit_count(m) <= most)
    return F.transform(masks, lambda m: value.bitwiseXOR(m.cast("long")))


KEY = ("doc_id", "tk")


def same_text(df: DataFrame, other: DataFrame) -> Column:
    return reduce(Column.__and__, [df[c].eqNullSafe(other[c]) for c in KEY])


def windows(texts: DataFrame, meetings: DataFrame) -> DataFrame:
    """(doc_id, tk, n, fp): fingerprints of windows as long as the items met, where these would lie.

    Of the windows that begin within a ``STEPS``-th of their length the first is taken, so that the work is linear in the
    document.
    """
    start = F.least(F.greatest(F.col("pos") - F.col("at"), F.lit(0)), F.greatest(F.col("size") - F.col("n"), F.lit(0)))
    placed = meetings.withColumn("start", start).groupBy(*KEY, "n", F.floor(F.col("start") * STEPS / F.col("n")).alias("step")).agg(F.min("start").alias("start"))
    t = texts.alias("t")
    return placed.join(t, same_text(placed, texts)).select(placed["doc_id"], placed["tk"], "n", fingerprint(F.slice("t.shingles", F.col("start") + 1, F.col("n"))).alias("fp"))


def multi_index(bench: DataFrame, radius: int) -> DataFrame:
    """(n, block, value, item_id, item_fp): items under every value of a block that a fingerprint within ``radius`` may have."""
    marked = bench.select("item_id", "n", fingerprint(F.col("item_shingles")).alias("item_fp"))
    by_block = marked.select("item_id", "n", "item_fp", F.explode(blocks(F.col("item_fp"))).alias("b"))
    return by_block.select("item_id", "n", "item_fp", "b.block", F.explode(neighbours(F.col("b.value"), radius // (64 // BLOCK))).alias("value"))


def near_items(marked: DataFrame, index: DataFrame, radius: int) -> DataFrame:
    """(doc_id, tk, item_id): items within ``radius`` bits of some window (doc_id, tk, n, fp) of their length."""
    asked = marked.select("n", "fp").distinct()
    met = asked.select("n", "fp", F.explode(blocks(F.col("fp"))).alias("b")).select("n", "fp", "b.block", "b.value").join(index, ["n", "block", "value"])
    found = met.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select("n", "fp", "item_id").distinct()
    return marked.join(found, ["n", "fp"]).select(*KEY, "item_id").distinct()


def find_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 5, least: float = 0.8, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, start_word, similarity): for each document and item that it holds, the best window.

    A document holds an item if some window of the item's length reaches the similarity ``least`` and the index returns it:
    fingerprints of item and window differ in at most ``radius`` bits. Ties go to the first window. A document shorter than the item is one window. Null texts, and texts and items with fewer than
    ``size`` words, hold and are nothing; empty tables give an empty result. Rows that share an id are searched each,
    and answered once.
    """
    hashed_items = hashed(items, item_col, item_text, size, "item_id").filter("shingles IS NOT NULL")
    bench = persisted(hashed_items.select("item_id", F.col("shingles").alias("item_shingles"), F.size("shingles").alias("n")), "items")
    places = bench.select("item_id", "n", F.posexplode("item_shingles").alias("at", "h"))
    counted = places.groupBy("item_id", "n", "h").agg(F.count("*").alias("c"), F.min("at").alias("at"))
    rarity = counted.groupBy("h").agg(F.count("*").alias("items"))
    of_item = persisted(counted.join(rarity, "h"), "shingles")
    by_rarity = Window.partitionBy("item_id").orderBy("items", "h").rowsBetween(Window.unboundedPreceding, -1)
    spare = F.col("n") - F.ceil(F.col("n") * F.lit(least) - 1e-6) + 1
    anchors = of_item.withColumn("before", F.coalesce(F.sum("c").over(by_rarity), F.lit(0))).filter(F.col("before") < spare).select("h", "item_id", "n", "at")

    def shingled(rows: DataFrame) -> DataFrame:
        with_key = rows.select(F.col(id_col).alias("doc_id"), F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tk"), F.col(text_col).alias("text"))
        found = hashed(with_key.select(F.struct(*KEY).alias("k"), "text"), "k", "text", size, "k")
        return found.filter("shingles IS NOT NULL").select("k.doc_id", "k.tk", "shingles")

    # only keys, places and hashes are exploded
    exploded = shingled(docs).select(*KEY, F.size("shingles").alias("size"), F.posexplode("shingles").alias("pos", "h"))
    meetings = persisted(exploded.join(broadcast_if_small(anchors), "h").select(*KEY, "item_id", "n", "size", "pos", "at"), "meetings")
    # a document that met nothing is not looked at again
    wanted = broadcast_if_small(persisted(meetings.select(F.col("doc_id").alias("_met")).distinct(), "met"))
    texts = persisted(shingled(docs.join(wanted, docs[id_col].eqNullSafe(wanted["_met"]), "left_semi")).dropDuplicates([*KEY]), "texts")
    marked = persisted(windows(texts, meetings), "windows")
    candidates = persisted(near_items(marked, persisted(multi_index(bench, radius), "multi-index"), radius), "candidates")
    best = best_windows(texts, candidates, of_item)
    found = best.filter(F.col("similarity") >= least).groupBy("doc_id", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "start")).alias("m"))
    return found.select("doc_id", "item_id", F.col("m.start").cast("long").alias("start_word"), (-F.col("m.s")).alias("similarity"))


def best_windows(texts: DataFrame, candidates: DataFrame, of_item: DataFrame) -> DataFrame:
    """(doc_id, tk, item_id, start, similarity): the first of the most similar windows of each candidate."""
    held = texts.join(candidates.select(*[F.col(c).alias(f"_{c}") for c in KEY], "item_id"), reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in KEY]))
    exploded = held.select(*KEY, "item_id", F.size("shingles").alias("size"), F.posexplode("shingles").alias("pos", "h"))
    shared = exploded.join(broadcast_if_small(of_item.select("item_id", "h", "n", "c")), ["item_id", "h"])
    pair = [*KEY, "item_id", "n", "size"]
    rows = shared.groupBy(*pair, "h", "c").agg(F.array_sort(F.collect_list("pos")).alias("p"))
    span = F.least("n", "size")
    # the place c before: a window that holds it too has the item's share of this shingle already
    each = rows.select(*pair, "p", "c", F.posexplode("p").alias("i", "pos"))
    low = F.greatest(F.coalesce(F.get("p", F.col("i") - F.col("c").cast("int")) + 1, F.lit(0)), F.col("pos") - span + 1, F.lit(0))
    steps = each.select(*pair, low.alias("low"), "pos").select(*pair, F.explode(F.array(F.struct(F.col("low").alias("start"), F.lit(1).alias("d")), F.struct((F.col("pos") + 1).alias("start"), F.lit(-1).alias("d")))).alias("e"))
    ends = steps.groupBy(*pair, "e.start").agg(F.sum("e.d").alias("d"))
    running = ends.withColumn("o", F.sum("d").over(Window.partitionBy(*pair).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)))
    best = running.filter(F.col("start") <= F.col("size") - span).groupBy(*pair).agg(F.max(F.struct("o", (-F.col("start")).alias("s"))).alias("m"))
    return best.select(*KEY, "item_id", (-F.col("m.s")).alias("start"), (F.col("m.o") / (F.col("n") + span - F.col("m.o"))).alias("similarity"))


def without_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose document holds an item; columns are unchanged."""
    leaks = find_leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("_leaked")).distinct()
    found = broadcast_if_small(persisted(leaks, "leaks"))
    return docs.join(found, docs[id_col].eqNullSafe(found["_leaked"]), "left_anti")


ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL
), d AS (SELECT doc_id, w, len(w) - 4 AS size FROM texts WHERE len(w) >= 5),
b AS (
  SELECT item_id, w, len(w) - 4 AS n FROM (
    SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') AS w FROM benchmark WHERE text IS NOT NULL)
  WHERE len(w) >= 5
), dg AS (SELECT doc_id, size, i AS pos, array_to_string(w[i + 1 : i + 5], ' ') AS h FROM d, LATERAL (SELECT unnest(range(size)) AS i)),
bg AS (SELECT item_id, n, h, count(*) AS c FROM (SELECT item_id, n, array_to_string(w[i + 1 : i + 5], ' ') AS h FROM b, LATERAL (SELECT unnest(range(n)) AS i)) GROUP BY ALL),
hits AS (SELECT doc_id, item_id, n, size, c, h, pos FROM dg JOIN bg USING (h)),
enough AS (
  SELECT doc_id, item_id FROM (SELECT doc_id, item_id, n, h, least(count(*), any_value(c)) AS most FROM hits GROUP BY ALL)
  GROUP BY doc_id, item_id, n HAVING 5 * sum(most) >= 4 * n
), starts AS (
  SELECT DISTINCT doc_id, item_id, n, size, s
  FROM (SELECT hits.*, unnest(range(greatest(pos - least(n, size) + 1, 0), least(pos, size - least(n, size)) + 1)) AS s FROM hits JOIN enough USING (doc_id, item_id))
), per_shingle AS (
  SELECT s.doc_id, s.item_id, s.n, s.size, s.s, x.h, least(count(*), any_value(x.c)) AS o
  FROM starts s JOIN hits x ON x.doc_id = s.doc_id AND x.item_id = s.item_id AND x.pos BETWEEN s.s AND s.s + least(s.n, s.size) - 1 GROUP BY ALL
), per_start AS (SELECT doc_id, item_id, s, sum(o) / (any_value(n) + least(any_value(n), any_value(size)) - sum(o)) AS similarity FROM per_shingle GROUP BY doc_id, item_id, s)
SELECT doc_id, item_id, s::BIGINT AS start_word, similarity FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) AS nth FROM per_start WHERE similarity >= 0.8) WHERE nth = 1
"""
