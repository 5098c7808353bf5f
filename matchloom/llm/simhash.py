"""SimHash near-duplicate grouping with a segment-popcount grid.

Fingerprints are 64 bits over word shingles. Cut into 16 segments of four bits, a fingerprint becomes the
vector of its segments' bit counts; the Manhattan distance of two such vectors never exceeds the Hamming
distance of the fingerprints. Two vectors at distance 2 or less have a grid cell within distance 1 of
both, so each fingerprint goes to its own cell and the (at most 32) neighbouring ones, and fingerprints
that meet in no cell cannot link. What meets is verified exactly: two fingerprints differ in at most two
bits if and only if some value differs from each of them in at most one bit, and that value's bit counts
are those of a cell where they meet. At most 65 fingerprints share such a value, so no group grows with
the data and pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, persisted
from .components import connected_components
from .secrets import _arrow_type

SEED = 42
LOWER = bytes(i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))
#: For each byte value, its bits as eight counters of eight bits.
SPREAD = np.array([sum((b >> j & 1) << 8 * j for j in range(8)) for b in range(256)], np.uint64)


def shingle_hashes(text: str | None, size: int) -> list[int]:
    """XXH64 of the word shingles, repeats included; fewer words than ``size`` make one shingle."""
    words = (text or "").encode("utf-8", "replace").translate(LOWER).split()
    if not words:
        return []
    line, xxh = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= size:
        return [xxh(line, SEED)]
    starts, ends, at = [], [], 0
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    return [xxh(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :], strict=False)]


def fingerprint(text: str | None, size: int = 3) -> int:
    """A bit is 1 if it is set in over half of the shingle hashes; 0 without words. Signed, as Spark's longs are."""
    hashes = shingle_hashes(text, size)
    if not hashes:
        return 0
    h = np.array(hashes, np.uint64)
    lanes = SPREAD[h.view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, np.arange(0, len(h), 255), axis=0)  # 255 is the most that a lane holds
    counts = np.ascontiguousarray(sums).view(np.uint8).reshape(len(sums), 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """(doc_id, fp) for each row."""

    def rows(ids: list, texts: list) -> list:
        return [ids, [fingerprint(t, size) for t in texts]]

    fields = [pa.field("doc_id", _arrow_type(docs, id_col)), pa.field("fp", pa.int64())]
    return map_rows(docs.select(id_col, text_col), rows, fields, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fp long")


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x)


def bit_counts(fp: Column) -> Column:
    """The bit counts of the 16 segments, each in its four bits of a long (halves apart, so that nothing overflows)."""

    def half(x: Column) -> Column:
        pairs = x.bitwiseAND(F.lit(0x55555555)) + F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(0x55555555))
        return pairs.bitwiseAND(F.lit(0x33333333)) + F.shiftrightunsigned(pairs, 2).bitwiseAND(F.lit(0x33333333))

    low = half(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.shiftleft(half(F.shiftrightunsigned(fp, 32)), 32).bitwiseOR(low)


def _cells(fp: Column, cell: Column) -> Column:
    """Cells within Manhattan distance 1, each with the values at one bit or less from ``fp`` that lie in it."""

    def flipped(i: int, up: bool) -> Column:
        bits = [_long(1 << j) for j in range(4 * i, 4 * i + 4)]
        is_set = [fp.bitwiseAND(b) != 0 for b in bits]
        return F.array_compact(F.array(*[F.when(~s if up else s, fp.bitwiseXOR(b)) for s, b in zip(is_set, bits, strict=True)]))

    out = [F.struct(cell.alias("cell"), F.array(fp).alias("near"))]
    for i in range(16):
        count = F.shiftrightunsigned(cell, 4 * i).bitwiseAND(F.lit(15))
        step = F.lit(1 << 4 * i)
        out.append(F.when(count < 4, F.struct((cell + step).alias("cell"), flipped(i, True).alias("near"))))
        out.append(F.when(count > 0, F.struct((cell - step).alias("cell"), flipped(i, False).alias("near"))))
    return F.array_compact(F.array(*out))


def links(distinct: DataFrame) -> DataFrame:
    """(fp, least) edges that connect exactly the fingerprints at two or fewer differing bits.

    ``distinct`` has each fingerprint once, in ``fp``.
    """
    # what is stored may come back in a few parts, and each fingerprint goes to 33 cells
    parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = distinct.repartition(parts, "fp").select("fp", bit_counts(F.col("fp")).alias("cell"))
    met = placed.select("fp", F.explode(_cells(F.col("fp"), F.col("cell"))).alias("c")).select("fp", "c.cell", "c.near")
    shared = met.select("cell", "fp").groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter("lo <> hi").select("cell")
    values = met.join(shared, "cell", "left_semi").select("fp", F.explode("near").alias("value"))
    groups = values.groupBy("value").agg(F.collect_set("fp").alias("fps")).filter(F.size("fps") > 1)  # 65 at most
    return groups.select(F.explode("fps").alias("fp"), F.array_min("fps").alias("least")).filter("fp <> least").distinct()


def group(marked: DataFrame, id_col: str = "doc_id", link: Callable[[DataFrame], DataFrame] = links) -> DataFrame:
    """``marked`` (id and fp) with ``component_id``, the least id that links lead to; equal fingerprints are linked."""
    by_fp = persisted(marked.groupBy("fp").agg(F.min(id_col).alias("first"), F.count("*").alias("n")), "fingerprints")
    parts = connected_components(link(by_fp.select("fp")), "fp", "least")
    rooted = by_fp.join(parts.withColumnRenamed("node", "fp"), "fp")
    roots = rooted.groupBy("root").agg(F.min("first").alias("component"))
    linked = rooted.join(roots, "root").select("fp", "component")
    copies = by_fp.filter("n > 1").join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("first").alias("component"))
    return marked.join(linked.unionByName(copies), "fp", "left").withColumn("component_id", F.coalesce("component", id_col)).drop("component")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """One row per input row: doc_id, fingerprint in hex, component_id.

    Null, empty and blank texts have fingerprint zero and are linked like any other. Repeated rows are each
    answered, with the same component. A row without id belongs to a component but never names one (its
    component_id is null if no row of the component has an id). An empty table gives an empty result.
    """
    marked = persisted(fingerprints(docs, id_col, text_col, size), "fingerprints")
    return group(marked).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``docs`` with one row of each component: that of the least id.

    Rows that share an id stand or fall together. Rows without id stay; columns are unchanged.
    """
    found = near_duplicates(docs, id_col, text_col, size)
    gone = found.filter(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
