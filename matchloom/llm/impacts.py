"""Ranked lexical search over a bit-sliced impact index.

The documents of a task are gathered into blocks of bounded size, each one row of a table in the shared folder. What a
term gives a document before the term's weight, its impact, is a whole number below 2**20; a block keeps a term's
impacts as twenty bitmaps, one for each bit, over the documents that hold the term. A search spreads the bitmaps of the
asked terms over the block's documents, as 64-bit words of which only those with a bit are kept, multiplies them by the
terms' weights (shifted copies, added with carries) and adds those of an item in pairs, level by level, until each item
has the bits of its scores. Each step is a handful of AND, OR and XOR over whole arrays; no document is scored on its
own. The best k of a block come from the slices, the most significant first; blocks are merged exactly, since impacts
and weights use counts of all documents.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bm25 import _ids, _ranges, words
from .common import persisted
from .secrets import _arrow_type

#: Bits of an impact; an impact is below 10**6.
BITS = 20
#: Documents of a block, at most; words of bitmaps that are worked on at a time.
BLOCK, AT_ONCE = 32_768, 60_000
FIELDS = "ids binary, terms binary, ends binary, docs binary, slices binary"


@dataclass(frozen=True)
class ImpactIndex:
    """``blocks`` (a table), the number of documents that have a term, and the length of all documents."""

    blocks: DataFrame
    documents: int
    length: int
    id_col: str


def collection(docs: DataFrame, text_col: str) -> tuple[int, int]:
    """Documents that have a term, and their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(words(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([sum(s > 0 for s in sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())], ["n", "w"])

    row = docs.select(text_col).mapInArrow(run, "n long, w long").agg(F.sum("n"), F.sum("w")).first()
    return row[0] or 0, row[1] or 0


def impacts_of(tf: np.ndarray, n: np.ndarray, documents: int, length: int) -> np.ndarray:
    """The impact of terms that occur ``tf`` times in documents of ``n`` terms, in 64-bit integers."""
    m = 100 - 50 + (50 * n * documents) // max(1, length)
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK, block_postings: int = 1_500_000) -> ImpactIndex:
    """Index every row of ``docs``, without a shuffle; a null text has no terms.

    A block ends at ``block_docs`` documents (at most 65,536) or ``block_postings`` postings; its documents are ordered by id, nulls last.
    """
    documents, length = collection(docs, text_col)
    id_type = _arrow_type(docs, id_col)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, number, terms, tfs, held = [], [], {}, [], [], 0

        def block() -> pa.RecordBatch:
            by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
            place = np.empty(len(ids), np.int64)
            place[by_id] = np.arange(len(ids))
            names = sorted(number)
            rank = np.empty(len(names), np.int64)
            rank[[number[t] for t in names]] = np.arange(len(names))
            counts = np.array([len(t) for t in terms], np.int64)
            term = rank[np.concatenate([*terms, np.zeros(0, np.int32)])]
            doc = np.repeat(place, counts)
            order = np.lexsort((doc, term))
            found = impacts_of(np.concatenate([*tfs, np.zeros(0, np.int64)]), np.repeat(np.array(sizes, np.int64), counts), documents, length)[order]
            slices = b"".join(np.packbits(((found >> s) & 1).astype(bool), bitorder="little").tobytes() for s in range(BITS))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([pa.field("id", id_type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([pa.array([ids[i] for i in by_id], id_type)], ["id"]))
            ends = np.cumsum(np.bincount(term, minlength=len(names))).astype(np.int64)
            values = (sink.getvalue().to_pybytes(), b" ".join(names), ends.tobytes(), doc[order].astype(np.uint16).tobytes(), slices)
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], [f.split()[0] for f in FIELDS.split(", ")])

        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1), strict=True):
                count = Counter(words(text.as_py()))
                ids.append(i.as_py())
                sizes.append(count.total())
                terms.append(np.fromiter((number.setdefault(t, len(number)) for t in count), np.int32, len(count)))
                tfs.append(np.fromiter(count.values(), np.int64, len(count)))
                held += len(count)
                if held >= block_postings or len(ids) >= block_docs:
                    yield block()
                    ids, sizes, number, terms, tfs, held = [], [], {}, [], [], 0
        if ids:
            yield block()

    rows = docs.select(id_col, text_col)
    return ImpactIndex(persisted(rows.mapInArrow(build, FIELDS), "impact-index"), documents, length, rows.schema[id_col].dataType.simpleString())


def add(a: np.ndarray, b: np.ndarray, shift: int = 0) -> None:
    """Add the numbers of ``b``, times 2**shift, to those of ``a``; both hold a number's bits in the rows of a column."""
    carry = np.zeros_like(a[0])
    for s in range(shift, len(a)):
        if s - shift < len(b):
            x = b[s - shift]
            both = a[s] ^ x
            kept = (a[s] & x) | (carry & both)
            a[s] = both ^ carry
        else:
            kept = carry & a[s]
            a[s] ^= carry
        carry = kept
        if s - shift >= len(b) and not carry.any():
            return


def added_up(keys: np.ndarray, slices: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Add the columns of equal keys (which are sorted) in pairs, until each key has one column."""
    while True:
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        if len(first) == len(keys):
            return keys, slices
        size = np.diff(np.append(first, len(keys)))
        rank = np.arange(len(keys)) - np.repeat(first, size)
        stays = rank % 2 == 0
        left = slices[:, stays]
        pairs = np.flatnonzero(stays & (rank + 1 < np.repeat(size, size)))
        of = (np.cumsum(stays) - 1)[pairs]
        some = left[:, of]
        add(some, slices[:, pairs + 1])
        left[:, of] = some
        keys, slices = keys[stays], left


def best(slices: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(column, bit, score) of the k highest numbers above 0 of each stretch of columns; of equal ones, those that come first.

    From the most significant slice down: those with the bit are all in, if they are not too many with those that are in
    already; else only they can be.
    """
    size = np.diff(np.append(starts, slices.shape[1]))
    open_, taken = np.bitwise_or.reduce(slices, axis=0), np.zeros_like(slices[0])
    for s in range(len(slices) - 1, -1, -1):
        have = open_ & slices[s]
        count = np.add.reduceat(np.bitwise_count(taken | have).astype(np.int64), starts)
        many = np.repeat(count > k, size)
        open_ = np.where(many, have, open_ & ~slices[s])
        taken = np.where(many, taken, taken | have)
        open_[np.repeat(count == k, size)] = 0
    column, bit = _places(taken)
    segment = np.repeat(np.arange(len(starts)), size)
    room = k - np.bincount(segment[column], minlength=len(starts))
    more, more_bit = _places(open_)
    of = segment[more]
    rank = np.arange(len(of)) - np.searchsorted(of, of)
    ties = rank < room[of]
    column, bit = np.concatenate([column, more[ties]]), np.concatenate([bit, more_bit[ties]]).astype(np.uint64)
    score = np.zeros(len(column), np.uint64)
    for s in range(len(slices)):
        score |= ((slices[s, column] >> bit) & np.uint64(1)) << np.uint64(s)
    return column, bit, score.astype(np.int64)


def _places(bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, bit) of each bit that is set, ascending."""
    return np.nonzero(np.unpackbits(bitmap.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


class Block:
    """A block in memory, and the terms of it that are asked for."""

    def __init__(self, ids, terms, ends, docs, slices, asked: dict[bytes, int]):
        self.ids = _ids(ids)
        self.words = -(-max(1, len(self.ids)) // 64)
        names = terms.split(b" ") if terms else []
        local = [(asked[t], i) for i, t in enumerate(names) if t in asked]
        self.local = np.full(len(asked), -1)
        if local:
            self.local[[a for a, _ in local]] = [i for _, i in local]
        self.ends = np.frombuffer(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.docs = np.frombuffer(docs, np.uint16)
        self.slices = np.frombuffer(slices, np.uint8).reshape(BITS, -1)

    def bitmaps(self, local: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ends, word, slices): the impacts of terms, spread over the block's documents; the columns of each term up to its end."""
        at, n = _ranges(self.starts[local], self.ends[local])
        doc = self.docs[at].astype(np.int64)
        key = np.repeat(np.arange(len(local)), n) * self.words + (doc >> 6)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        bit = np.uint64(1) << (doc & 63).astype(np.uint64)
        byte, shift = at >> 3, (at & 7).astype(np.uint8)
        spread = np.stack([np.bitwise_or.reduceat(np.where((self.slices[s][byte] >> shift) & 1, bit, np.uint64(0)), first) for s in range(BITS)])
        term, word = np.divmod(key[first], self.words)
        return np.cumsum(np.bincount(term, minlength=len(local))), word, spread

    def top(self, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(item, place of the document, score) of the best of the block, some items at a time.

        ``items`` (ascending) and ``terms`` pair items with numbers of asked terms; ``weights`` is by that number.
        """
        here = self.local[terms] >= 0
        items, terms = items[here], terms[here]
        local = self.local[terms]
        cost = np.minimum(self.ends[local] - self.starts[local], self.words)
        heads = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]])) if len(items) else np.zeros(0, np.int64)
        reached, at = np.concatenate([[0], np.cumsum(cost)]), 0
        bounds = np.append(heads, len(items))
        while at < len(heads):
            # as many items as fit, one at least
            to = max(at + 1, int(np.searchsorted(reached[bounds], reached[bounds[at]] + AT_ONCE, side="right")) - 1)
            a, b = bounds[at], bounds[min(to, len(heads))]
            yield self._some(items[a:b], terms[a:b], weights, k)
            at = to

    def _some(self, items: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int):
        distinct, which = np.unique(terms, return_inverse=True)
        ends, word, spread = self.bitmaps(self.local[distinct])
        heads = np.flatnonzero(np.concatenate([[True], items[1:] != items[:-1]]))
        most = int(np.add.reduceat(weights[terms], heads).max()) * 10**6
        products = np.zeros((max(1, most.bit_length()), len(word)), np.uint64)
        weight = np.repeat(weights[distinct], np.diff(ends, prepend=0))
        for shift in range(int(weight.max()).bit_length()):
            mask = np.where((weight >> shift) & 1, np.uint64(2**64 - 1), np.uint64(0))
            add(products, spread & mask, shift)
        starts = np.concatenate([[0], ends[:-1]])
        at, n = _ranges(starts[which], ends[which])
        key = np.repeat(items, n) * self.words + word[at]
        order = np.argsort(key, kind="stable")
        keys, slices = added_up(key[order], products[:, at[order]])
        item, word = np.divmod(keys, self.words)
        first = np.flatnonzero(np.concatenate([[True], item[1:] != item[:-1]]))
        column, bit, score = best(slices, first, k)
        return item[column], word[column] * 64 + bit.astype(np.int64), score


def search(index: ImpactIndex, items: DataFrame, k: int = 50, id_col: str = "item_id", text_col: str = "text", batch_terms: int = 500_000) -> DataFrame:
    """(item_id, rank, doc_id, score): the k highest-scoring documents for each item, scores above 0 only, ties by ascending id.

    Rows of ``items`` with one id are one item with the terms of all; an item without terms of the collection, or of a null
    text, has no rows. Rows of equal document ids are documents of their own, null ids come last. Items are taken in batches
    of about ``batch_terms`` terms, which bounds what is broadcast; the index is read twice for each batch.
    """
    spark = items.sparkSession
    item_kind, item_type = items.schema[id_col].dataType.simpleString(), _arrow_type(items, id_col)
    doc_type = _arrow_type(spark.createDataFrame([], f"id {index.id_col}"), "id")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(words(t.as_py()))) for t in batch.column(1)]
            take = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array([t for x in found for t in x], pa.binary())], schema=pa.schema([pa.field("item_id", item_type), pa.field("term", pa.binary())]))

    table = persisted(items.select(id_col, text_col).mapInArrow(split, f"item_id {item_kind}, term binary").distinct(), "items")
    batches = max(1, -(-table.count() // batch_terms))
    parts = None
    for b in range(batches):
        found = _batch(index, table.filter(F.pmod(F.xxhash64("item_id"), F.lit(batches)) == b).toArrow(), k, item_kind, item_type, doc_type)
        found = found if batches == 1 else persisted(found, "ranked")
        parts = found if parts is None else parts.unionByName(found)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _batch(index: ImpactIndex, rows: pa.Table, k: int, item_kind: str, item_type: pa.DataType, doc_type: pa.DataType) -> DataFrame:
    spark = index.blocks.sparkSession
    names = rows.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
    item = np.asarray(names.indices, np.int64) if len(rows) else np.zeros(0, np.int64)
    terms = rows.column("term").to_pylist()
    asked = {t: i for i, t in enumerate(sorted(set(terms)))}
    order = np.argsort(item, kind="stable")
    item, term = item[order], np.array([asked[t] for t in terms], np.int64)[order]
    wanted = spark.sparkContext.broadcast(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted.value), np.int64)
        for batch in batches:
            for names, ends in zip(batch.column(0), batch.column(1), strict=True):
                n = np.diff(np.frombuffer(ends.as_buffer(), np.int64), prepend=0)
                for i, t in enumerate(names.as_py().split(b" ") if n.size else []):
                    if t in wanted.value:
                        total[wanted.value[t]] += n[i]
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["term", "df"])

    df = np.zeros(len(asked), np.int64)
    for r in index.blocks.select("terms", "ends").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        df[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * index.documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    held = spark.sparkContext.broadcast((item, term, weights, names.dictionary))
    schema = pa.schema([pa.field("item_id", item_type), pa.field("doc_id", doc_type), pa.field("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, term, weights, named = held.value
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(*(c[i].as_py() for c in batch.columns), wanted.value)
                for which, place, score in block.top(item, term, weights, k):
                    yield pa.RecordBatch.from_arrays([named.take(pa.array(which)), pa.array([block.ids[p] for p in place.tolist()], doc_type), pa.array(score)], schema=schema)

    return index.blocks.mapInArrow(run, f"item_id {item_kind}, doc_id {index.id_col}, score long")


ORACLE_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS t FROM documents
), stats AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS total FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, stats GROUP BY term),
asked AS (SELECT DISTINCT item_id, unnest(coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])) AS term FROM benchmark),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(t) * n_docs) // total))))::BIGINT AS score
  FROM asked JOIN df USING (term) JOIN tf USING (term) JOIN docs USING (r), stats GROUP BY item_id, r, doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50
"""
