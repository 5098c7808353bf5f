"""Exact top-k search: an inverted index with block-max WAND pruning for BM25.

Documents are gathered into shards of a bounded number of postings; each shard is an inverted index of its own,
kept as one row of a table in the shared folder. Document frequencies and lengths are summed over all shards, so
each shard scores with the same global statistics and the shards' best k can be merged exactly. Within a shard,
like documents stand together, in blocks, and each term knows its largest contribution in each of its blocks.

WAND parts a query's terms at the pivot: the frequent ones, whose weights are low, cannot lift a document on their
own. The postings of the others are decoded; what they give a document, plus the sum of the frequent terms' block
maxima, bounds the score of the documents of a block. Only where the bound of a stretch of blocks reaches the k-th
best score so far are the frequent terms' contributions added, beginning with the stretch of the highest bound; all
other stretches are skipped. Many queries are taken at a time, and frequent terms are kept as rows of a matrix (of
bounded size), so that bounds and scores are products of matrices.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, persisted
from .licenses import WORD_BYTES
from .secrets import _arrow_type

K1, B = 1.2, 0.75
#: Documents of a block, blocks of a stretch, and the share of the documents that makes a term frequent.
BLOCK, STRETCH, FREQUENT = 64, 8, 1 / 32
#: Numbers in the matrix of frequent terms, and in that of the scores of some queries.
DENSE, SCORES = 1_500_000, 400_000
DIGITS = 6


def words(text: str | None) -> list[bytes]:
    """Words of a-z (A-Z is lowered), digits and non-ASCII characters; null has none."""
    return (text or "").encode("utf-8", "replace").translate(WORD_BYTES).split()


SHARD = "ids binary, lengths binary, terms binary, ends binary, docs binary, tfs binary"


def build_shards(docs: DataFrame, shard_postings: int, id_col: str, text_col: str) -> DataFrame:
    """One row per shard: ids and lengths of its documents, sorted terms, ends of the posting lists, and the postings.

    Each task makes shards of the documents that it reads, without a shuffle; a shard ends once it has
    ``shard_postings`` postings. Documents are ordered by their most frequent word, then by length.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, keys, number, term_of, doc_of, tf_of = [], [], [], {}, [], [], []

        def shard() -> pa.RecordBatch:
            terms = sorted(number)
            place = np.empty(len(terms), np.int32)
            place[[number[t] for t in terms]] = np.arange(len(terms), dtype=np.int32)
            by_key = sorted(range(len(ids)), key=keys.__getitem__)
            at = np.empty(len(ids), np.uint32)
            at[by_key] = np.arange(len(ids), dtype=np.uint32)
            term = place[np.concatenate(term_of)] if terms else np.zeros(0, np.int32)
            doc = np.repeat(at, doc_of)
            order = np.lexsort((doc, term))
            ends = np.cumsum(np.bincount(term, minlength=len(terms))).astype(np.int64)
            tf = np.concatenate(tf_of) if terms else np.zeros(0, np.uint32)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([pa.field("id", id_type)])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([pa.array([ids[i] for i in by_key], id_type)], ["id"]))
            arrays = (np.array(lengths, np.uint32)[by_key], ends, doc[order], tf[order])
            size, ends, doc, tf = (x.tobytes() for x in arrays)
            values = (sink.getvalue().to_pybytes(), size, b" ".join(terms), ends, doc, tf)
            return pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], [f.split()[0] for f in SHARD.split(", ")])

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    found = words(text)
                    count = Counter(found)
                    ids.append(i)
                    lengths.append(len(found))
                    keys.append((min(((-n, t) for t, n in count.items()), default=(0, b""))[1], len(found)))
                    term_of.append(np.fromiter((number.setdefault(t, len(number)) for t in count), np.int32, len(count)))
                    tf_of.append(np.fromiter(count.values(), np.uint32, len(count)))
                    doc_of.append(len(count))
                    held += len(count)
                    if held >= shard_postings:
                        yield shard()
                        ids, lengths, keys, number, term_of, doc_of, tf_of, held = [], [], [], {}, [], [], [], 0
        if ids:
            yield shard()

    id_type = _arrow_type(docs, id_col)
    return docs.select(id_col, text_col).mapInArrow(build, SHARD)


def _ids(blob: bytes) -> list:
    return pa.ipc.open_stream(blob).read_all().column(0).to_pylist()


def term_frequencies(index: DataFrame) -> DataFrame:
    """(term, df) over all shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, ends in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                df = np.diff(np.frombuffer(ends, np.int64), prepend=0)
                names = terms.split(b" ") if terms else []
                for at in range(0, len(names), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(names[at : at + 50_000], pa.binary()), pa.array(df[at : at + 50_000])], ["term", "df"])

    return index.select("terms", "ends").mapInArrow(run, "term binary, df long").groupBy("term").agg(F.sum("df").alias("df"))


def collection_size(index: DataFrame) -> tuple[int, float]:
    """Number of documents and their mean length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.frombuffer(x, np.uint32) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(s) for s in sizes], pa.int64()), pa.array([int(s.sum()) for s in sizes], pa.int64())], ["n", "w"])

    row = index.select("lengths").mapInArrow(run, "n long, w long").agg(F.sum("n"), F.sum("w")).first()
    n = row[0] or 0
    return n, ((row[1] or 0) / n if n else 0.0)


class Shard:
    """An index in memory. ``visited`` counts the stretches that queries had scored, ``possible`` those that there are for them."""

    def __init__(self, ids: bytes, lengths: bytes, terms: bytes, ends: bytes, docs: bytes, tfs: bytes, mean: float):
        self.ids, self.visited, self.possible = _ids(ids), 0, 0
        n = self.size = len(self.ids)
        # nulls after all others where scores tie
        self.place = np.empty(n, np.int64)
        self.place[sorted(range(n), key=lambda i: (self.ids[i] is None, self.ids[i] if self.ids[i] is not None else 0))] = np.arange(n)
        self.number = {t: i for i, t in enumerate(terms.split(b" "))} if terms else {}
        self.ends = np.frombuffer(ends, np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.docs = np.frombuffer(docs, np.uint32)
        tf = np.frombuffer(tfs, np.uint32).astype(np.float64)
        norm = K1 * (1 - B + B * np.frombuffer(lengths, np.uint32) / (mean or 1.0))
        self.impact = tf * (K1 + 1) / (tf + norm[self.docs])
        df = self.ends - self.starts
        frequent = np.flatnonzero(df >= FREQUENT * n)
        frequent = frequent[np.argsort(-df[frequent], kind="stable")][: max(1, DENSE // max(1, n))]
        self.row = np.full(len(df), -1)
        self.row[frequent] = np.arange(len(frequent))
        self.blocks = -(-n // BLOCK)
        self.stretches = -(-self.blocks // STRETCH)
        self.dense = np.zeros((len(frequent), self.blocks * BLOCK))
        for r, t in enumerate(frequent):
            self.dense[r, self.docs[self.starts[t] : self.ends[t]]] = self.impact[self.starts[t] : self.ends[t]]
        self.block_max = self.dense.reshape(len(frequent), self.blocks, BLOCK).max(axis=2) if n else self.dense

    def top(self, queries: list[tuple[list[bytes], np.ndarray]], k: int, floors: np.ndarray | None = None) -> list[list[tuple[object, float]]]:
        """For each query (terms and weights) the k best (score falling, then id) of this shard, as (id, score).

        ``floors`` has a score for each query below which nothing is asked for.
        """
        ends = np.cumsum([0, *(len(terms) for terms, _ in queries)])
        return self.top_of(self.numbers([t for terms, _ in queries for t in terms]), np.concatenate([np.zeros(0), *(w for _, w in queries)]), ends, k, np.zeros(len(queries)) if floors is None else floors)

    def numbers(self, terms: list[bytes]) -> np.ndarray:
        """The numbers of terms in this shard, -1 where it has them not."""
        return np.fromiter(map(self.number.get, terms, repeat(-1)), np.int64, len(terms))

    def top_of(self, term: np.ndarray, weight: np.ndarray, ends: np.ndarray, k: int, floors: np.ndarray) -> list[list[tuple[object, float]]]:
        """As ``top``, for queries strung together: numbers of their terms and weights; query i stands from ``ends[i]`` to ``ends[i + 1]``."""
        out, step = [], max(1, SCORES // max(1, self.blocks * BLOCK))
        for at in range(0, len(ends) - 1, step):
            some = ends[at : at + step + 1]
            out += self._some(term[some[0] : some[-1]], weight[some[0] : some[-1]], np.diff(some), k, floors[at : at + step])
        return out

    def _some(self, term: np.ndarray, weight: np.ndarray, sizes: np.ndarray, k: int, floors: np.ndarray) -> list[list[tuple[object, float]]]:
        m, width = len(sizes), self.blocks * BLOCK
        query = np.repeat(np.arange(m), sizes)
        query, weight, term = query[term >= 0], weight[term >= 0], term[term >= 0]
        if not len(term):
            return [[] for _ in range(m)]
        row = self.row[term]
        often = row >= 0
        weights = np.zeros((m, len(self.dense)))
        weights[query[often], row[often]] = weight[often]
        at, n = _ranges(self.starts[term[~often]], self.ends[term[~often]])
        cell = np.repeat(query[~often] * width, n) + self.docs[at]
        partial = np.bincount(cell, weights=self.impact[at] * np.repeat(weight[~often], n), minlength=m * width).reshape(m, width)
        bound = partial.reshape(m, self.blocks, BLOCK).max(axis=2) + weights @ self.block_max
        bound = np.pad(bound, ((0, 0), (0, self.stretches * STRETCH - self.blocks))).reshape(m, self.stretches, STRETCH).max(axis=2)
        best = np.repeat(floors[:, None], k, axis=1)  # the k best scores so far
        hits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def visit(rows: np.ndarray, stretch: int) -> None:
            a, b = stretch * STRETCH * BLOCK, min(width, (stretch + 1) * STRETCH * BLOCK)
            scores = np.round(partial[rows, a:b] + weights[rows] @ self.dense[:, a:b], DIGITS)
            here = np.partition(scores, -k, axis=1)[:, -k:] if b - a > k else scores
            best[rows] = np.partition(np.concatenate([best[rows], here], axis=1), -k, axis=1)[:, -k:]
            r, d = np.nonzero((scores >= best[rows].min(axis=1)[:, None]) & (scores > 0))
            hits.append((rows[r], d + a, scores[r, d]))
            self.visited += len(rows)

        first = bound.argmax(axis=1)
        self.possible += m * self.stretches
        for s in np.unique(first):
            visit(np.flatnonzero(first == s), int(s))
        for s in np.argsort(-bound.sum(axis=0), kind="stable"):
            # a bound that only equals the k-th best score may still hold a tie with a smaller id
            rows = np.flatnonzero((bound[:, s] >= best.min(axis=1) - 10.0**-DIGITS) & (bound[:, s] > 0) & (first != s))
            if len(rows):
                visit(rows, int(s))
        rows, docs, scores = (np.concatenate(x) for x in zip(*hits, strict=True))
        keep = scores >= best.min(axis=1)[rows]
        rows, docs, scores = rows[keep], docs[keep], scores[keep]
        order = np.lexsort((self.place[docs], -scores, rows))
        out: list[list[tuple[object, float]]] = [[] for _ in range(m)]
        for i in order:
            if len(out[rows[i]]) < k:
                out[rows[i]].append((self.ids[docs[i]], float(scores[i])))
        return out


def _order(hit: tuple[object, float]) -> tuple:
    """Score falling, then id, nulls last."""
    d, score = hit
    return -score, d is None, d if d is not None else 0


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places from each start to its end, strung together, and how many each gives."""
    n = ends - starts
    return np.arange(n.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(n)[:-1]]), n), n


def query_table(queries: DataFrame, frequencies: DataFrame, total: int, id_col: str, text_col: str) -> DataFrame:
    """(query_id, n, terms, idfs): each query's distinct words, sorted, with their weights, both packed."""
    kind, id_type = queries.schema[id_col].dataType.simpleString(), _arrow_type(queries, id_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                found = [sorted(set(words(t))) for t in part.column(1).to_pylist()]
                take = pa.array(np.repeat(np.arange(part.num_rows), [len(c) for c in found]))
                yield pa.RecordBatch.from_arrays([part.column(0).take(take), pa.array([t for c in found for t in c], pa.binary())], schema=pa.schema([pa.field("query_id", id_type), pa.field("term", pa.binary())]))

    def packed(ids: list, terms: list) -> list:
        return [ids, [len(x) for x in terms], [b" ".join(t["term"] for t in x) for x in terms], [np.array([t["idf"] for t in x]).tobytes() for x in terms]]

    found = queries.select(id_col, text_col).mapInArrow(run, f"query_id {kind}, term binary").distinct()
    idf = F.log(1 + (total - F.col("df") + 0.5) / (F.col("df") + 0.5))
    grouped = found.join(frequencies, "term").groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("term", idf.alias("idf")))).alias("terms"))
    fields = [pa.field("query_id", id_type), pa.field("n", pa.int64()), pa.field("terms", pa.binary()), pa.field("idfs", pa.binary())]
    return map_rows(grouped, packed, fields, f"query_id {kind}, n long, terms binary, idfs binary")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", shard_postings: int = 400_000, block_terms: int = 1_500_000) -> DataFrame:
    """(query_id, rank, doc_id, score): the k best rows of ``docs`` for each row of ``queries``, by BM25.

    A query is made of all distinct words of its whole text that occur in ``docs``. Ties of scores, rounded to six
    digits, go to the smaller id, ids of null last. Rows of ``queries`` with the same id are one query; a query
    without such words has no result, and an empty table on either side gives an empty result. Each row of ``docs`` is
    a document; null texts have no words. Queries are taken in blocks of about ``block_terms`` words, packed, which
    bounds what is broadcast; the index is read once for each block.
    """
    spark = docs.sparkSession
    index = persisted(build_shards(docs, shard_postings, id_col, text_col), "index")
    total, mean = collection_size(index)
    table = persisted(query_table(queries, term_frequencies(index), total, id_col, text_col), "queries")
    blocks = max(1, -(-int(table.agg(F.sum("n")).first()[0] or 0) // block_terms))
    kind, id_type = docs.schema[id_col].dataType.simpleString(), _arrow_type(docs, id_col)
    query_kind, query_type = queries.schema[id_col].dataType.simpleString(), _arrow_type(queries, id_col)
    schema = pa.schema([pa.field("query_id", query_type), pa.field("doc_id", id_type), pa.field("score", pa.float64())])

    def scored(block: int) -> DataFrame:
        rows = table.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block).toArrow()
        # a block's terms are numbered once, so that a shard looks each of them up once for all queries
        number: dict[bytes, int] = {}
        term = np.fromiter((number.setdefault(t, len(number)) for v in rows["terms"] for t in bytes(v.as_buffer()).split(b" ")), np.int32)
        weight = np.frombuffer(b"".join(bytes(v.as_buffer()) for v in rows["idfs"]))
        held = spark.sparkContext.broadcast((rows["query_id"].to_pylist(), b" ".join(number), term, weight, np.cumsum([0, *rows["n"].to_pylist()])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # a task's shards are searched one after the other, and what the earlier ones gave bounds the later ones
            ids, vocabulary, term, weight, ends = held.value
            vocabulary = vocabulary.split(b" ")
            best: list[list[tuple[object, float]]] = [[] for _ in ids]
            floors = np.zeros(len(best))
            for batch in batches:
                for i in range(batch.num_rows):
                    shard = Shard(*(c[i].as_py() for c in batch.columns), mean)
                    here = shard.numbers(vocabulary)
                    for at in range(0, len(best), 512):
                        some = ends[at : at + 513]
                        found = shard.top_of(here[term[some[0] : some[-1]]], weight[some[0] : some[-1]], some - some[0], k, floors[at : at + 512])
                        for q, more in enumerate(found, start=at):
                            if more:
                                best[q] = sorted(best[q] + more, key=_order)[:k]
                                floors[q] = best[q][-1][1] if len(best[q]) == k else 0.0
            for at in range(0, len(best), 512):
                out = [(q, d, s) for q, some in zip(ids[at : at + 512], best[at : at + 512], strict=True) for d, s in some]
                q, d, s = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(q, query_type), pa.array(d, id_type), pa.array(s, pa.float64())], schema=schema)

        return index.mapInArrow(run, f"query_id {query_kind}, doc_id {kind}, score double")

    parts = scored(0)
    if blocks > 1:
        parts = persisted(parts, "scored")
        for b in range(1, blocks):
            parts = parts.unionByName(persisted(scored(b), "scored"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return parts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "score")


def every_fiftieth(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose id is divisible by 50."""
    return docs.filter(F.col(id_col) % 50 == 0)


ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents
), stats AS (SELECT count(*) AS total, avg(len(w)) AS mean FROM docs),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM docs) GROUP BY ALL),
df AS (SELECT term, count(*) AS df, ln(1 + (any_value(total) - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM tf, stats GROUP BY term),
q AS (SELECT doc_id AS query_id, term, idf FROM tf JOIN df USING (term) WHERE doc_id % 50 = 0
), scored AS (
  SELECT query_id, tf.doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))), 6) AS score
  FROM q JOIN tf USING (term) JOIN docs ON docs.doc_id = tf.doc_id, stats GROUP BY query_id, tf.doc_id
)
SELECT query_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scored) WHERE rank <= 10
"""
