"""Compression of vectors to codes: one codebook for each of sixteen parts, learned by rounds of assignment.

Vectors become columnar NumPy blocks of bounded size, one row of a table in the shared folder each: a component is a
row of the block, so that the distances of all its vectors to all entries of a codebook grow dimension by dimension.
A round is a ``treeAggregate`` over the blocks: each task adds the parts of its vectors to int64 tensors of sums and
counts (part, entry, place), and these, whose size does not depend on the number of vectors, are merged up a reduction
tree. All arithmetic is in integers, so no order of merging changes a result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, persisted, release
from .secrets import _arrow_type

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components that a block holds, and vectors whose distances are worked out at a time.
BLOCK, AT_ONCE = 1 << 20, 1024


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS) -> DataFrame:
    """(vec_id, label, vector): the rows that get a code.

    Vectors that are null or hold a null, infinite or not-a-number component are dropped; so are empty ones, and those
    of another length than the commonest that can be cut into ``parts`` (of lengths equally common, the smallest).
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.filter(F.col("vector").isNotNull() & (F.size("vector") > 0) & (F.size("vector") % parts == 0) & finite)
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vector") == (lengths["n"] if lengths else 0))


def largest(dims: int) -> int:
    """The largest absolute value for which a squared distance over ``dims`` components fits 64 bits; larger values become this one."""
    return math.isqrt((2**63 - 1) // max(1, dims)) // 2


def whole_numbers(values: np.ndarray, dims: int) -> np.ndarray:
    most = largest(dims)
    return np.clip(np.floor(values * SCALE), -most, most).astype(np.int64)


def columnar(rows: DataFrame, dims: int) -> DataFrame:
    """One row for each block: the number of its vectors, ids and labels as an Arrow stream, and its int64 components, dimension after dimension."""
    most = max(1, BLOCK // dims)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                values = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, dims)
                sink = pa.BufferOutputStream()
                head = part.select(["vec_id", "label"])
                with pa.ipc.new_stream(sink, head.schema) as w:
                    w.write_batch(head)
                blob = np.ascontiguousarray(whole_numbers(values, dims).T).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part.num_rows], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary()), pa.array([blob], pa.binary())], ["n", "head", "columns"])

    return rows.mapInArrow(pack, "n long, head binary, columns binary")


def nearest(columns: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, errors): for each part and vector the nearest entry (ties: lower index), and its squared distance.

    ``columns`` has a row for each dimension; ``books`` is (part, entry, place within the part).
    """
    parts, entries, width = books.shape
    n = columns.shape[1]
    codes, errors = np.empty((parts, n), np.int64), np.empty((parts, n), np.int64)
    for at in range(0, n, AT_ONCE):
        here = columns[:, at : at + AT_ONCE]
        for p in range(parts):
            distance = np.zeros((entries, here.shape[1]), np.int64)
            for j in range(width):
                apart = here[p * width + j][None, :] - books[p, :, j][:, None]
                apart *= apart
                distance += apart
            best = distance.argmin(axis=0)
            codes[p, at : at + AT_ONCE] = best
            errors[p, at : at + AT_ONCE] = distance[best, np.arange(len(best))]
    return codes, errors


def tally(columns: np.ndarray, codes: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums (part, entry, place) and counts (part, entry) of the parts that each entry was given."""
    sums, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
    width = books.shape[2]
    for p in range(len(books)):
        np.add.at(sums[p], codes[p], columns[p * width : (p + 1) * width].T)
        np.add.at(counts[p], codes[p], 1)
    return sums, counts


def learn_codebooks(blocks: DataFrame, first: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds``, beginning with ``first`` (part, entry, place)."""
    spark, books = blocks.sparkSession, first
    dims = first.shape[0] * first.shape[2]
    rdd = blocks.select("n", "columns").rdd
    depth = max(2, math.ceil(math.log(max(2, rdd.getNumPartitions()), 32)))
    for _ in range(rounds):
        held = spark.sparkContext.broadcast(books)

        def add(total, row, held=held):
            columns = np.frombuffer(row["columns"], np.int64).reshape(dims, row["n"])
            codes, _ = nearest(columns, held.value)
            return merge(total, tally(columns, codes, held.value))

        sums, counts = rdd.treeAggregate(None, add, merge, depth) or (np.zeros_like(books), np.zeros(books.shape[:2], np.int64))
        books = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        held.unpersist()
    return books


def merge(a, b):
    return b if a is None else a if b is None else (a[0] + b[0], a[1] + b[1])


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def encode_blocks(blocks: DataFrame, books: np.ndarray, rows: DataFrame) -> DataFrame:
    """(vec_id, label, code, error) of every vector; types are those of ``rows``."""
    dims, held = books.shape[0] * books.shape[2], blocks.sparkSession.sparkContext.broadcast(books)
    schema = pa.schema([pa.field("vec_id", _arrow_type(rows, "vec_id")), pa.field("label", _arrow_type(rows, "label")), pa.field("code", pa.string()), pa.field("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, head, columns in zip(*(batch.column(c) for c in ("n", "head", "columns")), strict=True):
                codes, errors = nearest(np.frombuffer(columns.as_buffer(), np.int64).reshape(dims, n.as_py()), held.value)
                named = pa.ipc.open_stream(head.as_buffer()).read_all().combine_chunks()
                hexed = codes.astype(np.uint8).T.tobytes().hex()
                step = 2 * len(codes)
                code = pa.array([hexed[i : i + step] for i in range(0, len(hexed), step)], pa.string())
                columns_out = [named.column("vec_id").combine_chunks(), named.column("label").combine_chunks(), code, pa.array(errors.sum(axis=0))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns_out, schema, strict=True)], schema=schema)

    kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
    return blocks.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256), one row for each usable row of ``vectors``.

    Codebooks begin with the ``entries`` vectors of the smallest ids (fewer vectors: as many entries), null ids after all
    others, rows of one id by their components. ``entries`` is at most 256, two hex digits. Components whose 256-fold does
    not fit the integers (over 700,000 at 64 dimensions) count as the largest that does. Repeated rows each get a row;
    rows of a null id or label are kept, null labels summed together. An empty table gives no rows. Sums over a label that
    leave 64 bits are null. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col, parts)
    start = np.array([r["vector"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").limit(entries).collect()], np.float64)
    if not len(start):
        kinds = {c: rows.schema[c].dataType.simpleString() for c in ("vec_id", "label")}
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, code string, error long, label_error long, codebooks_sha256 string")
    dims = start.shape[1]
    first = whole_numbers(start, dims).reshape(len(start), parts, dims // parts).transpose(1, 0, 2)
    blocks = persisted(columnar(rows, dims), "vector-blocks")
    books = learn_codebooks(blocks, np.ascontiguousarray(first), rounds)
    coded = persisted(encode_blocks(blocks, books, rows), "vector-codes")
    release(blocks)
    by_label = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    joined = coded.join(broadcast_if_small(by_label), F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle() -> str:
    steps, book = [], "b0"
    distance = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    for r in range(ROUNDS + 1):
        steps.append(f"a{r} AS (SELECT vec_id, label, p, any_value(a.v) AS v, min({distance} * {ENTRIES} + e) AS m FROM parts a JOIN {book} b USING (p) GROUP BY ALL)")
        if r < ROUNDS:
            steps.append(f"s{r} AS (SELECT p, m % {ENTRIES} AS e, pos, sum(v[pos])::BIGINT AS s, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS pos) WHERE pos <= len(v) GROUP BY ALL)")
            steps.append(f"t{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM s{r} GROUP BY ALL)")
            steps.append(f"b{r + 1} AS (SELECT o.p, o.e, coalesce(t.v, o.v) AS v FROM {book} o LEFT JOIN t{r} t ON t.p = o.p AND t.e = o.e)")
            book = f"b{r + 1}"
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), parts AS (
  SELECT vec_id, label, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v FROM kept, (SELECT unnest(range({PARTS})) AS p)
), first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
b0 AS (SELECT p, e, v FROM parts JOIN first USING (vec_id)),
{', '.join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(lpad(to_hex(m % {ENTRIES}), 2, '0'), '' ORDER BY p) AS code, sum(m // {ENTRIES})::BIGINT AS error FROM a{ROUNDS} GROUP BY ALL
), hashed AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM {book})
SELECT vec_id, lower(code) AS code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM coded, hashed
"""


ORACLE_SQL = _oracle()
