"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructField, StructType

from ..session import shared_dir

#: Bytes of rows up to which a side of a join is broadcast.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, what: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def persisted(df: DataFrame, what: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: the lineage is cut, and a lost executor loses nothing."""
    path = workspace(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(df: DataFrame) -> None:
    """Delete what ``persisted`` wrote, once nothing reads it any more."""
    drop_path(df.sparkSession, df.stored_at)


def broadcast_if_small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows, by a count of their bytes, take at most ``most``; else the join shuffles."""
    width = F.lit(0)
    for f in df.schema:
        if isinstance(f.dataType, ArrayType):
            width = width + 16 + 8 * F.coalesce(F.size(f.name), F.lit(0))
        elif isinstance(f.dataType, (StringType, BinaryType)):
            width = width + 16 + F.coalesce(F.octet_length(f.name), F.lit(0))
        else:
            width = width + 8
    return F.broadcast(df) if (df.agg(F.sum(width.cast("long"))).first()[0] or 0) <= most else df


def drop_path(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def held_out(id_col: str) -> F.Column:
    """True for the quarter of the ids that no model learns from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def may_learn(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 != 2, F.lit(False))


def map_rows(df: DataFrame, fn: Callable[[list], list], fields: list[pa.Field], schema: str) -> DataFrame:
    """Apply ``fn`` to lists of column values, batch by batch, over Arrow.

    ``fn`` gets one list for each column of ``df`` and returns one list for each field.
    Batches are cut into pieces of at most ``PIECE`` rows, so that memory does not follow the batch size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                out = fn(*[c.to_pylist() for c in part.columns])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, fields, strict=True)], schema=pa.schema(fields))

    return df.mapInArrow(run, schema)


def with_mapped(df: DataFrame, source: str, fn: Callable[[list], list], out: str, kind: pa.DataType, sql_kind: str, done: Callable[[], None] | None = None) -> DataFrame:
    """``df`` with column ``out`` (new, or in the place of the one of that name) made of ``source`` by ``fn``, piece by piece; ``done`` is called at a task's end.

    Rows go through Arrow; only the values of ``source`` in one piece become Python objects at a time.
    """
    names = df.columns if out in df.columns else [*df.columns, out]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                made = pa.array(fn(part.column(part.schema.get_field_index(source)).to_pylist()), kind)
                yield pa.RecordBatch.from_arrays([made if c == out else part.column(part.schema.get_field_index(c)) for c in names], names)
        if done:
            done()

    schema = StructType([StructField(out, _parsed(df, sql_kind)) if c == out else df.schema[c] for c in names])
    return df.mapInArrow(run, schema)


def kept(df: DataFrame, source: str, fn: Callable[[list], list]) -> DataFrame:
    """The rows of ``df`` for whose ``source`` the function gives true, piece by piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                yield part.filter(pa.array(fn(part.column(part.schema.get_field_index(source)).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def _parsed(df: DataFrame, sql_kind: str):
    return df.sparkSession.createDataFrame([], f"x {sql_kind}").schema["x"].dataType


PIECE = 512
