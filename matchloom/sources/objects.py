"""Objects (images) in the shared folder, named by their content: what is there already is not written again.

Executors write, each object where there is none, whole or not at all; a task that runs twice, or two runs at once, leave one
object of a name, and equal bytes have equal names. The folder is read back with Spark's ``binaryFile`` reader.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports
from ..session import cut
from . import extract
from .files import open_store

#: Tries of a write, and seconds before the second one; each later wait is twice as long.
TRIES, WAIT = 5, 0.2


def put(fs: pyarrow.fs.FileSystem, path: str, content: bytes, tries: int = TRIES, wait: Callable[[float], None] = time.sleep) -> bool:
    """Write an object unless it is there, trying again when the store fails; whether it was written."""
    for k in range(tries):
        try:
            there = fs.get_file_info(path)
            if there.type == pyarrow.fs.FileType.File and there.size == len(content):
                return False
            fs.create_dir(path.rpartition("/")[0], recursive=True)
            draft = f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}"
            with fs.open_output_stream(draft, compression=None) as out:
                out.write(content)
            fs.move(draft, path)
            return True
        except OSError:
            if k == tries - 1:
                raise
            wait(WAIT * 2**k)
    return False


def store(objects: DataFrame, folder: str) -> DataFrame:
    """Store ``content`` (binary) under ``key`` for each row (id, key, content); (id, key, size, reused), rows without a key or of no bytes left out.

    Of rows with one key that of the least id writes, unless the object was there; all others reuse it. Only keys and ids
    are compared; contents go to the tasks that write them and nowhere else.
    """
    rows = objects.filter("key IS NOT NULL AND octet_length(content) > 0")
    light = rows.select("id", "key", F.octet_length("content").cast("long").alias("size"))
    firsts = light.groupBy("key").agg(F.min("id").alias("first"))
    writers = rows.join(firsts.select(F.col("key").alias("k"), "first"), (F.col("id") == F.col("first")) & (F.col("key") == F.col("k"))).select("key", "content")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_store(folder)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            new = [put(fs, f"{base}/{k[:2]}/{k}", c.as_py()) for k, c in zip(keys, batch.column(1), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(new, pa.bool_())], ["key", "new"])

    written = cut(writers.mapInArrow(write, "key string, new boolean"), "objects").groupBy("key").agg(F.bool_or("new").alias("new"))
    return light.join(firsts, "key").join(written, "key").select("id", "key", "size", (~F.col("new") | (F.col("id") > F.col("first"))).alias("reused"))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """(key, size, content) of the objects of a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("key"), F.col("length").alias("size"), "content")


def mirror(rooms: DataFrame, fetched: DataFrame, folder: str, public: str = "") -> DataFrame:
    """Rooms (hotel_id, room_key, images, an array of addresses) with thumbnail and images as they are hosted, in their order.

    ``fetched`` (url, content_type, content) has what each address gave, one row for each. What is no image is not stored; the
    first image that is becomes the thumbnail. A room without any has none.
    """
    wanted = rooms.select("hotel_id", "room_key", F.posexplode_outer("images").alias("pos", "url"))
    asked = wanted.select("url").distinct()
    got = fetched.join(asked, "url", "left_semi").withColumn("usable", extract.usable_image(F.col("content")))
    keyed = got.withColumn("key", F.when(F.col("usable"), extract.content_key(F.col("content"), extract.image_extension(F.col("url"), F.col("content_type")))))
    hosted = store(keyed.select(F.col("url").alias("id"), "key", "content"), folder).select(F.col("id").alias("url"), F.concat(F.lit(public), "key").alias("hosted"))
    return reports.mirrored(wanted.join(hosted, "url", "left"))
