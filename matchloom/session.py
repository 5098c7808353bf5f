"""Where intermediate tables go, and how lineage is cut."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Where that setting is missing, a local folder is set if all runs in one process; on a cluster that is an error.
    """
    place = spark.conf.get("spark.checkpoint.dir", None)
    if not place:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = "file:///tmp/checkpoints"
        spark.conf.set("spark.checkpoint.dir", place)
    return place.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nobody has."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """``df``, written to the shared folder and read back: planned and worked out once, safe from lost executors."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def drop(df: DataFrame) -> None:
    """Delete what ``cut`` wrote, once nothing reads it any more."""
    jvm = df.sparkSession._jvm
    p = jvm.org.apache.hadoop.fs.Path(df.stored_at)
    p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt by columns over as many tasks as a shuffle has: for few, small rows that are costly to work on, which Spark would put together into a task or two."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
