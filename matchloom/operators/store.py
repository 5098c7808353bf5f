"""The store of published rooms: immutable deltas, merged when they are read, and numbered commits.

A publishing run never rewrites what is stored. It writes the rooms that it inserts and the values that it fills as a delta,
in folders by bucket of hotels, and then a commit, a small file that lists the deltas that count. Commits are numbered; each is
made by creating its file where there is none, so of two writers one comes second. That one looks at what was committed since
it read: where other buckets were touched, its delta still holds and goes into the next number; else it is worked out again.

Values are filled, never changed, so merging takes the first value of each room in the order of commits. Numbers of new rooms
are kept relative to a number that the commit gives, so that coming second renumbers nothing.
"""

from __future__ import annotations

import json
import os
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..session import cut, drop
from . import publishing
from .numbering import numbered

ROOMS = "id long, hotel_id long, name string, thumbnail string, size_sqft int, category_id long"
GALLERY = "hotel_id long, room_key string, pos int, url string"
_DELTA = f"nth long, {ROOMS}, bucket int"
VALUES = ("thumbnail", "size_sqft", "category_id")


class Conflict(RuntimeError):
    """Others committed to the same hotels, again and again."""


@dataclass(frozen=True)
class Delta:
    """Files that a commit counts: where, which buckets, in which order, and what relative numbers start from."""

    folder: str
    buckets: list[int]
    version: int = 0
    first_id: int = 0
    inserted: int = 0


@dataclass(frozen=True)
class Snapshot:
    """One commit: its number, the deltas that count, the highest id, and what its run counted."""

    version: int
    deltas: list[Delta] = field(default_factory=list)
    top: int = 0
    counted: dict[str, int] = field(default_factory=dict)


@dataclass
class Prepared:
    """A delta that is written but not committed, made against a version."""

    incoming: DataFrame
    against: Snapshot
    delta: Delta
    acted: DataFrame
    counted: dict[str, int]


class Store:
    """The rooms below ``path``. ``buckets`` and ``fanout`` (deltas until they are merged) are fixed when the store is made."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 16, fanout: int = 8):
        self.spark, self.path, self.buckets, self.fanout = spark, path.rstrip("/"), buckets, fanout

    # --- commits

    def _fs(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _commit_path(self, version: int) -> str:
        return f"{self.path}/commits/{version:012d}.json"

    def version(self) -> int:
        """The number of the last commit; 0 if there is none."""
        folder, fs = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits"), self._fs()
        if not fs.exists(folder):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return max((int(m[1]) for n in names if (m := re.fullmatch(r"(\d{12})\.json", n))), default=0)

    def snapshot(self, version: int | None = None) -> Snapshot:
        """What counts at a version, the last if none is given."""
        version = self.version() if version is None else version
        if not version:
            return Snapshot(0)
        text = "".join(r["value"] for r in self.spark.read.text(self._commit_path(version), wholetext=True).collect())
        told = json.loads(text)
        return Snapshot(told["version"], [Delta(**d) for d in told["deltas"]], told["top"], told["counted"])

    def _try_commit(self, snapshot: Snapshot) -> bool:
        """Create the commit's file, whole, where there is none; False if there is one."""
        told = {"version": snapshot.version, "deltas": [vars(d) for d in snapshot.deltas], "top": snapshot.top, "counted": snapshot.counted}
        jvm, target = self.spark._jvm, self._commit_path(snapshot.version)
        draft, fs = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/draft-{uuid.uuid4().hex}"), self._fs()
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(told).encode()))
        out.close()
        try:
            if fs.getScheme() == "file":
                local = lambda p: jvm.org.apache.hadoop.fs.Path(p).toUri().getPath()
                try:
                    os.link(local(str(draft)), local(target))
                    return True
                except FileExistsError:
                    return False
            # a rename that does not overwrite is one step elsewhere
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
            never = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            try:
                context.rename(draft, jvm.org.apache.hadoop.fs.Path(target), never)
                return True
            except Exception as e:
                if "FileAlreadyExists" in str(e):
                    return False
                raise
        finally:
            fs.delete(draft, False)

    # --- reading

    def bucket(self, hotel: Column) -> Column:
        return F.pmod(F.xxhash64(hotel.cast("long")), F.lit(self.buckets)).cast("int")

    def _read(self, deltas: list[Delta], what: str, schema: str, only: list[int] | None) -> DataFrame:
        parts = [self.spark.createDataFrame([], schema).withColumns({"version": F.lit(0), "first_id": F.lit(0).cast("long")})]
        for d in deltas:
            if only is None or set(only) & set(d.buckets):
                rows = self.spark.read.schema(schema).parquet(f"{d.folder}/{what}")
                rows = rows if only is None else rows.filter(F.col("bucket").isin(only))
                parts.append(rows.withColumns({"version": F.lit(d.version), "first_id": F.lit(d.first_id).cast("long")}))
        return reduce(DataFrame.unionByName, parts)

    def rooms(self, at: Snapshot | None = None, only: list[int] | None = None) -> DataFrame:
        """The rooms, of all buckets or ``only`` some: of each value the first that was published."""
        at = at or self.snapshot()
        rows = self._read(at.deltas, "rooms", _DELTA, only).withColumn("id", F.coalesce("id", F.col("nth") + F.col("first_id")))
        if len(at.deltas) < 2:
            return rows.select(*[c.split()[0] for c in ROOMS.split(", ")])
        first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("version"))).alias(c)
        return rows.groupBy("hotel_id", "id").agg(first("name"), *map(first, VALUES)).select(*[c.split()[0] for c in ROOMS.split(", ")])

    def gallery(self, at: Snapshot | None = None) -> DataFrame:
        at = at or self.snapshot()
        return self._read(at.deltas, "gallery", f"{GALLERY}, bucket int", None).select(*[c.split()[0] for c in GALLERY.split(", ")])

    # --- writing

    def _write(self, rooms: DataFrame, gallery: DataFrame) -> str:
        """Write a delta; few files for each bucket, and a bucket of many rows in as many as its size asks for."""
        folder = f"{self.path}/deltas/{uuid.uuid4().hex}"
        for what, rows in (("rooms", rooms), ("gallery", gallery)):
            rows.withColumn("bucket", self.bucket(F.col("hotel_id"))).hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/{what}")
        return folder

    def load(self, rooms: DataFrame) -> Snapshot:
        """The first commit of a store: rooms that have ids. An empty text counts as no value."""
        rows = rooms.select(F.lit(None).cast("long").alias("nth"), "id", "hotel_id", "name", publishing.blank(F.col("thumbnail")).alias("thumbnail"), "size_sqft", "category_id")
        seen = Observation()
        folder = self._write(rows.observe(seen, F.coalesce(F.max("id"), F.lit(0)).alias("top"), F.count("*").alias("loaded")), self.spark.createDataFrame([], GALLERY))
        snapshot = Snapshot(1, [Delta(folder, list(range(self.buckets)), 1)], seen.get["top"], {"loaded": seen.get["loaded"]})
        if not self._try_commit(snapshot):
            raise Conflict("the store is not empty")
        return snapshot

    def prepare(self, incoming: DataFrame) -> Prepared:
        """Work out and write what publishing ``incoming`` adds to the last version, without committing it.

        ``incoming``: hotel_id, seq, room_name, thumbnail, size_sqft, category_id, images. It is read once; what is counted is
        observed as it is written.
        """
        against = self.snapshot()
        rows = cut(incoming.withColumn("bucket", self.bucket(F.col("hotel_id"))), "incoming")
        touched = sorted(r["bucket"] for r in rows.select("bucket").distinct().toLocalIterator())
        seen = Observation()
        one = lambda a: F.count_if(F.col("action") == a).alias(a)
        acted = publishing.actions(rows.drop("bucket"), self.rooms(against, touched)).observe(seen, *map(one, ("insert", "fill", "skip_existing", "skip_duplicate")), F.count_if("sets_thumbnail").alias("thumbnails"))
        acted = cut(acted, "acted")
        counted = dict(seen.get)
        own = lambda c: publishing.blank(F.col(c)) if c == "thumbnail" else F.col(c)
        fresh = acted.filter("action = 'insert'").select("hotel_id", "seq", "room_key", F.substring(F.trim("room_name"), 1, V.NAME_LENGTH).alias("name"), *[own(c).alias(c) for c in VALUES])
        new = numbered(fresh, [F.asc("hotel_id"), F.asc("seq"), F.asc("room_key")], "nth").withColumn("id", F.lit(None).cast("long"))
        # of several stored rooms with one key the one of the least id is filled
        fills = acted.filter("action = 'fill'").select(F.lit(None).cast("long").alias("nth"), F.col("old_id").alias("id"), "hotel_id", F.lit(None).cast("string").alias("name"), *[own(c).alias(c) for c in VALUES])
        columns = [c.split()[0] for c in _DELTA.split(", ")][:-1]
        folder = self._write(new.select(columns).unionByName(fills.select(columns)), publishing.gallery(acted).select("hotel_id", "room_key", "pos", "url"))
        drop(rows)
        return Prepared(incoming, against, Delta(folder, touched, inserted=counted["insert"]), acted, counted)

    def commit(self, prepared: Prepared, tries: int = 10) -> tuple[Snapshot, Prepared]:
        """Commit a delta; where others have touched its buckets since it was made, it is made again, up to ``tries`` times."""
        for _ in range(tries):
            last = self.snapshot()
            since = [d for d in last.deltas if d.version > prepared.against.version]
            if any(set(d.buckets) & set(prepared.delta.buckets) for d in since):
                self._forget(prepared)
                prepared = self.prepare(prepared.incoming)
                last = prepared.against
            delta = Delta(prepared.delta.folder, prepared.delta.buckets, last.version + 1, last.top, prepared.delta.inserted)
            snapshot = Snapshot(last.version + 1, [*last.deltas, delta], last.top + delta.inserted, prepared.counted)
            if self._try_commit(snapshot):
                if len(snapshot.deltas) > self.fanout:
                    self.compact()
                return snapshot, prepared
        raise Conflict(f"{tries} commits came first")

    def publish(self, incoming: DataFrame) -> DataFrame:
        """Insert new rooms, fill what is empty, change nothing that is there. Returns counters by hotel."""
        return publishing.counters(self.commit(self.prepare(incoming))[1].acted)

    def compact(self) -> bool:
        """Merge all deltas of the last version into one; those that others commit meanwhile stay as they are. False if another merge came first."""
        at = self.snapshot()
        if len(at.deltas) < 2:
            return False
        rooms = self.rooms(at).withColumn("nth", F.lit(None).cast("long"))
        folder = self._write(rooms.select([c.split()[0] for c in _DELTA.split(", ")][:-1]), self.gallery(at))
        merged, gone = Delta(folder, list(range(self.buckets)), at.version), {d.folder for d in at.deltas}
        while True:
            last = self.snapshot()
            if not gone <= {d.folder for d in last.deltas}:
                return False
            if self._try_commit(Snapshot(last.version + 1, [merged, *(d for d in last.deltas if d.folder not in gone)], last.top, {"merged": len(gone)})):
                return True

    def sweep(self, keep: int = 1) -> list[str]:
        """Delete the deltas that none of the last ``keep`` versions counts; for when nobody reads or writes. Returns their folders."""
        last = self.version()
        live = {d.folder for v in range(max(1, last - keep + 1), last + 1) for d in self.snapshot(v).deltas}
        fs, folder = self._fs(), self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/deltas")
        names = {d.rpartition("/")[2] for d in live}
        gone = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in names] if fs.exists(folder) else []
        for p in gone:
            fs.delete(p, True)
        return [str(p) for p in gone]

    def _forget(self, prepared: Prepared) -> None:
        self._fs().delete(self.spark._jvm.org.apache.hadoop.fs.Path(prepared.delta.folder), True)
        drop(prepared.acted)


def publishing_together(store: Store, runs: list[DataFrame], order: Callable[[int], int] = lambda i: -i) -> list[dict[str, int]]:
    """Publish runs that were all made against one version, committing them in an order of their own; returns what each counted."""
    made = [store.prepare(r) for r in runs]
    counted: list[dict[str, int]] = [{}] * len(runs)
    for i in sorted(range(len(runs)), key=order):
        counted[i] = store.commit(made[i])[0].counted
    return counted
