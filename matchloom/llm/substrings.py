"""Removal of repeated passages with a log-structured fingerprint index.

A window is ``width`` consecutive words. Its fingerprint is the least hash of the word grams in it, so
equal windows have equal fingerprints, while neighbouring windows mostly share theirs: the index holds a
seventh of what a list of all windows would. The index is a list of immutable runs, each sorted by
fingerprint and bucketed alike. A new batch becomes a run of its own; it is merge-joined with the older
runs, bucket by bucket and without a shuffle, to find the fingerprints that occur more than once. Runs are
merged into one when they get many. Only windows whose fingerprint recurs are then verified, and every
window but the first of its kind is marked. Verification compares a second hash of 64 bits of all the
window's words; it is built from other hashes of the words than the fingerprint is, and both must agree.

The runs hold fingerprints and counts, no texts: verification reads the documents of older batches again.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_path, map_rows, persisted, workspace
from .secrets import _arrow_type

GRAM = 8
MEMO = 300_000
PIECE = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD2 = np.uint64(0xC2B2AE3D27D4EB4F)
#: Most windows that one shuffled row holds.
RUN = 64


class _WordHashes(dict):
    """Word to the 16 bytes of its hash: two hashes of 64 bits that do not depend on each other."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_128_digest(word)
        return h


_hashes = _WordHashes()


def forget_words() -> None:
    """Drop the hashes of words that this process remembers: Python workers outlive their tasks."""
    _hashes.clear()


def split(text: str | None) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _rolling(a: np.ndarray, width: int, base: np.uint64) -> np.ndarray:
    """A polynomial hash of each ``width`` consecutive values."""
    n = len(a) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width):
        out = out * base + a[k : k + n] if n > 0 else out
    return _mixed(out)


def _sliding(f, a: np.ndarray, width: int) -> np.ndarray:
    """``f`` (minimum or maximum) over each ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        a, have = f(a[:-have], a[have:]), 2 * have
    rest = width - have
    return f(a[:-rest], a[rest:]) if rest else a


def word_values(words: list[bytes]) -> np.ndarray:
    """The two hashes of each word, in two rows."""
    return np.ascontiguousarray(np.frombuffer(b"".join(map(_hashes.__getitem__, words)), np.uint64).reshape(-1, 2).T)


def window_fingerprints(values: np.ndarray, width: int) -> np.ndarray:
    """For each window its fingerprint; empty if there are fewer than ``width`` words.

    Least values crowd near zero, so they are mixed once more: equal ones stay equal, and all bits are even again.
    """
    if len(values) < width:
        return values[:0]
    return _mixed(_sliding(np.minimum, _rolling(values, GRAM, _ODD), width - GRAM + 1))


def chosen_grams(values: np.ndarray, width: int) -> np.ndarray:
    """The fingerprints of the windows, once for each place of the gram that gives it."""
    if len(values) < width:
        return values[:0]
    grams = _rolling(values, GRAM, _ODD)
    span = width - GRAM + 1
    least = _sliding(np.minimum, grams, span)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    return _mixed(grams[_sliding(np.maximum, padded, span) == grams])


class FingerprintIndex:
    """Sorted immutable runs of (fp, n), fp being a fingerprint and n the number of places where it occurs."""

    def __init__(self, spark: SparkSession, width: int = 20, fanout: int = 4, buckets: int | None = None):
        self.spark, self.width, self.fanout = spark, width, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[tuple[str, str]] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        name, path = f"fingerprint_run_{uuid.uuid4().hex}", workspace(self.spark, "run")
        rows.select("fp", "n").write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", path).saveAsTable(name)
        self.runs.append((name, path))
        return self.spark.table(name)

    def fingerprints(self, docs: DataFrame, text_col: str) -> DataFrame:
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, PIECE):
                    found = [chosen_grams(word_values(split(t))[0], width) for t in batch.column(0).slice(at, PIECE).to_pylist()]
                    fp, n = np.unique(np.concatenate([*found, np.zeros(0, np.uint64)]), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n.astype(np.int64))], ["fp", "n"])

        return docs.select(text_col).mapInArrow(run, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))

    def ingest(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """Add a batch as a run; return the fingerprints (fp) of the batch that occur again, in it or in an older run."""
        older = [self.spark.table(name) for name, _ in self.runs]
        batch = self._write(self.fingerprints(docs, text_col))
        again = [batch.filter("n > 1").select("fp"), *(batch.join(run, "fp", "left_semi").select("fp") for run in older)]
        repeated = persisted(reduce(DataFrame.unionByName, again), "repeated")
        if len(self.runs) > self.fanout:
            self.compact()
        return repeated

    def compact(self) -> DataFrame:
        """Merge all runs into one, bucket by bucket, and delete the old ones."""
        old = list(self.runs)
        if len(old) > 1:
            merged = self.spark.table(old[0][0])
            for name, _ in old[1:]:
                run = self.spark.table(name).withColumnRenamed("n", "m")
                merged = merged.join(run, "fp", "full_outer").select("fp", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"))
            self._write(merged)
            self._drop(old)
        return self.spark.table(self.runs[0][0])

    def _drop(self, runs: list[tuple[str, str]]) -> None:
        for name, path in runs:
            self.runs.remove((name, path))
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            drop_path(self.spark, path)

    def close(self) -> None:
        self._drop(list(self.runs))


SLICE = 18  # log2 of the bits of one slice of the filter


def _filter_bits(fps: DataFrame, max_bits: int) -> tuple[int, list[tuple[int, bytes]]]:
    """A bit set over the high bits of the fingerprints: log2 of its size, and its slices that are not empty.

    Its size follows the number of fingerprints, 16 bits for each, up to ``max_bits``. Past that it lets more
    windows through to verification, which is exact; nothing is lost.
    """
    n = max(1, fps.count())
    bits = max(SLICE, min((16 * n - 1).bit_length(), max_bits.bit_length() - 1))
    shift = 64 - bits

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(shift)
            for s in np.unique(at >> np.uint64(SLICE)):
                one = made.setdefault(int(s), np.zeros(1 << SLICE, bool))
                one[(at[at >> np.uint64(SLICE) == s] & np.uint64((1 << SLICE) - 1)).astype(np.int64)] = True
        for s, one in made.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([np.packbits(one).tobytes()], pa.binary())], ["s", "b"])

    dealt = fps.select("fp", F.shiftrightunsigned("fp", shift + SLICE).alias("s")).repartition("s").select("fp")
    return bits, [(r["s"], bytes(r["b"])) for r in dealt.mapInArrow(slices, "s long, b binary").collect()]


class _Filter:
    """The filter and the hot fingerprints, unpacked once in each Python worker."""

    made: dict = {}

    def __init__(self, bits: int, slices: list[tuple[int, bytes]], hot: np.ndarray, salts: np.ndarray):
        self.shift, self.hot, self.of_hot = np.uint64(64 - bits), hot, salts
        self.packed = np.zeros(1 << (bits - 3), np.uint8)
        for s, b in slices:
            self.packed[s << (SLICE - 3) : (s + 1) << (SLICE - 3)] = np.frombuffer(b, np.uint8)

    @classmethod
    def of(cls, shared) -> _Filter:
        if shared.id_ not in cls.made:
            cls.made.clear()
            cls.made[shared.id_] = cls(*shared.value)
        return cls.made[shared.id_]

    def passes(self, fp: np.ndarray) -> np.ndarray:
        at = fp >> self.shift
        return (self.packed[(at >> np.uint64(3)).astype(np.int64)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)).astype(bool)

    def salts(self, fp: np.ndarray) -> np.ndarray:
        """Over how many tasks the windows of each fingerprint are dealt."""
        if not len(self.hot):
            return np.ones(len(fp), np.int32)
        at = np.minimum(np.searchsorted(self.hot, fp), len(self.hot) - 1)
        return np.where(self.hot[at] == fp, self.of_hot[at], 1).astype(np.int32)


class _Shared:
    """A broadcast value with a name that workers know it by."""

    def __init__(self, spark: SparkSession, value):
        self.id_, self.held = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.held.value


def candidate_windows(docs: DataFrame, shared: _Shared, width: int) -> DataFrame:
    """(fp, salts, start, hs) and the columns of ``docs`` but the text: the windows that pass the filter.

    Neighbouring windows of one fingerprint share a row: ``hs`` has a hash of 64 bits for each, the first of which
    begins at word ``start``. ``docs`` has doc_id, perhaps tk, and text, in this order.
    """
    keys = docs.columns[:-1]
    schema = pa.schema([pa.field("fp", pa.int64()), pa.field("salts", pa.int32()), pa.field("start", pa.int32()), pa.field("hs", pa.list_(pa.int64())), *(pa.field(c, _arrow_type(docs, c)) for c in keys)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Filter.of(shared)
        for batch in batches:
            for at in range(0, batch.num_rows, PIECE):
                part = batch.slice(at, PIECE)
                rows: list[list[np.ndarray]] = [[] for _ in range(5)]
                for i, text in enumerate(part.columns[-1].to_pylist()):
                    values = word_values(split(text))
                    fp = window_fingerprints(values[0], width)
                    keep = np.flatnonzero(known.passes(fp)) if len(fp) else np.zeros(0, np.int64)
                    if len(keep):
                        held = fp[keep]
                        fresh = np.ones(len(keep), bool)
                        fresh[1:] = (held[1:] != held[:-1]) | (keep[1:] != keep[:-1] + 1) | (keep[1:] % RUN == 0)
                        first = np.flatnonzero(fresh)
                        for column, v in zip(rows, (held[first], keep[first], np.diff(first, append=len(keep)), _rolling(values[1], width, _ODD2)[keep], np.full(len(first), i)), strict=True):
                            column.append(v)
                if rows[0]:
                    fp, start, size, hs, doc = (np.concatenate(r) for r in rows)
                    take = pa.array(doc)
                    ends = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(ends, pa.array(hs.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(known.salts(fp)), pa.array(start.astype(np.int32)), lists, *(c.take(take) for c in part.columns[:-1])], schema=schema)

    return docs.mapInArrow(run, ", ".join(["fp long", "salts int", "start int", "hs array<long>", *(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keys)]))


def repeated_windows(docs: DataFrame, index: FingerprintIndex, repeated: DataFrame, max_bits: int = 1 << 31, hot_places: int = 20_000, most_hot: int = 1_000_000) -> DataFrame:
    """(doc_id, perhaps tk, start) of each window whose words also start earlier: smaller id, or same id and smaller start.

    The windows of a fingerprint with ``hot_places`` places or more (of more, once over ``most_hot`` fingerprints could
    have as many: the list of them is broadcast) are dealt by id over as many tasks as they have times that number of
    places: all but the first in a task are marked there, and the firsts of the tasks, a few for each window, are then
    compared with each other.
    """
    spark = docs.sparkSession
    run = index.compact()
    total = run.agg(F.sum("n")).first()[0] or 0
    least = max(hot_places, -(-total // most_hot))
    hot = sorted((r["fp"] % (1 << 64), -(-r["n"] // least)) for r in run.filter(F.col("n") >= least).collect())
    shared = _Shared(spark, (*_filter_bits(repeated, max_bits), np.array([h for h, _ in hot], np.uint64), np.array([n for _, n in hot], np.int32)))
    # rows of one id are one document: equal places are ties, and neither is earlier
    order = [F.asc_nulls_last("doc_id"), F.asc("start")]
    keys = [*docs.columns[:-1], "start"]
    packed = candidate_windows(docs, shared, index.width).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("salts")).cast("int"))
    dealt = packed.repartition("fp", "salt").select("fp", "salts", "salt", *docs.columns[:-1], "start", F.posexplode("hs").alias("i", "h")).withColumn("start", F.col("start") + F.col("i")).drop("i")
    ranked = dealt.withColumn("nth", F.rank().over(Window.partitionBy("fp", "salt", "h").orderBy(*order)))
    # both filters ask for the same columns and cannot be pushed below the window: the branches then share one exchange
    marked = ranked.filter("nth > CASE WHEN salts > 0 THEN 1 END").select(keys)
    if hot:
        firsts = ranked.filter("nth = CASE WHEN salts > 1 THEN 1 END").select("fp", "h", *keys)
        later = firsts.withColumn("nth", F.rank().over(Window.partitionBy("fp", "h").orderBy(*order))).filter("nth > 1")
        marked = marked.unionByName(later.select(keys))
    return marked


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, batches: int = 2, with_text: bool = False, **options) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and, on request, the kept text.

    ``docs`` is fed to an index in ``batches`` batches by id. A word is removed if some window that covers it also
    starts earlier; windows are those of the input. Null, empty and short texts have no window and lose nothing
    (null counts as empty). Rows with the same id count as one document, which is not earlier than itself; each is
    answered for its own text. Rows without id come after all others. Kept words are joined by one space. An empty
    table gives an empty result. ``options`` go to ``repeated_windows``.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).alias("doc_id"))
    unique = not ids.groupBy("doc_id").count().filter("count > 1").limit(1).count()
    # texts are told apart by a hash where rows share an id
    tk = [] if unique else [F.coalesce(F.xxhash64(text_col), F.lit(0)).alias("tk")]
    rows = docs.select(F.col(id_col).alias("doc_id"), *tk, F.col(text_col).alias("text"))
    index = FingerprintIndex(spark, width)
    try:
        found = [index.ingest(b) for b in _by_id(rows, batches)]
        marks = repeated_windows(rows, index, reduce(DataFrame.unionByName, found).distinct(), **options)
    finally:
        index.close()
    keys = rows.columns[:-1]
    per_doc = marks.groupBy(*keys).agg(F.collect_list("start").alias("starts")).withColumnsRenamed({c: f"_{c}" for c in keys})
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(per_doc[f"_{c}"]) for c in keys])
    joined = rows.join(per_doc, same, "left").select("doc_id", "text", "starts")

    def kept(ids_: list, texts: list, starts: list) -> list:
        out: list[list] = [ids_, [], [], [], []]
        for text, at in zip(texts, starts, strict=True):
            words = split(text)
            left = words
            if at:
                first = np.asarray(at)
                size = len(words) + 1
                gone = np.cumsum(np.bincount(first, minlength=size) - np.bincount(first + width, minlength=size))[:-1] > 0
                left = [w for w, g in zip(words, gone, strict=True) if not g]
            line = b" ".join(left)
            for column, v in zip(out[1:], (len(words), len(words) - len(left), hashlib.sha256(line).hexdigest(), line.decode("utf-8", "replace") if with_text else None), strict=True):
                column.append(v)
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    fields = [pa.field("doc_id", _arrow_type(rows, "doc_id")), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept_sha256", pa.string()), pa.field("kept_text", pa.string())]
    out = map_rows(joined, kept, fields, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
    return out if with_text else out.drop("kept_text")


def _by_id(rows: DataFrame, batches: int) -> list[DataFrame]:
    """``rows`` in batches of rising ids, those without id in the last."""
    cuts = [c for c in (rows.approxQuantile("doc_id", [k / batches for k in range(1, batches)], 0.01) if batches > 1 else [])] if rows.schema["doc_id"].dataType.typeName() in ("long", "integer") else []
    if not cuts:
        return [rows]
    edges = [None, *sorted(set(cuts)), None]
    out = []
    for low, high in zip(edges, edges[1:], strict=False):
        cond = F.lit(True)
        if low is not None:
            cond &= (F.col("doc_id") > low) | (F.col("doc_id").isNull() if high is None else F.lit(False))
        if high is not None:
            cond &= F.col("doc_id") <= high
        out.append(rows.filter(cond))
    return out


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (SELECT doc_id, s, array_to_string(w[s + 1 : s + 20], ' ') AS k FROM d, LATERAL (SELECT unnest(range(len(w) - 19)) AS s)),
later AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, p FROM later, LATERAL (SELECT unnest(range(s, s + 20)) AS p)),
spread AS (SELECT doc_id, p, w[p + 1] AS word FROM d, LATERAL (SELECT unnest(range(len(w))) AS p)),
kept AS (SELECT s.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY s.p) AS line FROM spread s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p WHERE g.p IS NULL GROUP BY s.doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(line, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
