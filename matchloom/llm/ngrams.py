"""Scoring texts with an interpolated modified Kneser-Ney n-gram model.

Counting is a chain of shuffles, one for each order from the highest down. Tasks count the n-grams of stretches of text
as columns of 64-bit hashes and deal them out by context; a task for each bucket adds up, writes its n-grams as sorted
hash arrays to the shared folder, and hands on what the next lower order counts, the distinct words to the left of each
shorter n-gram. A context with more tokens than a bucket should hold is split over several buckets by the last word. The
number of buckets follows the size of the texts, so that no task's share grows with them. Scoring maps the arrays into
memory: many lookups at a time, sorted, and only the pages that are touched are read.

The end of a text is a token, its beginning a context of its own. The text of a document is one sentence.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_path, persisted, release, workspace
from .secrets import _arrow_type
from .warc import open_store

ORDER = 2
#: Bytes of text whose n-grams one bucket holds, about; the most contexts that are split; tokens counted or scored at a time.
BUCKET_BYTES, MOST_SPLIT = 12 << 20, 4096
COUNTED, SCORED = 1_000_000, 400_000
MEMO = 300_000
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: A-Z to a-z.
LOWER = bytes(i + 32 if 0x41 <= i <= 0x5A else i for i in range(256))
# no word holds a space
END, START = (np.uint64(xxhash.xxh3_64_intdigest(x)) for x in (b" end", b" start"))
EMPTY = np.uint64(0x51ED270B_27B4F3CF)


class _Words(dict):
    """Word to the 8 bytes of its hash."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
        return h


_words = _Words()


def tokens(text: str | None) -> np.ndarray:
    """Hashes of the words between ASCII white space, A-Z lowered, and of the end; null has the end only."""
    found = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    return np.append(np.frombuffer(b"".join(map(_words.__getitem__, found)), np.uint64), END)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def contexts(w: np.ndarray, lengths: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1, 2, ... the hash of the n-1 tokens before each token; what stands before a text is ``START``."""
    inside = np.arange(len(w)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = [np.full(len(w), EMPTY)]
    for j in range(1, order):
        before = np.full(len(w), START)
        before[j:] = np.where(inside[j:] >= j, w[:-j], START)
        out.append(mixed(out[-1] * _ODD + before))
    return out


def gram_keys(context: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mixed(context * _ODD2 + w)


def stretches(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(batch slices, tokens, lengths): consecutive rows of about ``most`` tokens, whole texts only."""
    parts, found, held = [], [], 0
    for batch in batches:
        at = 0
        for i, text in enumerate(batch.column(column)):
            found.append(tokens(text.as_py()))
            held += len(found[-1])
            if held >= most:
                parts.append(batch.slice(at, i + 1 - at))
                yield parts, np.concatenate(found), np.array([len(x) for x in found])
                parts, found, held, at = [], [], 0, i + 1
        parts.append(batch.slice(at))
    if found:
        yield parts, np.concatenate(found), np.array([len(x) for x in found])


@dataclass
class Model:
    """Where the arrays are, and what is small: buckets of each order, contexts that are split with their sums, discounts."""

    folder: str
    order: int
    buckets: list[int]
    split: list[np.ndarray] = field(default_factory=list)  # sorted hashes, by order
    over: list[np.ndarray] = field(default_factory=list)  # how many buckets each is split over
    sums: list[np.ndarray] = field(default_factory=list)  # (total, words seen once, twice, more often) of each
    discounts: list[np.ndarray] = field(default_factory=list)
    train_tokens: int = 0

    def bucket(self, n: int, context: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Where the n-grams of ``context`` and ``w`` are kept."""
        parts, split = np.uint64(self.buckets[n - 1]), self.split[n - 1]
        at = np.minimum(np.searchsorted(split, context), max(0, len(split) - 1))
        over = np.where(split[at] == context, self.over[n - 1][at], np.uint64(1)) if len(split) else np.ones(len(w), np.uint64)
        return ((context >> np.uint64(20)) + (w >> np.uint64(12)) % over) % parts

    @property
    def vocabulary(self) -> int:
        return int(self.sums[0][1:, 0].sum()) if self.sums else 0


def for_training(id_col: str) -> F.Column:
    """True for the rows that are learned from; a null id is not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 != 2, F.lit(False))


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def _frequent(docs: DataFrame, text_col: str, order: int, share: float) -> tuple[int, list[dict[int, int]]]:
    """(tokens, and by order the contexts that may have ``share`` of all tokens or more, with a lower bound of their number).

    In each stretch the contexts of half that share are told; who has the share overall is told often enough to reach half of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w, lengths in stretches(batches, 0, COUNTED):
            rows = [(0, 0, len(w))]
            for n, c in enumerate(contexts(w, lengths, order)[1:], start=2):
                h, count = np.unique(c, return_counts=True)
                often = count >= share / 2 * len(w)
                rows += [(n, x, y) for x, y in zip(h[often].view(np.int64).tolist(), count[often].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], ["n", "h", "count"])

    counted = docs.select(text_col).mapInArrow(run, "n long, h long, count long").groupBy("n", "h").agg(F.sum("count").alias("count"))
    counted = persisted(counted, "contexts")
    total = (counted.filter("n = 0").first() or {"count": 0})["count"]
    found: list[dict[int, int]] = [{} for _ in range(order)]
    # at most 2 / share contexts of an order can reach half of it
    for r in counted.filter((F.col("n") > 0) & (F.col("count") >= share / 2 * total)).toLocalIterator():
        found[r["n"] - 1][r["h"] & (2**64 - 1)] = r["count"]
    release(counted)
    return total, found


COUNTS = "kind string, n int, bucket int, a binary, b binary, c binary, d binary, e binary, f binary"
_NAMES = [f.split()[0] for f in COUNTS.split(", ")]


def _row(kind: str, n: int, bucket: int, *arrays: np.ndarray) -> tuple:
    return (kind, n, bucket, *(x.tobytes() for x in arrays), *[b""] * (6 - len(arrays)))


def _rows(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in _NAMES]
    kinds = [pa.string(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    return pa.table([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], _NAMES)


def _dealt(model: Model, n: int, before: list[np.ndarray], w: np.ndarray, count: np.ndarray, raw: np.ndarray) -> list[tuple]:
    """Rows of n-grams, packed by bucket: contexts with the number of their words, then the values of each word.

    ``before`` has the contexts of n, n-1, ..., 2 tokens' n-grams (of one token: the empty one).
    """
    bucket = model.bucket(n, before[0], w)
    order = np.lexsort((w, before[0], bucket))
    bucket, w, count, raw = bucket[order], w[order], count[order], raw[order]
    context, *shorter = (x[order] for x in before)
    first = _starts(bucket, context)
    size = np.diff(np.append(first, len(w))).astype(np.uint32)
    cuts = _starts(bucket)
    rows = []
    for a, b in zip(cuts, np.append(cuts[1:], len(w)), strict=True):
        i, j = np.searchsorted(first, [a, b])
        rest = np.concatenate([w[:0], *(x[a:b] for x in shorter)])
        rows.append(_row("gram", n, int(bucket[a]), context[first[i:j]], size[i:j], w[a:b], rest, _least(count[a:b]), _least(raw[a:b])))
    return rows


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before it."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], np.any([c[1:] != c[:-1] for c in columns], axis=0)]))


def _least(x: np.ndarray) -> np.ndarray:
    """32 bits where they are enough; who reads tells by the length."""
    return x.astype(np.uint32) if not len(x) or x.max() < 2**32 else x.astype(np.uint64)


def _counts(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, np.uint32 if len(blob) == 4 * n else np.uint64).astype(np.uint64)


def _count_text(docs: DataFrame, text_col: str, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, w, lengths in stretches(batches, 0, COUNTED):
            before = contexts(w, lengths, model.order)[1:][::-1]
            _, at, count = np.unique(gram_keys(before[0], w), return_index=True, return_counts=True)
            count = count.astype(np.uint64)
            yield from _rows(_dealt(model, model.order, [x[at] for x in before], w[at], count, count)).to_batches()

    return docs.select(text_col).mapInArrow(run, COUNTS)


def _store(folder: str, n: int, bucket: int, arrays: dict[str, np.ndarray]) -> None:
    """Write arrays as files of their own; a task that runs twice puts the same bytes in their place."""
    fs, base = open_store(folder)
    fs.create_dir(base, recursive=True)
    for name, x in arrays.items():
        path, draft = f"{base}/{n}-{bucket}-{name}.npy", f"{base}/{uuid.uuid4().hex}"
        with fs.open_output_stream(draft, compression=None) as out:
            np.lib.format.write_array(out, np.ascontiguousarray(x), allow_pickle=False)
        fs.move(draft, path)


def _narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if x.size else 0))


def _add_up(model: Model, n: int, level: DataFrame) -> DataFrame:
    """Add up the n-grams of one order and store them; rows of the next lower order, of split contexts and of counts of counts."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        parts = []
        for a, b, c, d, e, f in zip(*(rows.column(x) for x in "abcdef"), strict=True):
            context, size, w = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint32), np.frombuffer(c.as_buffer(), np.uint64)
            parts.append((np.repeat(context, size), w, _counts(e.as_py(), len(w)), _counts(f.as_py(), len(w)), *np.frombuffer(d.as_buffer(), np.uint64).reshape(-1, len(w))))
        context, w, count, raw, *shorter = (np.concatenate(x) for x in zip(*parts, strict=True))
        parts.clear()
        order = np.lexsort((w, context))
        first = _starts(context[order], w[order])
        count, raw = np.add.reduceat(count[order], first), np.add.reduceat(raw[order], first)
        context, w, *shorter = (x[order[first]] for x in (context, w, *shorter))
        # of each context: total, words seen once, twice, more often
        first = _starts(context)
        sums = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (count, count == 1, count == 2, count > 2)])
        own = context[first]
        parted = np.isin(own, model.split[n - 1])
        out = [_row("split", n, key[0], own[parted], np.ascontiguousarray(sums[:, parted])), _row("stat", n, key[0], np.bincount(np.minimum(count, 5).astype(np.int64), minlength=6)[1:5])]
        keys = gram_keys(context, w)
        by_key = np.argsort(keys)
        rest = {"raw": _narrow(raw[by_key])} if n == 1 else {"contexts": own[~parted], "sums": _narrow(sums[:, ~parted])}
        _store(model.folder, n, key[0], {"keys": keys[by_key], "counts": _narrow(count[by_key])} | rest)
        if n > 1:
            # a word to the left of the shorter n-gram counts once, however often it stands there
            shorter = shorter or [np.full(len(w), EMPTY)]
            _, at, back = np.unique(gram_keys(shorter[0], w), return_index=True, return_inverse=True)
            total = np.zeros(len(at), np.uint64)
            np.add.at(total, back, raw)
            out += _dealt(model, n - 1, [x[at] for x in shorter], w[at], np.bincount(back, minlength=len(at)).astype(np.uint64), total)
        return _rows(out)

    return level.groupBy("bucket").applyInArrow(run, COUNTS)


def _discounts(t: np.ndarray) -> np.ndarray:
    """What is taken from counts of one, two, and more, from the numbers of n-grams counted once to four times."""
    usual = np.array([0.5, 1.0, 1.5])
    if (t <= 0).any():
        return usual
    y = t[0] / (t[0] + 2 * t[1])
    d = np.array([i - (i + 1) * y * t[i] / t[i - 1] for i in (1, 2, 3)])
    return np.where((d > 0) & (d < [1, 2, 3]), d, usual)


def learn(docs: DataFrame, text_col: str = "text", order: int = ORDER, bucket_bytes: int = BUCKET_BYTES) -> Model:
    """Learn from every row of ``docs``; a null text is one end. ``order`` is two or more.

    The arrays stay below the shared folder until ``forget``. No n-gram is pruned. Counts of two words or more are of the
    highest order only; lower orders count distinct words to the left. Where too few n-grams are counted once to four
    times for discounts to be worked out, they are 0.5, 1 and 1.5. An empty table gives an even distribution.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))).first()[0] or 0
    most = max(1, -(-size // bucket_bytes))
    share = max(0.5 / most, 1 / MOST_SPLIT)
    total, frequent = _frequent(docs, text_col, order, share)
    model = Model(workspace(spark, "ngrams"), order, [max(1, most // 8)] + [most] * (order - 1), train_tokens=total)
    per_bucket = max(1, total // most)
    frequent[0] = {int(EMPTY): model.buckets[0] * per_bucket}
    for n in range(order):
        kept = sorted(frequent[n])
        model.split.append(np.array(kept, np.uint64))
        model.over.append(np.array([min(model.buckets[n], -(-frequent[n][h] // per_bucket) + 1) for h in kept], np.uint64))
        model.sums.append(np.zeros((4, len(kept)), np.int64))
    level, stats = _count_text(docs, text_col, model), np.zeros((order, 4))
    for n in range(order, 0, -1):
        below = persisted(_add_up(model, n, level), "ngram-counts")
        if n < order:
            release(level_at)
        for r in below.filter("kind <> 'gram'").select("kind", "a", "b").toLocalIterator():
            if r["kind"] == "stat":
                stats[n - 1] += np.frombuffer(r["a"], np.int64)
            else:
                at = np.searchsorted(model.split[n - 1], np.frombuffer(r["a"], np.uint64))
                model.sums[n - 1][:, at] += np.frombuffer(r["b"], np.int64).reshape(4, -1)
        level_at, level = below, below.filter("kind = 'gram'")
    release(level_at)
    model.discounts = [_discounts(t) for t in stats]
    return model


def forget(spark, model: Model) -> None:
    """Delete the arrays of a model."""
    drop_path(spark, model.folder)


_maps: dict[str, dict[tuple[int, int, str], np.ndarray | None]] = {}


def _mapped(folder: str, n: int, bucket: int, name: str) -> np.ndarray | None:
    """An array of the model, mapped into this worker's memory; None if the bucket is empty. Workers keep the maps of one model."""
    if folder not in _maps:
        _maps.clear()
        _maps[folder] = {}
    maps, key = _maps[folder], (n, bucket, name)
    if key not in maps:
        try:
            maps[key] = np.load(f"{folder}/{n}-{bucket}-{name}.npy", mmap_mode="r")
        except FileNotFoundError:
            maps[key] = None
        except ValueError:  # an array of no elements cannot be mapped
            maps[key] = np.load(f"{folder}/{n}-{bucket}-{name}.npy")
    return maps[key]


def _found(folder: str, n: int, bucket: np.ndarray, keys: np.ndarray, index: str, values: tuple[str, ...]) -> list[np.ndarray]:
    """For each (sorted) key the values of its entry in the bucket's arrays, zero where there is none."""
    width = {"sums": 4}
    out = [np.zeros((width.get(v, 1), len(keys)), np.int64) for v in values]
    order = np.argsort(bucket, kind="stable")
    cuts = _starts(bucket[order])
    for a, b in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
        here = order[a:b]
        sorted_keys = _mapped(folder, n, int(bucket[here[0]]), index)
        if sorted_keys is None or not len(sorted_keys):
            continue
        wanted = keys[here]
        at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
        hit = sorted_keys[at] == wanted
        for o, v in zip(out, values, strict=True):
            o[:, here[hit]] = np.atleast_2d(_mapped(folder, n, int(bucket[here[0]]), v))[:, at[hit]]
    return out


def log_probabilities(model: Model, folder: str, w: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log10 of the probability of each token, how often each was learned from)."""
    probability, raw = np.full(len(w), 1.0 / (model.vocabulary + 1)), np.zeros(len(w), np.int64)
    for n, context in enumerate(contexts(w, lengths, model.order), start=1):
        # what is known of the context
        distinct, first, back = np.unique(context, return_index=True, return_inverse=True)
        sums, split = np.zeros((4, len(distinct)), np.int64), model.split[n - 1]
        if n > 1:
            sums = _found(folder, n, model.bucket(n, distinct, w[first]), distinct, "contexts", ("sums",))[0]
        if len(split):
            at = np.minimum(np.searchsorted(split, distinct), len(split) - 1)
            sums = np.where(split[at] == distinct, model.sums[n - 1][:, at], sums)
        total = np.maximum(sums[0], 1)
        left = np.where(sums[0] > 0, (model.discounts[n - 1][:, None] * sums[1:]).sum(axis=0) / total, 1.0)
        # and of the word in it
        keys, first, again = np.unique(gram_keys(context, w), return_index=True, return_inverse=True)
        found = _found(folder, n, model.bucket(n, context[first], w[first]), keys, "keys", ("counts", "raw") if n == 1 else ("counts",))
        count = found[0][0]
        share = np.maximum(count - np.where(count > 0, model.discounts[n - 1][np.clip(count, 1, 3) - 1], 0), 0)
        if n == 1:
            raw = found[1][0][again]
        probability = share[again] / total[back] + left[back] * probability
    return np.log10(probability), raw


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of every row of ``docs``, whole texts.

    doc_id, held_out (what ``for_training`` leaves out), n_tokens (words and the end), n_known (tokens learned from),
    train_tokens, base_score (log10 by counts of tokens, one added to each), score (log10 of the text's probability by the
    model) and perplexity, 10 to the mean of minus the score. A null or empty text is its end alone. Repeated rows are
    scored each; other columns do not matter.
    """
    spark, folder = docs.sparkSession, model.folder
    local = isinstance(open_store(folder)[0], pyarrow.fs.LocalFileSystem)
    if not local:
        # each executor fetches the arrays from the store, to map them
        spark.sparkContext.addFile(folder, recursive=True)
    id_type = _arrow_type(docs, id_col)
    per, tokens_seen = model.train_tokens + 1 * (model.vocabulary + 1), model.train_tokens
    kinds = [("doc_id", id_type), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()), ("perplexity", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = open_store(folder)[1] if local else SparkFiles.get(folder.rpartition("/")[2])
        for parts, w, lengths in stretches(batches, 2, SCORED):
            score, raw = log_probabilities(model, place, w, lengths)
            starts = np.cumsum(lengths) - lengths
            known = np.add.reduceat((raw > 0).astype(np.int64), starts)
            base = np.add.reduceat(np.log10((raw + 1) / per), starts)
            total = np.add.reduceat(score, starts)
            values = [lengths.astype(np.int64), known, np.full(len(lengths), tokens_seen), base, total, 10 ** (-total / lengths)]
            head = pa.Table.from_batches(parts).combine_chunks()
            columns = [head.column(0).combine_chunks(), head.column(1).combine_chunks(), *map(pa.array, values)]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, (_, t) in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double")
