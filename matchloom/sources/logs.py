"""Ledgers as files: a data source that reads delimited logs whatever a run that died left in them, and appends to them.

``spark.dataSource.register(LedgerFiles)``, then ``spark.read.format("ledger").schema(...).load(path)`` and
``df.write.format("ledger").mode("append").save(path)``. Columns of the schema are those of the log, in its order, plus any of

* ``_file`` (string) and ``_at`` (long): where the row stands; together they give the order in which rows were appended;
* ``_fault`` (string): null for a row that counts, else why it does not. A schema without it gets rows that count only.

A row counts if it has a value for each column, or for the last ones alone where the log was begun before ``added`` columns
(an option) were put in front, and if the column named by the option ``key`` is a whole number. Values of other kinds than the
schema asks for are null. Bytes that are no UTF-8 are replaced.
"""

from __future__ import annotations

import csv
import datetime
import io
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, FloatType, IntegerType, LongType, StringType, StructType, TimestampType

from .files import listed, open_store

#: Bytes of a file that one task reads.
STRETCH = 32 << 20
FAULTS = {"short": "fewer values than columns", "long": "more values than columns", "empty": "nothing", "key": "the key is no whole number"}
_OWN = ("_file", "_at", "_fault")


@dataclass
class Stretch(InputPartition):
    path: str
    name: str
    begin: int
    end: int


class LedgerFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "ledger"

    def schema(self) -> str:
        raise ValueError("a ledger is read with a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a ledger is appended to only")
        return _Writer(self.options, schema)


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.columns = [f.name for f in schema if f.name not in _OWN]
        self.key, self.added, self.stretch = options.get("key"), int(options.get("added", 1)), int(options.get("stretch", STRETCH))

    def partitions(self) -> list[Stretch]:
        """Stretches of files; a line belongs to the one that its first byte is in."""
        _, base = open_store(self.path)
        return [Stretch(f.path, f.path[len(base) :].strip("/"), at, min(f.size, at + self.stretch)) for f in listed(self.path) for at in range(0, f.size, self.stretch)]

    def read(self, part: Stretch | None) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(self.schema)
        rows: list[tuple] = []
        for at, line in _lines(*open_store(self.path)[:1], part) if part else ():
            values, fault = self._row(line)
            if fault is None or "_fault" in self.schema.names:
                own = {"_file": part.name, "_at": at, "_fault": fault}
                rows.append(tuple(own[f.name] if f.name in own else _typed(values.get(f.name), f.dataType) for f in self.schema))
            if len(rows) == 10_000:
                yield _batch(rows, arrow)
                rows = []
        if rows:
            yield _batch(rows, arrow)

    def _row(self, line: bytes) -> tuple[dict[str, str], str | None]:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        try:
            cells = next(csv.reader([text]), [])
        except csv.Error:
            cells = text.split(",")
        missing = len(self.columns) - len(cells)
        if not text.strip():
            return {}, "empty"
        if missing < 0:
            return {}, "long"
        if missing > self.added:
            return {}, "short"
        values = dict(zip(self.columns[missing:], cells, strict=True))
        if self.key and not re.fullmatch(r"\s*[+-]?\d{1,18}\s*", values.get(self.key, "")):
            return values, "key"
        return values, None


def _lines(fs: pyarrow.fs.FileSystem, part: Stretch) -> Iterator[tuple[int, bytes]]:
    """(place, line) of the lines that begin in the stretch; the last may end behind it."""
    with fs.open_input_file(part.path) as f:
        at = max(0, part.begin - 1)
        f.seek(at)
        source = io.BufferedReader(f, 1 << 20)
        if part.begin:
            # the line that the byte before the stretch is part of is another's
            at += len(source.readline())
        while at < part.end and (line := source.readline()):
            yield at, line
            at += len(line)


def _typed(text: str | None, kind):
    if text is None or isinstance(kind, StringType):
        return text
    try:
        if isinstance(kind, (LongType, IntegerType)):
            value, bits = int(text), 64 if isinstance(kind, LongType) else 32
            return value if -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None
        if isinstance(kind, (DoubleType, FloatType)):
            return float(text)
        if isinstance(kind, TimestampType):
            value = datetime.datetime.fromisoformat(text)
            return value if value.tzinfo else value.replace(tzinfo=datetime.UTC)
    except ValueError:
        return None
    raise TypeError(f"a ledger holds no {kind.simpleString()}")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _text(value) -> str:
    if value is None:
        return ""
    if isinstance(value, datetime.datetime):
        return value.astimezone(datetime.UTC).isoformat()
    return re.sub(r"[\r\n]+", " ", str(value))


@dataclass
class Written(WriterCommitMessage):
    draft: str
    task: int


class _Writer(DataSourceWriter):
    """Each task writes a draft; what the tasks that count wrote becomes one folder, in one step, numbered after the last."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.columns, self.job = options["path"], schema.names, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Written:
        fs, base = open_store(self.path)
        task, draft = TaskContext.get().partitionId(), f"{base}/_drafts/{self.job}/{uuid.uuid4().hex}"
        fs.create_dir(draft.rpartition("/")[0], recursive=True)
        with fs.open_output_stream(draft, compression=None) as out:
            text = io.StringIO()
            line = csv.writer(text, lineterminator="\n")
            for row in rows:
                # a line is a row, so line ends within a value become spaces
                line.writerow([_text(v) for v in row])
                if text.tell() > 1 << 20:
                    out.write(text.getvalue().encode("utf-8", "replace"))
                    text.seek(0)
                    text.truncate()
            out.write(text.getvalue().encode("utf-8", "replace"))
        return Written(draft, task)

    def commit(self, messages: list[Written | None]) -> None:
        fs, base = open_store(self.path)
        folder = f"{base}/_drafts/{self.job}-done"
        fs.create_dir(folder, recursive=True)
        for m in messages:
            if m is not None:
                fs.move(m.draft, f"{folder}/part-{m.task:06d}.csv")
        before = fs.get_file_info(pyarrow.fs.FileSelector(base, allow_not_found=True))
        last = max((int(m[1]) for f in before if (m := re.fullmatch(r"run-(\d+)", f.base_name))), default=0)
        fs.move(folder, f"{base}/run-{last + 1:012d}")
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        """Remove this job's drafts, those of tasks that ran twice among them."""
        fs, base = open_store(self.path)
        for name in (self.job, f"{self.job}-done"):
            if fs.get_file_info(f"{base}/_drafts/{name}").type != pyarrow.fs.FileType.NotFound:
                fs.delete_dir(f"{base}/_drafts/{name}")
