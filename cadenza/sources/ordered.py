"""One CSV file in order, written by many tasks.

The rows are range-partitioned by their order, so that the tasks' parts follow each other. Each attempt of a task writes a
part of its own under a hidden name; at commit the parts of the attempts that succeeded are put one after the other below the
header, a few megabytes at a time, and the file takes its place in one move. Retries and speculative attempts leave no rows twice;
a job that fails leaves what was there before. With ``parts`` the parts are kept as files of their own, each with the header and
numbered in order, and nothing is copied.

Cells are text as the usual Python and Rust writers print it: numbers with a column's decimals, or in the shortest form that reads
back as the same number (0.0002505, 2e-05); True and False; lists in brackets; nulls are empty. Cells are quoted where they must be.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from cadenza.sources.files import store

COPIED = 8 << 20


def cell(value, places: int | None) -> str:
    if value is None:
        return ""
    if places is not None and isinstance(value, (int, float)) and not isinstance(value, bool):
        return f"{value:.{places}f}"
    if isinstance(value, list):
        return "[" + ", ".join(repr(v) for v in value) + "]"
    return value if isinstance(value, str) else repr(value) if isinstance(value, float) else str(value)


@dataclass
class _Part(WriterCommitMessage):
    task: int
    name: str
    rows: int


class _Writer(DataSourceWriter):
    def __init__(self, options, columns: list[str]) -> None:
        self.path, self.columns, self.job = options["path"].rstrip("/"), columns, uuid.uuid4().hex
        self.places, self.end = json.loads(options.get("places", "{}")), options.get("line_end", "\n")
        self.parts = str(options.get("parts", "false")).lower() == "true"

    def _hidden(self, at: str) -> str:
        folder, _, name = at.rpartition("/")
        return f"{folder}/_{name}.{self.job}"

    def _text(self, rows) -> str:
        out = io.StringIO()
        csv.writer(out, lineterminator=self.end).writerows(rows)
        return out.getvalue()

    def header(self) -> bytes:
        return self._text([self.columns]).encode()

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        system, at = store(self.path)
        hidden = self._hidden(at)
        system.create_dir(hidden, recursive=True)
        context = TaskContext.get()
        name, n = f"{uuid.uuid4().hex}.csv", 0
        places = [self.places.get(c) for c in self.columns]
        with system.open_output_stream(f"{hidden}/{name}", compression=None) as out:
            if self.parts:
                out.write(self.header())
            for row in iterator:
                out.write(self._text([[cell(v, p) for v, p in zip(row, places, strict=True)]]).encode())
                n += 1
        return _Part(context.partitionId() if context else 0, name, n)

    def commit(self, messages) -> None:
        system, at = store(self.path)
        hidden = self._hidden(at)
        system.create_dir(hidden, recursive=True)
        written = sorted((m for m in messages if m), key=lambda m: m.task)
        if self.parts:
            whole = f"{hidden}/whole"
            system.create_dir(whole, recursive=True)
            for k, m in enumerate([m for m in written if m.rows] or written[:1]):
                system.move(f"{hidden}/{m.name}", f"{whole}/part-{k:05d}.csv")
        else:
            whole = f"{hidden}/whole.csv"
            with system.open_output_stream(whole, compression=None) as out:
                out.write(self.header())
                for m in written:
                    with system.open_input_stream(f"{hidden}/{m.name}", compression=None) as part:
                        while data := part.read(COPIED):
                            out.write(data)
        self._remove(system, at)
        system.move(whole, at)
        system.delete_dir(hidden)

    def _remove(self, system, at: str) -> None:
        kind = system.get_file_info(at).type.name
        if kind == "Directory":
            system.delete_dir(at)
        elif kind == "File":
            system.delete_file(at)

    def abort(self, messages) -> None:
        system, at = store(self.path)
        self._remove(system, self._hidden(at))


class OrderedCsv(DataSource):
    """``df.write.format("ordered_csv")``. Options: path, places (JSON: column to decimals), line_end, parts."""

    @classmethod
    def name(cls) -> str:
        return "ordered_csv"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if not overwrite:
            raise ValueError("an ordered file is written whole: use mode overwrite")
        return _Writer(self.options, schema.fieldNames())


def write_ordered(table: DataFrame, path: str, order: list[str], columns: list[str] | None = None, places: dict[str, int] | None = None, line_end: str = "\n", parts: bool = False) -> None:
    """``columns`` (all, if None) of the table as CSV at ``path``, by ``order``."""
    table.sparkSession.dataSource.register(OrderedCsv)
    columns = columns or table.columns
    rows = table.orderBy(*order).select(*(f"`{c}`" for c in columns))
    own = {c: p for c, p in (places or {}).items() if c in columns}
    rows.write.format("ordered_csv").option("places", json.dumps(own)).option("line_end", line_end).option("parts", parts).mode("overwrite").save(path)
