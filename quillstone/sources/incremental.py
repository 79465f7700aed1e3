"""Landed files as a data source that reads only what a run has to: pruned by cursor, a task per file or archive member, rows streamed.

Planning lists the files and keeps those that pass the filters on ``modified``, ``path`` and ``member``; Spark pushes these down. An archive's directory is read in
planning, so that each of its members is a partition of its own and inflates as it is read. Text tables go through one state machine from the first byte to the
last, so quoted line ends stay in their cells; of a workbook the first sheet is read event by event. What one task holds at once is a batch of rows
(and a workbook's shared strings), whatever the size of a file. Files whose bytes an earlier run has read, by their SHA-256, are skipped by the task that would parse them.
"""

from __future__ import annotations

import csv
import hashlib
import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from functools import reduce
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith

from quillstone.sources.readers import sniff

SCHEMA = "path string, modified timestamp, bytes long, member string, place long, row map<string,string>"
ROWS = 2048
HEAD = 1 << 16
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


@dataclass
class Part(InputPartition):
    """A file, or a member of an archive; several where a limit has to be kept over all."""

    items: list[tuple[str, datetime, int, str]]


def _files(path: str):
    """(file system, its paths) of a folder or file, in order of path; hidden ones left out."""
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    info = system.get_file_info(root)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(root, recursive=True))
    return system, sorted((f for f in found if f.type == fs.FileType.File and not re.search(r"(^|/)[._][^/]*(/|$)", f.path[len(root) :])), key=lambda f: f.path)


def _utc(value):
    return value.astimezone(UTC) if isinstance(value, datetime) else value


def _passes(test: Filter, value) -> bool:
    if isinstance(test, IsNotNull):
        return value is not None
    if isinstance(test, In):
        return value in {_utc(v) for v in test.value}
    want = _utc(test.value)
    compare = {EqualTo: lambda: value == want, GreaterThan: lambda: value > want, GreaterThanOrEqual: lambda: value >= want, LessThan: lambda: value < want, LessThanOrEqual: lambda: value <= want}
    compare |= {StringStartsWith: lambda: value.startswith(want), StringEndsWith: lambda: value.endswith(want)}
    return compare[type(test)]()


PUSHED = (EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith)


class LandedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.tests = dict(options), []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if isinstance(f, PUSHED) and f.attribute in (("modified",), ("path",), ("member",)):
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Part]:
        system, files = _files(self.options["path"])
        dated, found = self.options.get("dated"), []
        for f in files:
            when = f.mtime.astimezone(UTC)
            if dated and (m := re.search(dated, f.path)):
                when = datetime.fromisoformat(m[1]).replace(tzinfo=UTC)
            known = {"modified": when, "path": f.path}
            if not all(_passes(t, known[t.attribute[0]]) for t in self.tests if t.attribute[0] in known):
                continue
            members = [""]
            if f.path.lower().endswith(".zip"):
                with system.open_input_file(f.path) as stream, zipfile.ZipFile(stream) as archive:
                    members = [m.filename for m in archive.infolist() if m.filename.lower().endswith((".csv", ".txt", ".tsv"))]
            found += [(f.path, when, f.size, m) for m in members if all(_passes(t, m) for t in self.tests if t.attribute == ("member",))]
        return [Part(found)] if "limit" in self.options else [Part([x]) for x in found]

    def read(self, part: Part | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # nothing passed: Spark asks once all the same
            return
        system, _ = _files(self.options["path"])
        left = int(self.options.get("limit", -1))
        seen = self._seen()
        for path, when, size, member in part.items:
            if left == 0:
                return
            if seen and _checksum(system, path) in seen:
                continue
            with system.open_input_file(path) as stream:
                place = 0
                for rows in _batches(_rows(stream, path, member, self.options)):
                    rows = rows if left < 0 else rows[:left]
                    n = len(rows)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([path] * n, pa.string()), pa.array([when] * n, pa.timestamp("us", "UTC")), pa.array([size] * n, pa.int64()), pa.array([member or None] * n, pa.string()), pa.array(range(place, place + n), pa.int64()),
                        pa.array([list(r.items()) for r in rows], pa.map_(pa.string(), pa.string())),
                    ], names=["path", "modified", "bytes", "member", "place", "row"])
                    place += n
                    if left > 0:
                        left -= n
                    if left == 0:
                        break

    def _seen(self) -> set[str]:
        if "seen" not in self.options:
            return set()
        system, files = _files(self.options["seen"])
        out: set[str] = set()
        for f in files:
            with system.open_input_file(f.path) as stream:
                out |= set(stream.read().decode().split())  # a line per file that was read before
        return out


def _checksum(system, path: str) -> str:
    digest = hashlib.sha256()
    with system.open_input_stream(path) as stream:
        while block := stream.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def _batches(rows: Iterator[dict[str, str]]) -> Iterator[list[dict[str, str]]]:
    held: list[dict[str, str]] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield held
            held = []
    if held:
        yield held


def _rows(stream, path: str, member: str, options: dict[str, str]) -> Iterator[dict[str, str]]:
    if path.lower().endswith(".xlsx"):
        with zipfile.ZipFile(stream) as book:
            yield from sheet_rows(book)
    elif member:
        with zipfile.ZipFile(stream) as archive:
            with archive.open(member) as part:
                head = part.read(HEAD)
            with archive.open(member) as part:
                yield from table_rows(part, head, options)
    else:
        head = stream.read(HEAD)
        stream.seek(0)
        yield from table_rows(stream, head, options)


def table_rows(stream, head: bytes, options: dict[str, str]) -> Iterator[dict[str, str]]:
    """Rows of a text table as it streams by, headers in lower case, values stripped; rows that are shorter have empty cells, longer ones lose what has no header."""
    if not head:
        return
    encoding, sep = sniff(head)
    text = io.TextIOWrapper(stream, options.get("encoding", encoding), errors="replace", newline="")
    lines = csv.reader(text, delimiter=options.get("sep", sep))
    header = [c.strip().lower() for c in next(lines, [])]
    for cells in lines:
        if cells:
            yield {h: cells[i].strip() if i < len(cells) else "" for i, h in enumerate(header)}


def sheet_rows(book: zipfile.ZipFile) -> Iterator[dict[str, str]]:
    """Rows of a workbook's first sheet as it streams by; blank headers are named col_i, blank rows skipped."""
    names, shared = book.namelist(), []
    if "xl/sharedStrings.xml" in names:
        with book.open("xl/sharedStrings.xml") as part:
            for _, item in ElementTree.iterparse(part):
                if item.tag == f"{SHEET}si":
                    shared.append("".join(x.text or "" for x in item.iter(f"{SHEET}t")))
                    item.clear()
    header: list[str] = []
    with book.open(min(n for n in names if n.startswith("xl/worksheets/sheet"))) as part:
        events = ElementTree.iterparse(part, ("start", "end"))
        _, root = next(events)
        for event, row in events:
            if event != "end" or row.tag != f"{SHEET}row":
                continue
            cells: dict[int, str] = {}
            for i, cell in enumerate(row.findall(f"{SHEET}c")):
                letters = re.match("[A-Z]+", cell.get("r", ""))
                value = cell.findtext(f"{SHEET}v", "")
                if cell.get("t") == "s":
                    value = shared[int(value)]
                elif cell.get("t") == "inlineStr":
                    value = "".join(x.text or "" for x in cell.iter(f"{SHEET}t"))
                cells[reduce(lambda a, ch: a * 26 + ord(ch) - 64, letters[0], 0) - 1 if letters else i] = value.strip()
            root.clear()  # what has been read goes, the sheet's rows among it
            if not header:
                header = [(cells.get(i, "") or f"col_{i}").lower() for i in range(max(cells, default=-1) + 1)]
            elif any(cells.values()):
                yield {h: cells.get(i, "") for i, h in enumerate(header)} | {f"col_{i}": v for i, v in cells.items() if i >= len(header)}


class LandedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "landed_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LandedReader:
        return LandedReader(self.options)


def landed(spark: SparkSession, path: str, since: Column | datetime | None = None, limit: int | None = None, seen: str | None = None, **options: str) -> DataFrame:
    """(path, modified, bytes, member, place, row) of landed text tables, archives of them, and workbooks.

    ``since``: only files modified at or after it, which planning prunes; a ``limit`` (so many rows, in order of path) clears it, as a run with a limit
    must not move its cursor past what it left. ``seen``: a file of checksums, one a line, whose files are skipped. Options: sep, encoding, and
    dated, a pattern whose first group is a file's date in its path, which counts in place of the time of change. The source lets Spark push filters down to it, which the session has to allow; this does.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LandedFiles)
    own = options | ({} if limit is None else {"limit": str(limit)}) | ({} if seen is None else {"seen": seen})
    rows = spark.read.format("landed_files").options(**own).load(path)
    return rows if since is None or limit is not None else rows.filter(F.col("modified") >= since)
