"""Report packages as a data source: spark.read.format("report_packages").load(folder)."""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from ledgerloom.sources.packages import ROWS, rows_of

#: Which members can hold rows of a kind; all of them are files.
HOLDS = {"fact": re.compile(r"\.(html?|xbrl)$", re.I), "concept": re.compile(r"\.xsd$", re.I), "loc": re.compile(r"lab[^/]*\.xml$", re.I), "label": re.compile(r"lab[^/]*\.xml$", re.I), "arc": re.compile(r"lab[^/]*\.xml$", re.I)}


#: About how many runs there are of packages that are cut, and the most that a run unpacks to for that.
MOST, LARGEST = 1000, 64 << 20
#: Rows of members go on together, up to so many or from so many bytes.
BATCH_ROWS, BATCH_BYTES = 8192, 4 << 20
#: Of an entry of a zip file's directory: its mark, the unpacked size and the lengths of name, extra field and comment.
ENTRY = "<4s20xL3H"


class Opened(io.RawIOBase):
    """A file of Arrow's as zipfile expects it; with a run, as if that run's entries were all of the package's directory."""

    def __init__(self, file, run: Run):
        self.file, self.at, self.own = file, 0, run.start is not None
        self.cut, self.tail = (run.directory, self.entries(run)) if self.own else (file.size(), b"")

    def entries(self, run: Run) -> bytes:
        """The run's part of the directory and the records that end an archive, with the places they need to be in."""
        self.file.seek(run.start)
        part = self.file.read(run.length)
        after = run.offset + run.length
        ends = struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, run.count, run.count, run.length, run.offset) + struct.pack("<4sLQL", b"PK\6\7", 0, after, 1)
        return part + ends + struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = 0) -> int:
        at = offset + (0, self.at, self.cut + len(self.tail))[whence]
        if at < 0:
            raise OSError("a place before the first byte")
        self.at = at
        return at

    def readinto(self, buffer) -> int:
        if self.at < self.cut:
            self.file.seek(self.at)
            got = self.file.read(min(len(buffer), self.cut - self.at))
        else:
            got = self.tail[self.at - self.cut :][: len(buffer)]
        buffer[: len(got)] = got
        self.at += len(got)
        return len(got)

    def close(self) -> None:
        self.file.close()
        super().close()


def directory_of(file) -> tuple[int, int, bytes]:
    """Where the directory of a zip file begins, where its records say that it does, and the directory; an error without one."""
    size = file.size()
    file.seek(max(0, size - (1 << 16) - 22))
    tail = file.read(size)
    end = tail.rfind(b"PK\5\6")
    if end < 0 or end + 22 > len(tail):
        raise zipfile.BadZipFile("File is not a zip file")
    length, offset = struct.unpack_from("<2L", tail, end + 12)
    begins = size - len(tail) + end
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\6\7":
        begins -= 76
        file.seek(begins)
        if (record := file.read(56))[:4] != b"PK\6\6":
            raise zipfile.BadZipFile("Corrupt zip64 end of central directory record")
        length, offset = struct.unpack_from("<2Q", record, 40)
    start = begins - length
    file.seek(max(0, start))
    entries = file.read(length)
    if start < 0 or len(entries) < length:
        raise zipfile.BadZipFile("Bad offset for central directory")
    return start, offset, entries


@dataclass
class Run(InputPartition):
    """Some members of a package by their part of its directory, or all if it has no start.

    directory is where the directory begins, and offset where the package's own records say so.
    """

    package: str
    start: int | None = None
    length: int = 0
    count: int = 0
    directory: int = 0
    offset: int = 0


class PackageReader(DataSourceReader):
    """Reads packages run by run. A filter on kind decides which members are opened at all."""

    def __init__(self, options: dict[str, str]):
        self.path, self.run_bytes = options["path"], int(options.get("runBytes", 64 << 20))
        self.kinds: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes filters on kind; all are also left to Spark, as a member holds rows of several kinds."""
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("kind",):
                wanted = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.kinds = wanted if self.kinds is None else self.kinds & wanted
            yield f

    def open(self, run: Run) -> zipfile.ZipFile:
        system, path = fs.FileSystem.from_uri(run.package)
        return zipfile.ZipFile(io.BufferedReader(Opened(system.open_input_file(path), run), 1 << 18))

    def wanted(self, member: str) -> bool:
        """Whether a member may hold rows that are asked for; an error of a file is a row of kind file."""
        return self.kinds is None or bool(self.kinds - set(HOLDS)) or any(HOLDS[k].search(member) for k in self.kinds)

    def runs_of(self, package: str, run_bytes: int) -> Iterator[Run]:
        """Runs of members that unpack to about run_bytes each: one pass over the directory, of which a run is a few numbers."""
        system, path = fs.FileSystem.from_uri(package)
        with system.open_input_file(path) as f:
            directory, offset, entries = directory_of(f)
        begin = at = count = size = 0
        while at < len(entries):
            mark, unpacked, name, extra, comment = struct.unpack_from(ENTRY, entries, at)
            if mark != b"PK\1\2":
                raise zipfile.BadZipFile("Bad magic number for central directory")
            if count and size + unpacked > run_bytes:
                yield Run(package, directory + begin, at - begin, count, directory, offset)
                begin, count, size = at, 0, 0
            at, count, size = at + 46 + name + extra + comment, count + 1, size + unpacked
        if count:
            yield Run(package, directory + begin, len(entries) - begin, count, directory, offset)

    def partitions(self) -> list[Run]:
        """A run for each package, and more for one of over runBytes, by the sizes in its directory.

        Where packages are many times `MOST` runs of that size, runs are larger, up to LARGEST.
        """
        system, path = fs.FileSystem.from_uri(self.path if re.match(r"\w+:", self.path) else f"file://{self.path}")
        scheme = self.path[: self.path.index(":") + 1] if re.match(r"\w+:", self.path) else "file:"
        found = [f for f in system.get_file_info(fs.FileSelector(path, recursive=True)) if f.is_file and f.path.lower().endswith(".zip")]
        run_bytes = max(self.run_bytes, min(LARGEST, sum(f.size for f in found) // MOST))
        out = []
        for f in sorted(found, key=lambda f: f.path):
            name = f"{scheme}//{f.path}" if scheme == "file:" else self.path.rstrip("/") + f.path[len(path.rstrip("/")) :]
            if f.size <= self.run_bytes:
                out.append(Run(name))
                continue
            try:
                out += list(self.runs_of(name, run_bytes))
            except (zipfile.BadZipFile, OSError, struct.error):
                out.append(Run(name))  # its reader tells the error
        return out or [Run("")]

    def read(self, run: Run) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c.split()[0], pa.int64() if c.endswith("long") else pa.string()) for c in ROWS.split(", ")])
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        if not run.package:
            return
        rows, size = [], 0
        try:
            with self.open(run) as z:
                for name in sorted(z.namelist()):
                    if name.endswith("/") or not self.wanted(name):
                        continue
                    try:
                        content = z.read(name)
                        rows += rows_of(run.package, name, content)
                        size += len(content)
                    except (zipfile.BadZipFile, zlib.error, RuntimeError) as e:
                        rows.append((run.package, name, "file", 0, None, None, None, None, None, None, str(e)[:200]))
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
        except (zipfile.BadZipFile, OSError) as e:
            rows.append((run.package, None, "package", 0, None, None, None, None, None, None, str(e)[:200]))
        if rows:
            yield batch(rows)


class PackageSource(DataSource):
    """Rows of all zip files below a folder, as read_packages() gives them.

    Options: runBytes, from which a package is read by several tasks, each of which reads its own part of the directory only. Members are opened one by one and never
    a package as a whole; a broken member is one row with an error. Folders may be of any kind that Arrow's file systems open.
    """

    @classmethod
    def name(cls) -> str:
        return "report_packages"

    def schema(self) -> str:
        return ROWS

    def reader(self, schema: StructType) -> PackageReader:
        return PackageReader(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PackageSource)
