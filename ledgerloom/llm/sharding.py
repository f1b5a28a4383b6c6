"""Size-tiered shards with a versioned manifest, with DataFrame operations only."""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import new_folder

LISTED = "path string, bytes long, rows long"


@dataclass(frozen=True)
class Shard:
    path: str  # below the store's root
    bytes: int
    rows: int


class CommitConflict(RuntimeError):
    """Another writer has committed this version."""


def tier(size: int, least: int, fanout: int) -> int:
    return 0 if size < least else 1 + int(math.log(size / least, fanout))


def plan_merges(sizes: list[int], *, target: int, least: int, fanout: int) -> list[list[int]]:
    """Groups of shards (by position) to write as one file each.

    Runs of one tier are merged once there are `fanout` of them, up to the target
    size, and what comes out is a run of its own tier; this goes on until no tier
    is full. Merges of merges are one group, so every row is written once. Shards
    of half the target and more are left as they are.
    """
    runs = [([i], s) for i, s in enumerate(sizes) if s < target / 2]
    done: list[list[int]] = []
    while True:
        tiers: dict[int, list] = {}
        for run in runs:
            tiers.setdefault(tier(run[1], least, fanout), []).append(run)
        full = min((t for t, x in tiers.items() if len(x) >= fanout), default=None)
        if full is None:
            return sorted(done + [m for m, _ in runs if len(m) > 1])
        runs = [run for t, x in tiers.items() if t != full for run in x]
        group, size = [], 0
        for members, s in sorted(tiers[full], key=lambda x: (-x[1], x[0])):
            if size + s > target and group:
                runs, done = (runs, done + [group]) if size >= target / 2 else (runs + [(group, size)], done)
                group, size = [], 0
            group, size = group + members, size + s
        if size >= target / 2:
            done.append(group)
        else:
            runs.append((group, size))


class ShardStore:
    """A folder of immutable Parquet shards; versions of the manifest say which of them are the table.

    A version lists parts, and a part lists up to `part_shards` shards, so a change
    writes the parts that it touches and a short list. append() adds shards,
    compact() replaces small ones by larger ones. Either
    writes its files first and then commits: the next version of the manifest is
    written under a private name and renamed to its own, which fails if that
    version exists. Readers see one version as a whole, whatever fails or runs
    meanwhile; files of a failed attempt belong to no version. Whoever loses a
    commit may try again on the version that won, with the files already written.

    The driver holds the list of parts and the shards of one part or one plan at a
    time. vacuum() spares what is younger than its grace period, as a writer may
    not have committed it yet.
    """

    def __init__(self, spark: SparkSession, root: str, *, target_bytes: int = 64 << 20, least_bytes: int = 1 << 20, fanout: int = 4, merges_per_job: int = 64, part_shards: int = 10_000):
        self.spark, self.root = spark, root.rstrip("/")
        self.target, self.least, self.fanout, self.wave, self.part_shards = target_bytes, least_bytes, fanout, merges_per_job, part_shards
        self._schema = None
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(f"{self.root}/manifest/parts"))

    # The manifest

    def versions(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/manifest"))]
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def _last(self) -> int:
        return (self.versions() or [0])[-1]

    def _text(self, name: str) -> list[str]:
        source = self._fs.open(self._path(f"{self.root}/manifest/{name}"))
        try:
            return _lines(self.spark, source)
        finally:
            source.close()

    def _put(self, path: str, lines: Iterable[str]) -> None:
        out = self._fs.create(self._path(path), False)
        try:
            for line in lines:
                out.write(bytearray((line + "\n").encode()))
        finally:
            out.close()

    def parts(self, version: int | None = None) -> list[dict]:
        """(part, shards, small) of a version, by default the last; a new store has none."""
        v = self._last() if version is None else version
        return [json.loads(x) for x in self._text(f"v{v:010d}.json") if x] if v else []

    def part(self, name: str) -> list[Shard]:
        return [Shard(**json.loads(x)) for x in self._text(f"parts/{name}")]

    def shards(self, version: int | None = None) -> list[Shard]:
        """All shards of a version."""
        return [s for p in self.parts(version) for s in self.part(p["part"])]

    def manifest(self, version: int | None = None) -> DataFrame:
        """The shards of a version as a table."""
        paths = [f"{self.root}/manifest/parts/{p['part']}" for p in self.parts(version)]
        return self.spark.read.schema(LISTED).json(paths) if paths else self.spark.createDataFrame([], LISTED)

    def write_parts(self, shards: Iterable[Shard]) -> list[dict]:
        """Write shards as parts and tell of them as a version lists them."""
        out, rest = [], iter(shards)
        while some := list(islice(rest, self.part_shards)):
            name = f"{uuid.uuid4().hex}.json"
            self._put(f"{self.root}/manifest/parts/{name}", (json.dumps(asdict(s)) for s in some))
            out.append({"part": name, "shards": len(some), "small": sum(s.bytes < self.target / 2 for s in some)})
        return out

    def commit(self, parts: list[dict], version: int) -> int:
        private = f"{self.root}/manifest/.{uuid.uuid4().hex}"
        self._put(private, map(json.dumps, parts))
        public = self._path(f"{self.root}/manifest/v{version:010d}.json")
        jvm = self.spark._jvm
        options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(public.toUri(), self.spark._jsc.hadoopConfiguration()).rename(self._path(private), public, options)
        except Exception as e:
            self._fs.delete(self._path(private), False)
            raise CommitConflict(f"version {version} of {self.root}") from e
        return version

    # Writes

    def _write(self, df: DataFrame, **options) -> Iterator[Shard]:
        """Write df and go through its files, in the order of their tasks, with their sizes and numbers of rows."""
        folder = f"runs/{uuid.uuid4().hex}"
        df.write.options(compression="zstd", **options).parquet(f"{self.root}/{folder}")
        read = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")
        about = read.metadataColumn("_metadata")
        files = read.groupBy(about["file_name"].alias("name"), about["file_size"].alias("bytes")).agg(F.count(F.lit(1)).alias("rows")).orderBy("name")
        return (Shard(f"{folder}/{r['name']}", r["bytes"], r["rows"]) for r in files.toLocalIterator())

    def append(self, df: DataFrame, *, rows_per_shard: int = 4096, tries: int = 5) -> int:
        """Add rows as small shards, written where they are: no shuffle. Tried again if another writer commits first."""
        self._schema = df.schema
        new = self.write_parts(self._write(df, maxRecordsPerFile=rows_per_shard))
        for left in reversed(range(tries)):
            last = self._last()
            try:
                return self.commit(self.parts(last or None) + new, last + 1)
            except CommitConflict:
                if not left:
                    raise
        raise AssertionError

    def compact(self, schema=None) -> int:
        """Merge shards of like size; returns the version that holds the result.

        Parts without small shards stay as they are. The small shards of the others
        are planned and merged part by part; what a plan leaves over goes on to the
        next. Fails if another writer commits meanwhile.
        """
        last, schema = self._last(), schema or self._schema
        kept, waiting, merged = [], [], []
        for p in self.parts(last or None):
            if not p["small"]:
                kept.append(p)
                continue
            found = self.part(p["part"])
            large = [s for s in found if s.bytes >= self.target / 2]
            small = waiting + [s for s in found if s.bytes < self.target / 2]
            done, waiting = self._merge(small, schema)
            if not done and not kept and not merged and len(self.parts(last)) == 1:
                return last
            merged += self.write_parts(large + done)
            if len(waiting) > self.part_shards:
                merged, waiting = merged + self.write_parts(waiting), []
        if not merged:
            return last
        return self.commit(kept + merged + self.write_parts(waiting), last + 1)

    def _merge(self, shards: list[Shard], schema) -> tuple[list[Shard], list[Shard]]:
        """(what merges gave, shards that no merge took)."""
        groups = plan_merges([s.bytes for s in shards], target=self.target, least=self.least, fanout=self.fanout)
        merged: list[Shard] = []
        for start in range(0, len(groups), self.wave):
            job = None
            for group in groups[start : start + self.wave]:
                one = self.spark.read.schema(schema).parquet(*[f"{self.root}/{shards[i].path}" for i in group]).coalesce(1)
                job = one if job is None else job.unionAll(one)
            merged += self._apart(job)
        used = {i for g in groups for i in g}
        if sum(s.rows for s in merged) != sum(shards[i].rows for i in used):
            raise RuntimeError("merged shards do not hold the rows of their parts")
        return merged, [s for i, s in enumerate(shards) if i not in used]

    def _apart(self, job: DataFrame) -> list[Shard]:
        """Write a union of single partitions with a file for each; Spark would else join them into one."""
        key = "spark.sql.unionOutputPartitioning"
        old = self.spark.conf.get(key, None)
        self.spark.conf.set(key, "false")
        try:
            return list(self._write(job))
        finally:
            self.spark.conf.unset(key) if old is None else self.spark.conf.set(key, old)

    # Reads

    def _paths(self, version: int | None) -> list[str]:
        """What to read: whole folders of a write whose files are all in the version, and single files of the others."""
        used: dict[str, list[str]] = {}
        for p in self.parts(version):
            for s in self.part(p["part"]):
                folder, name = s.path.rsplit("/", 1)
                used.setdefault(folder, []).append(name)
        out = []
        for folder, names in used.items():
            there = sum(f.getPath().getName().startswith("part-") for f in self._fs.listStatus(self._path(f"{self.root}/{folder}")))
            out += [f"{self.root}/{folder}"] if there == len(names) else [f"{self.root}/{folder}/{n}" for n in names]
        return out

    def read(self, schema=None, version: int | None = None) -> DataFrame:
        paths = self._paths(version)
        reader = self.spark.read.schema(schema or self._schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], schema or self._schema)

    def with_shards(self, columns: list[str], version: int | None = None) -> DataFrame:
        """Columns of all rows, and the version, and the number, size and rows of the shard that holds each.

        A column of the rows that is named like an added one is left out.
        """
        added = ["shard_version", "shard_id", "shard_bytes", "shard_rows"]
        own = [c for c in columns if c.lower() not in added]
        v = self._last() if version is None else version
        rows = self.read(version=version)
        if not self.parts(version):
            return rows.select(*own, *[F.lit(None).cast("long").alias(c) for c in added])
        name = F.element_at(F.split(F.col("path"), "/"), -1)
        listed = self.manifest(version).select(name.alias("name"), F.struct(F.lit(v).cast("long").alias("shard_version"), F.conv(F.substring(F.sha2("path", 256), 1, 15), 16, 10).cast("long").alias("shard_id"), F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows")).alias("told"))
        placed = rows.select(F.struct(*own).alias("row"), rows.metadataColumn("_metadata")["file_name"].alias("name"))
        return placed.join(listed, "name").select("row.*", "told.*")

    def vacuum(self, grace_seconds: float = 86_400.0) -> None:
        """Delete older versions, and files that the last version does not use, if they are older than the grace period."""
        before = (time.time() - grace_seconds) * 1000
        known = self.versions()
        parts = {p["part"] for p in self.parts()}
        kept = {s.path for s in self.shards()}

        def clear(folder: str, used) -> None:
            if self._fs.exists(self._path(folder)):
                for f in self._fs.listStatus(self._path(folder)):
                    if f.isFile() and f.getModificationTime() < before and not used(f.getPath().getName()):
                        self._fs.delete(f.getPath(), False)

        runs = self._path(f"{self.root}/runs")
        for folder in self._fs.listStatus(runs) if self._fs.exists(runs) else []:
            name = folder.getPath().getName()
            clear(f"{self.root}/runs/{name}", lambda f, name=name: f"runs/{name}/{f}" in kept or not f.startswith("part-"))
        clear(f"{self.root}/manifest/parts", parts.__contains__)
        last = f"v{known[-1]:010d}.json" if known else ""
        clear(f"{self.root}/manifest", lambda f: f == last)


def _lines(spark: SparkSession, source) -> list[str]:
    """All lines of an open Hadoop stream."""
    reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(source, "UTF-8"))
    return [x for x in reader.lines().toArray()]


def shard(docs: DataFrame, columns: list[str], *, root: str | None = None, rows_per_shard: int = 4096, **options) -> DataFrame:
    """Append docs to a store (by default a new one in the shared folder), compact it, and tell each row's shard.

    Rows keep all their columns in the store, with nulls, repeats and texts of any
    length as they are; a shard is written by one task that streams its rows. Ties
    do not arise: rows stay in the order in which they are read. An
    empty table makes a version without shards and no rows. Input columns named as
    those that are added stay in the store and are left out here. Older versions and
    their files stay until vacuum() is called.

    Returns the columns named, shard_version, shard_id, shard_bytes, shard_rows.
    """
    store = ShardStore(docs.sparkSession, root or new_folder(docs.sparkSession, "shards"), **options)
    store.append(docs, rows_per_shard=rows_per_shard)
    store.compact()
    return store.with_shards(columns)
