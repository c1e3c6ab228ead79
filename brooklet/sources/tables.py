"""Tables of generations: every write makes a folder of its own, and one atomic rename makes it part of the table.

A table's folder holds ``generation=<id>`` folders of Parquet files and numbered
pointers, small JSON files that name the generations of a version and, for a
partitioned table, which partition values of each count. The greatest number is
the table. A write that stops leaves a folder that no pointer names: readers never
see it, and ``expire`` removes it later. Nothing is ever overwritten, so a reader
keeps the version that it began with while its generations stand; old versions
can be read by number.

Two writers can't take one number: the second finds it taken. It adds its folder
to the newer version, except where it replaced what it had read (``Conflict``).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from brooklet.sources.sinks import exists, hadoop_path, partitioned_writer

#: The versions that ``expire`` leaves, and the age in seconds below which a folder may belong to a write under way.
VERSIONS, GRACE = 5, 24 * 3600
#: About how large a file becomes when an unpartitioned table is compacted.
FILE_BYTES = 128 << 20
_GENERATION, _POINTER = "generation", "_version-"


class Conflict(RuntimeError):
    """Another writer changed the table meanwhile."""


@dataclass(frozen=True)
class Version:
    """A state of a table: its generations in order of writing, with the partition folders that count (None: all of it)."""

    number: int
    generations: tuple[tuple[str, tuple[str, ...] | None], ...] = ()


class Table:
    """A table of generations below a path that all executors reach."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition: str | None = None) -> None:
        self.spark, self.path, self.schema, self.partition = spark, path.rstrip("/"), schema, partition

    # Versions.

    def _pointers(self) -> dict[int, str]:
        if not exists(self.spark, self.path):
            return {}
        where, fs = hadoop_path(self.spark, self.path)
        names = [f.getPath().getName() for f in fs.listStatus(where)]
        return {int(n.removeprefix(_POINTER).removesuffix(".json")): n for n in names if n.startswith(_POINTER) and n.endswith(".json")}

    def _read(self, name: str) -> Version:
        where, fs = hadoop_path(self.spark, f"{self.path}/{name}")
        stream = fs.open(where)
        try:
            held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(held["number"], tuple((g, None if p is None else tuple(p)) for g, p in held["generations"]))

    def version(self, number: int | None = None) -> Version | None:
        """The newest version, or one by number; None where there is none."""
        found = self._pointers()
        if number is None:
            return self._read(found[max(found)]) if found else None
        if number not in found:
            raise ValueError(f"{self.path} has no version {number}, only {sorted(found)}")
        return self._read(found[number])

    def versions(self) -> list[int]:
        return sorted(self._pointers())

    def exists(self) -> bool:
        return bool(self._pointers())

    def _point(self, version: Version) -> None:
        """Make a version the table's newest."""
        text = json.dumps({"number": version.number, "generations": version.generations})
        if not put_file(self.spark, f"{self.path}/{_POINTER}{version.number:09d}.json", text):
            raise Conflict(f"{self.path}: version {version.number} is taken")

    def _commit(self, change: Callable[[Version], tuple], read: Version | None = None) -> Version:
        """Point to a changed version; with ``read`` only if that is still the newest."""
        while True:
            now = self.version() or Version(0)
            if read is not None and now.number != read.number:
                raise Conflict(f"{self.path}: version {read.number} was read, {now.number} is there")
            new = Version(now.number + 1, tuple(change(now)))
            try:
                self._point(new)
                return new
            except Conflict:
                if read is not None:
                    raise

    # Reading.

    def paths(self, version: Version) -> list[str]:
        """The folders of a version."""
        folder = lambda g: f"{self.path}/{_GENERATION}={g}"
        return [p for g, parts in version.generations for p in ([folder(g)] if parts is None else [f"{folder(g)}/{x}" for x in parts])]

    def read(self, number: int | None = None) -> DataFrame:
        """The table, or an older version of it; partition filters prune folders."""
        return self.read_version(self.version(number) or Version(0))

    def read_version(self, version: Version) -> DataFrame:
        """The rows of some generations."""
        paths = self.paths(version)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        schema = StructType([*self.schema.fields, StructField(_GENERATION, StringType())])
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*self.schema.names)

    # Writing.

    def stage(self, df: DataFrame, files: int | None = None) -> str:
        """Write rows as a generation that no version names yet; returns its id."""
        generation = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        partitioned_writer(df.select(*self.schema.names), self.partition, files).parquet(f"{self.path}/{_GENERATION}={generation}")
        return generation

    def read_staged(self, generation: str) -> DataFrame:
        """The rows of a staged generation."""
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{_GENERATION}={generation}").select(*self.schema.names)

    def discard(self, generation: str) -> None:
        """Remove a staged generation."""
        where, fs = hadoop_path(self.spark, f"{self.path}/{_GENERATION}={generation}")
        fs.delete(where, True)

    def _parts(self, generation: str) -> tuple[str, ...] | None:
        """The partition folders of a generation (one for each value, listed without reading)."""
        if self.partition is None:
            return None
        where, fs = hadoop_path(self.spark, f"{self.path}/{_GENERATION}={generation}")
        names = [f.getPath().getName() for f in fs.listStatus(where)]
        return tuple(sorted(n for n in names if n.startswith(f"{self.partition}=")))

    def _empty(self, generation: str, parts: tuple[str, ...] | None) -> bool:
        """Whether a generation has no rows by its folders, which goes then."""
        if parts == ():
            self.discard(generation)
        return parts == ()

    def add(self, generation: str) -> Version:
        """A staged generation's rows come to the table's."""
        parts = self._parts(generation)
        more = () if self._empty(generation, parts) else ((generation, parts),)
        return self._commit(lambda now: (*now.generations, *more))

    def put(self, generation: str, read: Version | None = None) -> Version:
        """A staged generation takes the place of the whole table."""
        parts = self._parts(generation)
        new = [] if self._empty(generation, parts) else [(generation, parts)]
        return self._commit(lambda now: new, read)

    def put_partitions(self, generation: str, values: Iterable) -> Version:
        """A staged generation takes the place of the given partition values; those that it lacks are empty then."""
        parts, gone = self._parts(generation), {f"{self.partition}={v}" for v in values}
        if stray := set(parts or ()) - gone:
            raise ValueError(f"{sorted(stray)} are not among the replaced values")
        new = [] if self._empty(generation, parts) else [(generation, parts)]

        def change(now: Version) -> list:
            kept = [(g, tuple(p for p in of if p not in gone)) for g, of in now.generations]
            return [*[x for x in kept if x[1]], *new]

        return self._commit(change)

    def append(self, df: DataFrame, files: int | None = None) -> Version:
        return self.add(self.stage(df, files))

    def replace(self, df: DataFrame) -> Version:
        return self.put(self.stage(df))

    def replace_partitions(self, df: DataFrame, values: Iterable) -> Version:
        return self.put_partitions(self.stage(df), values)

    def create(self) -> bool:
        """An empty table, unless there is one."""
        if self.exists():
            return False
        try:
            self._point(Version(1))
        except Conflict:
            return False
        return True

    def compact(self, file_bytes: int = FILE_BYTES) -> bool:
        """Rewrite the table's files by size, as a new version; an error if another writer comes between. Whether there was anything to do.

        Without partitions the number of files follows from the bytes, whatever number of tasks a scan would take.
        """
        read = self.version()
        if read is None or not read.generations:
            return False
        rows = self.read(read.number)
        if self.partition is None:
            held = file_sizes(self.spark, self.paths(read)).agg(F.sum("bytes")).first()[0] or 0
            rows = rows.coalesce(max(1, -(-held // file_bytes)))
        self.put(self.stage(rows), read)
        return True

    # Maintenance.

    def expire(self, keep: int = VERSIONS, older_than: float = GRACE, execute: bool = False) -> dict[str, list[str]]:
        """The versions beyond the last ``keep`` and the generations that no kept version names; with ``execute`` they go.

        A folder younger than ``older_than`` seconds may be a write under way and stays.
        """
        if keep < 1:
            raise ValueError("the newest version stays")
        pointers = self._pointers()
        kept = sorted(pointers)[-keep:]
        named = {g for n in kept for g, _ in self._read(pointers[n]).generations}
        old = [pointers[n] for n in sorted(pointers) if n not in kept]
        if not exists(self.spark, self.path):
            return {"versions": [], "generations": []}
        where, fs = hadoop_path(self.spark, self.path)
        limit = (time.time() - older_than) * 1000
        found = [(f.getPath().getName(), f.getModificationTime()) for f in fs.listStatus(where)]
        prefix = f"{_GENERATION}="
        orphans = sorted(n for n, at in found if n.startswith(prefix) and n.removeprefix(prefix) not in named and at <= limit)
        if execute:
            for name in [*old, *orphans]:  # pointers first: no version ever names what is gone
                fs.delete(hadoop_path(self.spark, f"{self.path}/{name}")[0], True)
        return {"versions": old, "generations": orphans}

    def file_sizes(self) -> DataFrame:
        """(path, bytes) of the data files of the newest version."""
        version = self.version()
        return file_sizes(self.spark, self.paths(version) if version else [])


def put_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all: a hidden file is renamed. False if there is one of that name."""
    jvm = spark._jvm
    folder, _, name = path.rpartition("/")
    hidden, fs = hadoop_path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(hidden, hadoop_path(spark, path)[0], spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception as error:
        fs.delete(hidden, False)
        if "FileAlreadyExists" not in str(error):
            raise
        return False


def file_sizes(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, bytes) of the data files below some folders, listed by Spark; contents aren't read."""
    if not paths:
        return spark.createDataFrame([], "path string, bytes long")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(paths)
    return listed.select("path", F.col("length").alias("bytes"))
