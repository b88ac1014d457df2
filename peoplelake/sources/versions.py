"""Tables of immutable files. A manifest names the files of a version, and putting it in place is the only switch.

Files are written by Spark below ``data`` and mean nothing until a manifest names them, so a write that stops half way
leaves the version before it readable. Of every file the manifest keeps its rows and its smallest and largest key, by
which a change finds the files it touches; all others stay as they are. A manifest has a line for each file, no more
than the listing that Spark's own reader holds on the driver.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "_bucket"
#: Of the files; a third fewer bytes than with the default codec of a session.
CODEC = "zstd"
#: Versions whose files stay after a clean-up: the current one, and the one that running readers may still use.
KEEP = 2
#: Rows of a file that an upsert aims at.
FILE_ROWS = 5_000_000


class ConcurrentWrite(RuntimeError):
    """Another writer switched the table since it was read."""


@dataclass(frozen=True)
class DataFile:
    """A file below the table's folder; statistics are there if the table has a key, a bucket if it is dealt by one."""

    path: str
    rows: int | None = None
    low: int | str | None = None
    high: int | str | None = None
    bucket: int | None = None

    def may_hold(self, low, high) -> bool:
        """Whether a key between the two (both included) can be in the file."""
        return self.low is None or (self.low <= high and self.high >= low)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str | None = None):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._place = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._place(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ------------------------------------------------------------ versions

    def _versions(self) -> list[int]:
        folder = self._place(f"{self.path}/_versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n) for n in names if n.isdigit())

    def version(self) -> int:
        """Number of the current version, 0 if there is none."""
        return max(self._versions(), default=0)

    def has(self, version: int) -> bool:
        """Whether the files of a version are still there; version 0 is the empty table."""
        return version == 0 or version in self._versions()

    def _lines(self, version: int) -> list[dict]:
        stream = self._fs.open(self._place(f"{self.path}/_versions/{version:012d}"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return [json.loads(line) for line in text.splitlines()]

    def note(self, version: int | None = None) -> dict:
        """What the writer of a version said about it."""
        version = self.version() if version is None else version
        return self._lines(version)[0]["note"] if version else {}

    def files(self, version: int | None = None) -> list[DataFile]:
        version = self.version() if version is None else version
        return [DataFile(**line) for line in self._lines(version)[1:]] if version else []

    def commit(self, added: Iterable[DataFile] = (), removed: Iterable[DataFile] = (), base: int | None = None, note: dict | None = None) -> int:
        """Switch to a version without the removed and with the added files; ``base`` is the version they were chosen from."""
        current = self.version()
        if base is not None and base != current:
            raise ConcurrentWrite(f"{self.path} is at version {current}, not at {base}")
        gone = {f.path for f in removed}
        files = [f for f in self.files(current) if f.path not in gone] + list(added)
        lines = [{"note": note or {}}, *[{k: v for k, v in asdict(f).items() if v is not None} for f in files]]
        text = "".join(json.dumps(line) + "\n" for line in lines)
        folder, final = f"{self.path}/_versions", self._place(f"{self.path}/_versions/{current + 1:012d}")
        draft = self._place(f"{folder}/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise ConcurrentWrite(f"{self.path} got version {current + 1} from another writer")
        return current + 1

    def vacuum(self, keep: int = KEEP) -> int:
        """Delete the manifests before the last ``keep`` versions and the files that only they name; returns the files deleted."""
        versions = self._versions()
        old, kept = versions[:-keep], versions[-keep:]
        used = {f.path for v in kept for f in self.files(v)}
        gone = {f.path for v in old for f in self.files(v)} - used
        for path in gone:
            self._fs.delete(self._place(f"{self.path}/{path}"), False)
        # with the last file of a write goes its folder, and the empty files that no manifest named
        folders = {"/".join(p.split("/")[:2]) for p in gone} - {"/".join(p.split("/")[:2]) for p in used}
        for folder in folders:
            self._fs.delete(self._place(f"{self.path}/{folder}"), True)
        for v in old:
            self._fs.delete(self._place(f"{self.path}/_versions/{v:012d}"), False)
        return len(gone)

    # ------------------------------------------------------------ data

    def read(self, files: Sequence[DataFile] | None = None) -> DataFrame:
        """The rows of the current version, or of some of its files."""
        files = self.files() if files is None else files
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f.path}" for f in files])

    def write(self, df: DataFrame, bucket: Column | None = None) -> list[DataFile]:
        """Write rows to new files, which count from the commit on; ``bucket`` deals them into a folder for each value."""
        folder = f"data/{uuid.uuid4().hex}"
        rows = df.select(*[f.name for f in self.schema.fields])
        if bucket is None:
            rows.write.option("compression", CODEC).parquet(f"{self.path}/{folder}")
        else:
            rows = df.select(*[f.name for f in self.schema.fields], bucket.cast("int").alias(BUCKET))
            rows.write.option("compression", CODEC).partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        if self.key is None:
            return self._listed(folder)
        written = self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(f"{self.path}/{folder}")
        each = written.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)), F.min(self.key), F.max(self.key))
        out = []
        for file, n, low, high in each.collect():
            path = f"{folder}/{file.split(f'{folder}/', 1)[1]}"
            found = re.search(rf"/{BUCKET}=(\d+)/", path)
            out.append(DataFile(path, n, low, high, int(found[1]) if found else None))
        return sorted(out, key=lambda f: (f.bucket or 0, f.low is not None, f.low if f.low is not None else 0, f.path))

    def _listed(self, folder: str) -> list[DataFile]:
        found, out = self._fs.listFiles(self._place(f"{self.path}/{folder}"), True), []
        while found.hasNext():
            path = found.next().getPath().toString()
            if path.endswith(".parquet"):
                out.append(DataFile(f"{folder}/{path.split(f'{folder}/', 1)[1]}"))
        return sorted(out, key=lambda f: f.path)

    def publish(self, df: DataFrame, bucket: Column | None = None, note: dict | None = None) -> DataFrame:
        """Replace the whole table; old files stay for readers of the version before."""
        base = self.version()
        added = self.write(df, bucket)
        self.commit(added, self.files(base), base, note)
        self.vacuum()
        return self.read()

    def append(self, df: DataFrame, note: dict | None = None) -> int:
        """Add rows and return their number."""
        base = self.version()
        added = self.write(df)
        self.commit(added, (), base, note)
        self.vacuum()
        return sum(f.rows or 0 for f in added)


@dataclass(frozen=True)
class Upsert:
    """What an upsert did: rows of the source, and how many files it replaced, left as they were and wrote."""

    rows: int
    replaced: int
    kept: int
    added: int


def place_among(value: Column, edges: Sequence) -> Column:
    """How many of the sorted edges are at or below the value, found among every n-th edge first and then in between."""
    if not edges:
        return F.lit(0)
    step = max(1, round(len(edges) ** 0.5))
    every = F.array(*[F.lit(e) for e in edges[::step]])
    coarse = F.size(F.filter(every, lambda e: e <= value))
    fine = F.size(F.filter(F.slice(F.array(*[F.lit(e) for e in edges]), F.greatest(coarse - 1, F.lit(0)) * step + 1, F.lit(step)), lambda e: e <= value))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def upsert_by_files(table: VersionedTable, rows: DataFrame, file_rows: int = FILE_ROWS) -> Upsert:
    """Replace and add rows by key, rewriting only the files whose key range gets any.

    ``rows`` has every key once, and they are read several times. A row goes to the file with the largest lowest key at or
    below its own; keys above all files go to new ones. Files are sorted by ranges of the key, so key ranges of one
    version do not overlap; files that do, as after appends, are rewritten as one.
    """
    if table.key is None:
        raise ValueError("an upsert needs a table with a key")
    base, key = table.version(), table.key
    files = sorted((f for f in table.files(base) if f.rows and f.low is not None), key=lambda f: (f.low, f.high))
    groups: list[list[DataFile]] = []
    for f in files:
        if groups and f.low <= max(g.high for g in groups[-1]):
            groups[-1].append(f)
        else:
            groups.append([f])
    # keys at or above an edge belong to the group that begins there; the last edge is behind all groups
    tops = [max(g.high for g in group) for group in groups]
    at = F.greatest(place_among(F.col(key), [group[0].low for group in groups]) - 1, F.lit(0))
    at = F.when(F.col(key) > F.lit(tops[-1]), len(groups)).otherwise(at) if groups else F.lit(0)
    counts = {r["at"]: r["n"] for r in rows.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Upsert(0, 0, len(files), 0)
    touched = [f for i in counts if i < len(groups) for f in groups[i]]
    merged = rows.select(*[f.name for f in table.schema.fields])
    if touched:
        merged = table.read(touched).join(rows.select(key), key, "left_anti").select(*merged.columns).unionByName(merged)
    n = sum(f.rows for f in touched) + sum(counts.values())
    # a folder for each group: no new file reaches over a group that stays
    merged = merged.withColumn("_at", at).repartitionByRange(max(1, -(-n // file_rows)), "_at", key)
    added = [replace(f, bucket=None) for f in table.write(merged, F.col("_at"))]
    table.commit(added, touched, base)
    table.vacuum()
    return Upsert(sum(counts.values()), len(touched), len(files) - len(touched), len(added))
