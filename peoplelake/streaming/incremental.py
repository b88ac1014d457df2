"""The incremental load as a stream over a landing folder, into a table whose files stay few."""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from peoplelake.functions.ordered import first_by_key
from peoplelake.sources.loads import insert_ignore
from peoplelake.sources.sinks import materialize
from peoplelake.sources.versions import FILE_ROWS, DataFile, VersionedTable, place_among

#: Files of about the same size that are merged into one once there are more; sizes are told apart by powers of it.
FAN = 8
#: Bits of a file's Bloom filter per key, and bits set by a key: about one key in a hundred is taken for one of the file's.
KEY_BITS, PROBES = 10, 7
#: Slots of the key space by which late keys find the files that reach into them.
SLOTS = 1024
BLOOM = T.StructType([T.StructField("file", T.StringType()), T.StructField("word", T.LongType()), T.StructField("bits", T.LongType())])


def bloom_words(rows: int) -> int:
    """64-bit words of the filter of a file with so many rows."""
    return max(1, math.ceil(rows * KEY_BITS / 64))


def _bits(pk: str, words: Column) -> Column:
    """(word, bit) of every probe of a key in a filter of so many words."""
    places = [F.pmod(F.xxhash64(F.col(pk), F.lit(i)), words * 64) for i in range(PROBES)]
    return F.array(*[F.struct(F.floor(p / 64).alias("word"), (p % 64).cast("int").alias("bit")) for p in places])


def _names_any(index: DataFile, paths: list[str]) -> bool:
    """Whether a file of filters can have one for any of the sorted paths."""
    at = bisect.bisect_left(paths, index.low)
    return at < len(paths) and paths[at] <= index.high


class StreamTarget:
    """The target of a stream: a table by key, and a Bloom filter of the keys of each of its files."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, pk: str, file_rows: int = FILE_ROWS):
        self.spark, self.path, self.pk, self.file_rows = spark, path.rstrip("/"), pk, file_rows
        self.table = VersionedTable(spark, self.path, schema, pk)
        self.blooms = VersionedTable(spark, f"{self.path}/_bloom", BLOOM, "file")

    def read(self) -> DataFrame:
        return self.table.read()

    def _index(self, files: list[DataFile]) -> None:
        """Store the filters of new files; they are of use only once the files are named by the table."""
        sizes = self.spark.createDataFrame([(f.path, bloom_words(f.rows)) for f in files], "file string, words long")
        name = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/.*)$", 1)
        keys = self.table.read(files).select(self.pk, name.alias("file")).join(F.broadcast(sizes), "file")
        keys = keys.select("file", F.explode(_bits(self.pk, F.col("words"))).alias("b")).select("file", "b.word", "b.bit")
        words = keys.groupBy("file", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        self.blooms.commit(self.blooms.write(words.repartitionByRange("file", "word")))

    def _ranges(self, files: list[DataFile]) -> tuple[list, DataFrame]:
        """Edges of at most SLOTS slots of the key space, and a row for each slot that a file reaches into.

        Large files hardly overlap and tiers keep the small ones few, so there are few more rows than files.
        """
        lows = sorted({f.low for f in files})
        edges = lows[:: -(-len(lows) // SLOTS)]
        rows = [
            (slot, f.path, f.low, f.high, bloom_words(f.rows))
            for f in files
            for slot in range(bisect.bisect_right(edges, f.low), bisect.bisect_right(edges, f.high) + 1)
        ]
        kind = self.table.schema[self.pk].dataType.simpleString()
        return edges, self.spark.createDataFrame(rows, f"slot int, file string, low {kind}, high {kind}, words long")

    def may_hold(self, keys: DataFrame) -> list[DataFile]:
        """Files that may hold one of the keys, by their key range and then by their filter."""
        files = [f for f in self.table.files() if f.low is not None]
        low, high = keys.agg(F.min(self.pk), F.max(self.pk)).first()
        near = [f for f in files if low is not None and f.may_hold(low, high)]
        if not near:
            return []
        edges, ranges = self._ranges(near)
        pairs = keys.withColumn("slot", place_among(F.col(self.pk), edges)).join(ranges, "slot")
        pairs = pairs.filter(F.col(self.pk).between(F.col("low"), F.col("high")))
        probes = pairs.select("file", self.pk, F.explode(_bits(self.pk, F.col("words"))).alias("b"))
        probes = probes.select("file", self.pk, "b.word", "b.bit")
        paths = sorted(f.path for f in near)
        stored = self.blooms.read([b for b in self.blooms.files() if _names_any(b, paths)])
        hits = probes.join(stored, ["file", "word"]).filter(F.expr("shiftrightunsigned(bits, bit) & 1L = 1L"))
        found = hits.groupBy("file", self.pk).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == PROBES)
        held = {r["file"] for r in found.select("file").distinct().collect()}
        return [f for f in near if f.path in held]

    def load(self, batch: DataFrame, batch_id: int) -> int:
        """Add the first row of every new key; a batch that is already in is skipped. Returns the rows added.

        Keys above all files are new. Of the others, the late ones, only the files are read that may hold one of them.
        """
        if self.table.note().get("batch", -1) >= batch_id:
            return 0
        order = [f.name for f in self.table.schema.fields if f.name != self.pk]
        rows = materialize(first_by_key(batch.select(*[f.name for f in self.table.schema.fields]), self.pk, order), f"{self.path}/_staged")
        top = max((f.high for f in self.table.files() if f.high is not None), default=None)
        if top is not None:
            late = rows.filter(F.col(self.pk) <= F.lit(top)).select(self.pk)
            files = self.may_hold(late)
            if files:
                rows = insert_ignore(rows, self.table.read(files), self.pk, order)
        added = [f for f in self.table.write(rows) if f.rows]
        if added:
            self._index(added)
        self.table.commit(added, (), note={"batch": batch_id})
        self.compact()
        return sum(f.rows for f in added)

    def compact(self) -> int:
        """Merge the files of every tier that has more than FAN of them; a row is rewritten once per tier at most."""
        merged, note = 0, self.table.note()
        while True:
            tiers: dict[int, list[DataFile]] = {}
            for f in self.table.files():
                if f.rows and f.rows < self.file_rows:
                    tiers.setdefault(int(math.log(f.rows, FAN)), []).append(f)
            crowded = next((t for _, t in sorted(tiers.items()) if len(t) > FAN), None)
            if crowded is None:
                break
            n = sum(f.rows for f in crowded)
            added = self.table.write(self.table.read(crowded).repartitionByRange(max(1, n // self.file_rows), self.pk).sortWithinPartitions(self.pk))
            self._index(added)
            self.table.commit(added, crowded, note=note)
            merged += len(crowded)
        if merged:
            paths = sorted(f.path for f in self.table.files())
            self.blooms.commit((), [b for b in self.blooms.files() if not _names_any(b, paths)])
        self.table.vacuum()
        self.blooms.vacuum()
        return merged


def stream_incremental_load(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    target: str,
    pk: str,
    checkpoint: str,
    *,
    pattern: str = "*.parquet",
    files_per_batch: int = 100,
    file_rows: int = FILE_ROWS,
) -> StreamingQuery:
    """Load files that arrived in ``landing`` into ``target``, first row per key wins, then stop.

    Files may arrive with keys below the highest one seen, so new keys are found against the target and not by a
    watermark. Each micro-batch is one switch of the table and notes its number: a batch that is repeated after a
    failure adds nothing. ``StreamTarget.read`` reads the table.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        StreamTarget(batch.sparkSession, target, schema, pk, file_rows).load(batch, batch_id)

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    return (
        stream.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
