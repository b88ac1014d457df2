"""Token ids as flat unsigned integer files with 64-bit document offsets.

A data set is a folder of parts in ascending order of (doc_id, text hash), nulls first:

* ``<part>.bin``: token ids of all documents of the part, one after the other, little-endian, 16 bits for vocabularies
  of up to 65,536 ids and 32 bits beyond;
* ``<part>.idx``: little-endian 64-bit integers: number of documents n, id width in bytes, n + 1 offsets counted over the
  whole data set (the first is the part's base), n document ids, n flags (1: the document id is null).

Both can be memory-mapped. ``manifest`` is a table with a row for each part. Files carry the name of the task attempt
that wrote them; only attempts that the manifest names belong to the data set, so repeated tasks do no harm.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import shared_dir

#: White space with the letters or other characters after it. Letters are taken alone only before white space, ASCII
#: punctuation or digits, where the tokenizer splits as well.
PIECE = re.compile(r"[ \t-\r]*(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+(?=[ \t-\r!-@\[-`{-~]|$)|[^ \t-\r]+)|[ \t-\r]+")
#: White space to some regular expression engines; texts that hold any are encoded in one piece.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
SPACE = frozenset(" \t\n\v\f\r")
#: Pieces in each of the two generations that a Python worker remembers, about 100 MB in all.
CACHED_PIECES = 300_000
PARTS_SCHEMA = "part int, data string, lengths string, n_docs long, n_tokens long"
READ_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def _write(uri: str, *blocks) -> None:
    store, path = _store(uri)
    with store.open_output_stream(path) as out:
        for block in blocks:
            out.write(block)


def _mapped(uri: str, kind) -> np.ndarray:
    """A local file memory-mapped, any other read."""
    from pyarrow import fs

    store, path = _store(uri)
    if isinstance(store, fs.LocalFileSystem):
        return np.memmap(path, dtype=kind, mode="r") if os.path.getsize(path) else np.zeros(0, kind)
    with store.open_input_file(path) as source:
        return np.frombuffer(source.read(), dtype=kind)


def _has_other_space(text: str) -> bool:
    if text.isascii():
        return "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text
    return OTHER_SPACE.search(text) is not None


class Encoder:
    """Token ids of whole texts as bytes.

    The byte-level tokenizer splits a text before every run of white space that follows something else and between
    letters and punctuation or digits, whatever comes later; so each piece from such a point to the next has the ids it has inside the text, and a piece that comes again
    is looked up. Two generations are kept: pieces that come again move to the young one, and when it is full it becomes
    the old one, whose pieces are forgotten.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        vocabulary = self.tokenizer.get_vocab()
        # a byte-level vocabulary writes every byte as one character
        self.widths = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        self.widths[list(vocabulary.values())] = [len(token) for token in vocabulary]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [e.ids for e in encoded]
        ends = np.cumsum([len(i) for i in ids], dtype=np.int64) * self.kind.itemsize
        flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=self.kind).tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)]

    def ids_in_one(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that begin with white space and end with something else, encoded as one text.

        The tokenizer splits before each, and the bytes of the tokens tell where one ends; if they ever don't, every piece
        is encoded by itself.
        """
        ids = np.array(self.tokenizer.encode_batch_fast(["".join(pieces)], add_special_tokens=False)[0].ids, dtype=np.int64)
        ends = np.cumsum(self.widths[ids])
        wanted = np.cumsum([len(p.encode()) for p in pieces])
        at = np.searchsorted(ends, wanted)
        if not len(ends) or ends[-1] != wanted[-1] or not np.array_equal(ends[at], wanted):
            return self.ids(pieces)
        flat, cuts = ids.astype(self.kind).tobytes(), ((at + 1) * self.kind.itemsize).tolist()
        return [flat[a:b] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = {t for t in texts if _has_other_space(t)}
        pieces = [[t] if t in whole else PIECE.findall(t) for t in texts] if whole else list(map(PIECE.findall, texts))
        if len(self.young) > CACHED_PIECES:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        fresh = set().union(*pieces).difference(young)
        again = fresh & old.keys()
        young.update((p, old[p]) for p in again)
        fresh -= again
        joined = [p for p in fresh if p[0] in SPACE and p[-1] not in SPACE and p not in whole]
        single = list(fresh.difference(joined))
        for group in _text_groups(joined):
            young.update(zip(group, self.ids_in_one(group), strict=True))
        young.update(zip(single, self.ids(single), strict=True))
        return [b"".join(map(young.__getitem__, text)) for text in pieces]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _text_groups(texts: list[str], chars: int = 1 << 20) -> Iterator[list[str]]:
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= chars:
            yield group
            group, size = [], 0
    if group:
        yield group


def write_tokens(docs: DataFrame, tokenizer: str, root: str | None = None, end_id: int = 0) -> DataFrame:
    """Encode every text (null: empty), append ``end_id`` and write the data set; returns its manifest.

    ``tokenizer`` is the path of a byte-level BPE file. Rows with the same doc_id are documents of their own, in the
    order of a text hash. An empty table gives a data set without parts. Other columns are ignored.
    """
    spark = docs.sparkSession
    root = root or shared_dir(spark, "tokens")

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, name = TaskContext.get().partitionId(), uuid.uuid4().hex
        data, encode = f"{root}/{number:06d}-{name}.bin", encoder(tokenizer)
        end = np.array([end_id], dtype=encode.kind).tobytes()
        lengths, keys, missing, out = [], [], [], None
        for batch in batches:
            if batch.num_rows and out is None:
                store, path = _store(data)
                store.create_dir(os.path.dirname(path), recursive=True)
                out = store.open_output_stream(path)
            ids = batch.column(0)
            keys.append(ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
            missing.append(ids.is_null().to_numpy(zero_copy_only=False).astype("<i8"))
            column = batch.column(1)
            for low in range(0, batch.num_rows, 256):
                for group in _text_groups(column.slice(low, 256).to_pylist()):
                    encoded = encode.encode(group)
                    lengths += [len(e) // encode.kind.itemsize + 1 for e in encoded]
                    out.write(b"".join(x for e in encoded for x in (e, end)))
        if out is None:
            return
        out.close()
        sizes = np.array(lengths, dtype="<i8")
        _write(data[:-3] + "len", sizes.tobytes(), np.concatenate(keys).tobytes(), np.concatenate(missing).tobytes())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([number], pa.int32()), "data": [data], "lengths": [data[:-3] + "len"], "n_docs": [len(sizes)], "n_tokens": [int(sizes.sum())]}
        )

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = encoder(tokenizer).kind.itemsize
        for batch in batches:
            paths = []
            for row in batch.to_pylist():
                n, sides = row["n_docs"], _mapped(row["lengths"], "<i8")
                offsets = np.zeros(n + 1, dtype="<i8")
                np.cumsum(sides[:n], out=offsets[1:])
                path = row["data"][:-4] + f"-{uuid.uuid4().hex}.idx"
                _write(path, np.array([n, width], dtype="<i8").tobytes(), (offsets + row["base"]).tobytes(), sides[n:].tobytes())
                paths.append(path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(paths, pa.string())], names=[*batch.schema.names, "index"])

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("doc_id"), F.xxhash64("text")]
    parts = ordered.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(part, PARTS_SCHEMA)
    parts.write.parquet(f"{root}/parts")
    parts = spark.read.schema(PARTS_SCHEMA).parquet(f"{root}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    based = parts.withColumn("base", F.sum("n_tokens").over(before) - F.col("n_tokens"))
    schema = f"{PARTS_SCHEMA}, base long, index string"
    based.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(index, schema).write.parquet(f"{root}/manifest")
    return spark.read.schema(schema).parquet(f"{root}/manifest")


def read_part(data: str, index: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token ids, offsets over the data set, document ids and null flags of one part."""
    table = _mapped(index, "<i8")
    n, width = int(table[0]), int(table[1])
    return _mapped(data, f"<u{width}"), table[2 : n + 3], table[n + 3 : 2 * n + 3], table[2 * n + 3 :]


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Every document of a data set from its files: doc_id, start, n_tokens and the CRC-32 of its ids as 32-bit integers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, keys, missing = read_part(row["data"], row["index"])
                for low in range(0, len(keys), 10_000):
                    at = np.asarray(offsets[low : low + 10_001])
                    local = at - int(offsets[0])
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(local[:-1], local[1:], strict=True)]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(np.asarray(keys[low : low + 10_000]), mask=np.asarray(missing[low : low + 10_000]) == 1),
                            "start": at[:-1], "n_tokens": np.diff(at), "ids_crc32": pa.array(sums, pa.int64()),
                        }
                    )

    parts = manifest.select("data", "index").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism))
    return parts.mapInArrow(rows, READ_SCHEMA)
