"""Removal of repeated passages by level-wise doubling of word windows.

Level one looks at windows of half the length, only at those that have the smallest hash around them: any two equal
windows of full length hold the same one. Half windows that occur in one text alone end there; the full windows around
the others are the candidates of level two, whose first owner, the smallest doc_id, is found by hash. A document then
removes the words of each candidate that it does not own and of each window that it has already had itself.
``repeated_lengths`` goes on doubling until no candidate is left. Exact copies of a text are set aside first: their
windows all start in the original.

Only minima and counts are taken per hash, with a partial step in every task, so a passage that a third of the
documents share is no task of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import written
from peoplelake.llm.words import MULTIPLIERS, joined_words, mixed, text_chunks, window_hashes, word_bounds, word_hashes

WINDOW = 20


class Windows:
    """Words, windows and half windows of the texts of a chunk."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, window: int = WINDOW):
        self.data, self.window, half = data, window, window // 2
        self.starts, self.ends, self.first = word_bounds(data, offsets)
        self.counts = np.diff(self.first)
        self.hashes = word_hashes(data, self.starts, self.ends)
        #: where full windows start, by word
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        place = np.arange(len(self.row)) - self.first[self.row]
        self.at = np.flatnonzero(place + window <= self.counts[self.row])
        # 48 bits: a false repeat only makes one more candidate, and fewer bytes are exchanged
        self.half = window_hashes(self.hashes, half) >> np.uint64(16)
        #: for each full window, the place of the half window in it with the smallest hash, the leftmost of equal ones
        self.chosen = self._smallest(window - half + 1)[self.at] if len(self.at) else self.at

    def _smallest(self, width: int) -> np.ndarray:
        best, place, have = self.half, np.arange(len(self.half)), 1
        while have < width:
            step = min(have, width - have)
            left, right = best[:-step], best[step:]
            place = np.where(right < left, place[step:], place[:-step])
            best, have = np.minimum(left, right), have + step
        return place

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of the chosen half windows, each once a row."""
        places = np.unique(self.chosen)
        return distinct(self.row[places], self.half[places])

    def candidates(self, repeated: np.ndarray) -> np.ndarray:
        """Which full windows stand around a repeated half window; ``repeated`` is sorted."""
        return among(self.half[self.chosen], repeated)

    def again(self) -> np.ndarray:
        """Which full windows stand around a half window that the same text has at another place as well."""
        places = np.unique(self.chosen)
        keys = paired(self.row[places], self.half[places])
        _, back, counts = np.unique(keys, return_inverse=True, return_counts=True)
        twice = np.zeros(len(self.half) + 1, bool)
        twice[places] = counts[back] > 1
        return twice[self.chosen]

    def full(self, which: np.ndarray, multiplier: int = MULTIPLIERS[0]) -> np.ndarray:
        return window_hashes(self.hashes, self.window, multiplier)[self.at[which]]


def paired(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mixed(hashes ^ mixed(rows.astype(np.uint64) + np.uint64(1)))


def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, once = np.unique(paired(rows, hashes), return_index=True)
    return rows[once], hashes[once]


def among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _longs(column: pa.Array) -> np.ndarray:
    """Values of a list column, one list after the other."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)


def _lengths(column: pa.Array) -> np.ndarray:
    return pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _originals(docs: DataFrame) -> DataFrame:
    """doc_id, key, text and copy of every row, by key.

    The key is doc_id, or a hash of the text where that is null: rows with one doc_id are one document. A row is a copy
    when the same text has a smaller key.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    rows = rows.withColumn("key", F.coalesce("doc_id", "th"))
    first = rows.groupBy("th", F.xxhash64(F.lit(1), "text").alias("th2")).agg(F.min("key").alias("key"))
    first = written(first.groupBy("key").agg(F.collect_set("th").alias("own")), "originals")
    rows = rows.join(first, "key", "left")
    return rows.select("key", "doc_id", "text", F.coalesce(~F.array_contains("own", F.col("th")), F.lit(True)).alias("copy"))


def _half_windows(rows: DataFrame, window: int) -> DataFrame:
    """(h, key) of every chosen half window of the originals, once a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, n, data, offsets in text_chunks(batch):
                rows, hashes = Windows(data, offsets, window).anchors()
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(keys[row : row + n][rows])], names=["h", "key"])

    return rows.filter("NOT copy").select("key", "text").mapInArrow(run, "h long, key long")


def repeated_half_windows(rows: DataFrame, window: int) -> DataFrame:
    """(key, halves): of every document, the half windows that other documents hold as well."""
    found = _half_windows(rows, window)
    several = found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h")
    return found.join(several, "h").groupBy("key").agg(F.collect_list("h").alias("halves"))


def owned_windows(rows: DataFrame, halves: DataFrame, window: int) -> DataFrame:
    """(key, owned): of every document, the candidate windows that it is the first to hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for row, n, data, offsets in text_chunks(batch):
                w = Windows(data, offsets, window)
                which = w.candidates(np.unique(_longs(batch.slice(row, n).column(2))))
                rows, one, two = w.row[w.at[which]], w.full(which), w.full(which, MULTIPLIERS[1]) >> np.uint64(32)
                _, once = np.unique(paired(rows, one), return_index=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one[once].view(np.int64)), pa.array(two[once].astype(np.uint32).view(np.int32)), pa.array(keys[row : row + n][rows[once]])],
                    names=["h", "g", "key"],
                )

    found = rows.filter("NOT copy").select("key", "text").join(halves, "key").select("key", "text", "halves")
    found = found.mapInArrow(run, "h long, g int, key long").groupBy("h", "g").agg(F.min("key").alias("key"))
    return found.groupBy("key").agg(F.collect_list("h").alias("owned"))


def covered_words(w: Windows, copies: np.ndarray, keys: np.ndarray, halves: np.ndarray, owned: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """Which words stand in a window that starts earlier as well. ``owned`` hashes are sorted, ``owners`` are their keys."""
    shared = w.candidates(halves)
    which = shared | w.again()
    rows, hashes, shared = w.row[w.at[which]], w.full(which), shared[which]
    late = np.ones(len(rows), bool)
    late[np.unique(paired(rows, hashes), return_index=True)[1]] = False
    if len(owned):
        at = np.minimum(np.searchsorted(owned, hashes), len(owned) - 1)
        mine = (owned[at] == hashes) & (owners[at] == keys[rows])
    else:
        mine = np.zeros(len(rows), bool)
    gone = w.at[which][late | (shared & ~mine)]
    steps = np.zeros(len(w.starts) + 1, np.int64)
    np.add.at(steps, gone, 1)
    np.add.at(steps, gone + w.window, -1)
    return (np.cumsum(steps)[:-1] > 0) | (copies[w.row] & (w.counts[w.row] >= w.window))


def without_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document; also the kept words as ``text``, if asked for.

    A null text has no words. Texts shorter than the window are kept. Rows with one doc_id are one document: a window
    that another row of it holds is not earlier, and equal rows get equal results; a null doc_id stands for the hash
    of the text. Other columns are left out.
    """
    rows = _originals(docs)
    halves = repeated_half_windows(rows, window)
    owned = owned_windows(rows, halves, window)
    every = rows.join(halves, "key", "left").join(owned, "key", "left").select("key", "doc_id", "copy", "halves", "owned", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, data, offsets in text_chunks(batch):
                part = batch.slice(row, n)
                keys, copies = part.column(0).to_numpy(), part.column(2).to_numpy(zero_copy_only=False)
                w = Windows(data, offsets, window)
                mine, owners = _longs(part.column(4)), np.repeat(keys, _lengths(part.column(4)))
                order = np.argsort(mine, kind="stable")
                gone = covered_words(w, copies, keys, np.unique(_longs(part.column(3))), mine[order], owners[order])
                kept = ~gone
                joined, a, z = joined_words(data, w.starts[kept], w.ends[kept])
                cut = np.searchsorted(np.flatnonzero(kept), w.first)
                texts_of = [joined[a[i] : z[j - 1]] if j > i else b"" for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
                columns = [
                    part.column(1), pa.array(w.counts.astype(np.int64)), pa.array((w.counts - np.diff(cut)).astype(np.int64)),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts_of]),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if texts:
                    columns, names = [*columns, pa.array([t.decode() for t in texts_of], pa.string())], [*names, "text"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return every.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", text string" * texts)


def _texts(docs: DataFrame) -> DataFrame:
    """key, weight and text of every distinct text; weight is the number of documents that have it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    rows = rows.select(F.coalesce("doc_id", "th").alias("key"), "th", F.xxhash64(F.lit(1), "text").alias("th2"), "text").dropDuplicates(["key", "th", "th2"])
    rows = rows.groupBy("th", "th2").agg(F.count(F.lit(1)).alias("weight"), F.min("key").alias("first"), F.first("text").alias("text"))
    return written(rows.select(F.xxhash64("th", "th2", "first").alias("key"), "weight", "text", F.lit(False).alias("copy")), "texts")


def _windows_of(texts: DataFrame, length: int) -> DataFrame:
    """(h, key, n) of the windows of ``length`` words that may repeat: how often a text and its copies hold each.

    At the first length those are the windows around repeated half windows, and all of a text with copies; later those
    whose two halves, the windows of half the length, both repeat. ``texts`` has the repeated hashes as ``known``.
    """
    first = "halves" in texts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, weights = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for row, n, data, offsets in text_chunks(batch):
                known = np.unique(_longs(batch.slice(row, n).column(3)))
                w = Windows(data, offsets, length)
                if first:
                    which = w.candidates(known) | w.again() | (weights[row : row + n][w.row[w.at]] > 1)
                else:
                    again = among(window_hashes(w.hashes, length // 2), known)
                    which = again[w.at] & again[w.at + length // 2]
                rows, hashes = w.row[w.at[which]], w.full(which)
                _, once, counts = np.unique(paired(rows, hashes), return_index=True, return_counts=True)
                rows = row + rows[once]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[once].view(np.int64)), pa.array(keys[rows]), pa.array(counts * weights[rows])], names=["h", "key", "n"]
                )

    return written(texts.mapInArrow(run, "h long, key long, n long"), "windows")


def repeated_lengths(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(n_words, windows, occurrences) for the lengths ``window``, twice that, and so on until no window repeats.

    A window repeats if it occurs more than once, in copies of a text or inside one text as well; null texts have none.
    Rows of one doc_id and text are one document. The windows that repeat at one length alone are carried on: a window
    twice as long can repeat only if both its halves did.
    """
    base, out, length = _texts(docs), None, window
    halves = repeated_half_windows(base, window)
    texts = base.join(halves, "key", "left").select("key", "weight", "text", "halves")
    while True:
        found = _windows_of(texts, length)
        several = written(found.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1"), "repeated")
        level = several.agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("n"), F.lit(0)).alias("occurrences"))
        level = written(level.select(F.lit(length).cast("long").alias("n_words"), "windows", "occurrences"), "lengths")
        if not level.first()["windows"]:
            return level.limit(0) if out is None else out
        out, length = level if out is None else out.unionByName(level), 2 * length
        known = found.join(several.select("h"), "h").groupBy("key").agg(F.collect_list("h").alias("known"))
        texts = base.join(known, "key").select("key", "weight", "text", "known")
