"""Scores of texts by Brown's class-based bigrams.

Exchange clustering puts words into classes that make the class bigrams of the training texts likeliest: a word leaves
its class and enters the one with the largest gain. The probability of a word is that of its class after the class
before it, times its share of its class. Words that training never saw are one further outcome; how likely it is after
each class is learnt from the words seen once, which would be unseen if their one occurrence were left out.

Statistics cover every training token. Texts are turned into codes once: the most frequent words, at most HOT of them,
have a code that is broadcast; all other words stay hashes and meet their counts and classes in shuffles by hash, where
none is frequent. The EXCHANGED most frequent words go through the exact sweeps, each group of words from the same
statistics; a sweep that does not raise the likelihood is taken back. Every other word is exchanged once, against the
finished statistics, by the gain to first order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import written
from peoplelake.llm.words import LOWER, text_chunks, word_bounds, word_hashes

#: Classes of words, words in the exact sweeps, sweeps, and groups of words that a sweep exchanges side by side.
CLASSES, EXCHANGED, SWEEPS, GROUPS = 48, 8192, 3, 16
#: Words with a code: what is broadcast.
HOT = 1 << 20
#: The base model adds so much to every count.
ADD = 0.1
#: Weight of the class shares in a class's transitions, and of all first occurrences in its chance of an unseen word.
PRIOR = 10.0
#: Tokens worked on at once in a task.
TOKENS = 1 << 20
#: Leading bits of a hash by which its code is looked up.
LEADING = 21
#: Gains are summed as integers of this fraction, so that the order of the rows doesn't matter.
FRACTION = 1 << 20
#: Steps for a doubling of the count in the histogram that finds the frequent words.
STEPS = 16


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text modulo 10 is 0; a null id counts as an empty text, which is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10 == 0


def _words(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, word hashes, words of each row) of the texts of a batch, A-Z in lower case."""
    for row, n, data, offsets in text_chunks(batch):
        data = LOWER[data]
        starts, ends, first = word_bounds(data, offsets)
        yield row, n, word_hashes(data, starts, ends).view(np.int64), np.diff(first)


def word_counts(docs: DataFrame) -> DataFrame:
    """h, train and total: how often every word is in the training texts and in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        tokens = 0

        def given() -> pa.RecordBatch:
            h, at = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            train = np.bincount(at, np.concatenate([x[1] for x in held]), minlength=len(h)).astype(np.int64)
            return pa.RecordBatch.from_pydict({"h": h, "train": train, "total": np.bincount(at, minlength=len(h))})

        for batch in batches:
            learnt = ~batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for row, n, h, sizes in _words(batch):
                held.append((h, np.repeat(learnt[row : row + n], sizes)))
                tokens += len(h)
                if tokens >= 4 * TOKENS:
                    yield given()
                    held.clear()
                    tokens = 0
        if held:
            yield given()

    rows = docs.select("held_out", "text").mapInArrow(run, "h long, train long, total long")
    return written(rows.groupBy("h").agg(F.sum("train").alias("train"), F.sum("total").alias("total")), "word_counts")


@dataclass(frozen=True)
class Vocabulary:
    """The frequent words by code, most frequent first, and the sums of training tokens, distinct words and texts."""

    hashes: np.ndarray
    train: np.ndarray
    tokens: int
    distinct: int
    texts: int
    all_hot: bool

    @property
    def end(self) -> int:
        """Code of the end of a text; words without a code have -1."""
        return len(self.hashes)


def frequent_words(counts: DataFrame, texts: int, hot: int = HOT) -> Vocabulary:
    """Words from the least step of the count on that no more than ``hot`` words reach."""
    step = F.floor(F.log2(F.col("total").cast("double")) * STEPS).cast("int")
    n, tokens, distinct = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("train"), F.lit(0)), F.count(F.when(F.col("train") > 0, 1))).first()
    least, reached = None, 0
    for s, m in sorted(map(tuple, counts.groupBy(step.alias("step")).count().collect()), reverse=True):
        reached += m
        if reached > hot:
            break
        least = s
    found = counts.filter(step >= least if least is not None else F.lit(False)).toArrow()
    h, train, total = (found.column(c).to_numpy() for c in ("h", "train", "total"))
    order = np.lexsort((h, -total))
    return Vocabulary(h[order], train[order], int(tokens) + texts, int(distinct) + (texts > 0), texts, len(h) == n)


def code_table(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes as sorted unsigned numbers, their codes, and where each value of the leading bits begins."""
    order = np.argsort(hashes.view(np.uint64))
    values = hashes.view(np.uint64)[order]
    leading = np.arange(1 << LEADING, dtype=np.uint64) << np.uint64(64 - LEADING)
    return values, order.astype(np.int32), np.searchsorted(values, leading).astype(np.int32)


def codes_of(h: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Code of every hash, -1 for those without one. Hashes are spread evenly, so few steps lead from a beginning to a value."""
    values, codes, begins = table
    if not len(values):
        return np.full(len(h), -1, np.int32)
    h = h.view(np.uint64)
    at = np.minimum(begins[(h >> np.uint64(64 - LEADING)).astype(np.int64)].astype(np.int64), len(values) - 1)
    while True:
        behind = (values[at] < h) & (at < len(values) - 1)
        if not behind.any():
            return np.where(values[at] == h, codes[at], -1).astype(np.int32)
        at += behind


def encoded(docs: DataFrame, words: Vocabulary) -> DataFrame:
    """row, doc_id, held_out, codes and, in order, the hashes of the words whose code is -1."""
    shared = docs.sparkSession.sparkContext.broadcast(code_table(words.hashes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, n, h, sizes in _words(batch):
                codes = codes_of(h, shared.value)
                known = codes >= 0
                ends = np.concatenate([[0], np.cumsum(sizes)])
                rare_ends = np.concatenate([[0], np.cumsum(~known)])[ends]
                part = batch.slice(row, n)
                lists = [pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(v)) for e, v in ((ends, codes), (rare_ends, h[~known]))]
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in range(3)], *lists], names=["row", "doc_id", "held_out", "codes", "rare"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    return written(rows.mapInArrow(run, "row long, doc_id long, held_out boolean, codes array<int>, rare array<long>"), "codes", "zstd")


def sequences(batch: pa.RecordBatch, end: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, codes with an end before, between and behind the texts, hashes of the -1 ones, where texts begin).

    ``codes[1:]`` are the tokens of all texts in order, each text's end included, and ``codes[:-1]`` what stands before them.
    """
    codes, rare = batch.column(batch.schema.get_field_index("codes")), batch.column(batch.schema.get_field_index("rare"))
    offsets, rare_offsets = (np.asarray(x.offsets).astype(np.int64) for x in (codes, rare))
    values, hashes = codes.values.to_numpy(), rare.values.to_numpy()
    row, n = 0, batch.num_rows
    while row < n:
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + TOKENS, side="right")) - 1)
        ends = offsets[row : stop + 1] - offsets[row]
        sizes = np.diff(ends)
        s = np.full(int(ends[-1]) + len(sizes) + 1, end, np.int64)
        s[np.arange(int(ends[-1])) + np.repeat(np.arange(len(sizes)), sizes) + 1] = values[offsets[row] : offsets[stop]]
        yield row, stop - row, s, hashes[rare_offsets[row] : rare_offsets[stop]], ends[:-1] + np.arange(len(sizes))
        row = stop


def _once(words: Vocabulary) -> np.ndarray:
    """Whether the training texts hold a code once; false for the end and for words without a code."""
    return np.append(words.train == 1, [False, False])


@dataclass(frozen=True)
class Model:
    """Class of every code; behind the last code that of the end, and last that of words without a code."""

    k: int
    class_of: np.ndarray

    @property
    def width(self) -> int:
        """Classes, the end, unseen words, and words whose class is not known yet."""
        return self.k + 3


def first_classes(words: Vocabulary, k: int, exchanged: int) -> Model:
    """The words of the exact sweeps are dealt out by rank; all others have no class yet."""
    class_of = np.full(words.end + 2, k + 2, np.int16)
    n = min(exchanged, words.end)
    class_of[:n] = np.arange(n) % k
    class_of[: words.end][words.train == 0] = k + 1
    class_of[words.end] = k if words.texts else k + 1
    return Model(k, class_of)


def _sums(texts: DataFrame, model: Model, end: int, exchanged: int) -> DataFrame:
    """key, n: the class bigrams of the training texts, and behind them for each of the first ``exchanged`` words how often
    which class stands before it, behind it, or the word itself."""
    w, each = model.width, 2 * model.width + 1
    shared = texts.sparkSession.sparkContext.broadcast(model.class_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of = shared.value
        pairs, around = np.zeros(w * w, np.int64), np.zeros(exchanged * each, np.int64)
        for batch in batches:
            for _, _, s, _, _ in sequences(batch, end):
                c = class_of[s].astype(np.int64)
                pairs += np.bincount(c[:-1] * w + c[1:], minlength=w * w)
                own = s[:-1] == s[1:]
                for word, context, base in ((s[1:], c[:-1], 0), (s[:-1], c[1:], w)):
                    at = (word >= 0) & (word < exchanged) & ~own
                    around += np.bincount(word[at] * each + base + context[at], minlength=len(around))
                at = own & (s[1:] >= 0) & (s[1:] < exchanged)
                around += np.bincount(s[1:][at] * each + 2 * w, minlength=len(around))
        both = np.concatenate([pairs, around])
        keys = np.flatnonzero(both)
        for low in range(0, len(keys), 1 << 16):
            yield pa.RecordBatch.from_pydict({"key": keys[low : low + (1 << 16)], "n": both[keys[low : low + (1 << 16)]]})

    rows = texts.filter("NOT held_out").select("codes", "rare").mapInArrow(run, "key long, n long")
    return written(rows.groupBy("key").agg(F.sum("n").alias("n")), "class_sums")


def _matrix(sums: DataFrame, w: int) -> np.ndarray:
    out = np.zeros(w * w)
    for key, n in sums.filter(F.col("key") < w * w).collect():
        out[key] = n
    return out.reshape(w, w)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray) -> float:
    """Log-likelihood of class bigrams, but for a part that classes don't change."""
    return float(_xlogx(pairs).sum() - _xlogx(pairs.sum(axis=0)).sum() - _xlogx(pairs.sum(axis=1)).sum())


def gains(pairs: np.ndarray, before: np.ndarray, behind: np.ndarray, itself: float, k: int) -> np.ndarray:
    """What the likelihood gains, but for a sum that is the same for all, if a word with these neighbours enters each of the ``k`` classes."""
    rows, columns, corner = pairs[:k], pairs[:, :k].T, np.diag(pairs)[:k]
    out = (_xlogx(rows + behind) - _xlogx(rows)).sum(axis=1) + (_xlogx(columns + before) - _xlogx(columns)).sum(axis=1)
    out -= _xlogx(corner + behind[:k]) + _xlogx(corner + before[:k]) - _xlogx(corner)
    out += _xlogx(corner + behind[:k] + before[:k] + itself)
    # the sums of its neighbours' classes hold the word's bigrams already, whatever class it enters
    leaving, entering = pairs.sum(axis=1)[:k] + before[:k], pairs.sum(axis=0)[:k] + behind[:k]
    out -= _xlogx(leaving + behind.sum() + itself) - _xlogx(leaving)
    out -= _xlogx(entering + before.sum() + itself) - _xlogx(entering)
    return out


def _moved(pairs: np.ndarray, c: int, before: np.ndarray, behind: np.ndarray, itself: float, sign: int) -> None:
    pairs[c] += sign * behind
    pairs[:, c] += sign * before
    pairs[c, c] += sign * itself


def exchange(pairs: np.ndarray, around: np.ndarray, classes: np.ndarray, k: int) -> np.ndarray:
    """Classes after every word, in the order given, has left its class and entered the best one (ties: the smaller number)."""
    pairs, classes, w = pairs.copy(), classes.copy(), pairs.shape[0]
    for i, row in enumerate(around):
        before, behind, itself = row[:w], row[w : 2 * w], row[2 * w]
        _moved(pairs, classes[i], before, behind, itself, -1)
        np.maximum(pairs, 0, out=pairs)
        gain = gains(pairs, before, behind, itself, k)
        classes[i] = int(gain.argmax()) if gain.max() > gain[classes[i]] + 1e-9 else classes[i]
        _moved(pairs, classes[i], before, behind, itself, 1)
    return classes


def _swept(sums: DataFrame, pairs: np.ndarray, model: Model, exchanged: int, groups: int) -> Model:
    """The model after one sweep: every group of words from the same statistics, frequent words first."""
    w, k, each, class_of = model.width, model.k, 2 * model.width + 1, model.class_of[:exchanged]
    at = F.col("key") - w * w
    rows = sums.filter(at >= 0).select(F.floor(at / each).cast("int").alias("word"), (at % each).cast("int").alias("context"), "n")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words, place = np.unique(pdf["word"].to_numpy(), return_inverse=True)
        around = np.zeros((len(words), each))
        np.add.at(around, (place, pdf["context"].to_numpy()), pdf["n"].to_numpy())
        return pd.DataFrame({"word": words, "class": exchange(pairs, around, class_of[words].astype(np.int64), k)})

    found = rows.groupBy(F.pmod(F.xxhash64("word"), F.lit(groups)).alias("g")).applyInPandas(run, "word int, class long").toArrow()
    after = model.class_of.copy()
    after[found.column("word").to_numpy()] = found.column("class").to_numpy()
    return Model(k, after)


def learnt_classes(texts: DataFrame, words: Vocabulary, k: int = CLASSES, exchanged: int = EXCHANGED, sweeps: int = SWEEPS, groups: int = GROUPS) -> tuple[Model, np.ndarray, list[float]]:
    """Classes of the most frequent words, their class bigrams, and the likelihood before and after each sweep."""
    model = first_classes(words, k, exchanged)
    exchanged = min(exchanged, words.end)
    best, seen = None, []
    for sweep in range(sweeps + 1):
        sums = _sums(texts, model, words.end, exchanged if sweep < sweeps else 0)
        pairs = _matrix(sums, model.width)
        seen.append(likelihood(pairs))
        if best is not None and seen[-1] <= best[2]:
            break
        best = (model, pairs, seen[-1])
        if sweep < sweeps and exchanged:
            model = _swept(sums, pairs, model, exchanged, groups)
    return best[0], best[1], seen


def other_words(texts: DataFrame, words: Vocabulary, model: Model, pairs: np.ndarray) -> DataFrame:
    """h, has_code, class and n (training tokens) of every training word without a class, by the gain to first order."""
    k, w, end = model.k, model.width, words.end
    log = np.round(FRACTION * np.log(pairs + 0.5)).astype(np.int64)
    own = sum(np.round(FRACTION * np.log(np.maximum(pairs.sum(axis=i)[:k], 1.0))).astype(np.int64) for i in (0, 1))
    # what one occurrence between a and b adds to the gain of each class
    before, behind = log[:, :k], log[:k].T
    shared = texts.sparkSession.sparkContext.broadcast((model.class_of, words.hashes))

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, hashes = shared.value
        for batch in batches:
            for _, _, s, rare, _ in sequences(batch, end):
                c = class_of[s].astype(np.int64)
                at = np.flatnonzero((c == w - 1) & (s != end))
                if not len(at):
                    continue
                values, place = np.unique(rare, return_inverse=True)
                word = s[at].copy()
                word[word < 0] = end + place
                key, n = np.unique((word * w + c[at - 1]) * w + c[at + 1], return_counts=True)
                word, context = key // (w * w), key % (w * w)
                coded = word < end
                h = np.empty(len(word), np.int64)
                h[coded], h[~coded] = hashes[word[coded]], values[word[~coded] - end]
                yield pa.RecordBatch.from_pydict({"h": h, "context": (context * 2 + coded).astype(np.int32), "n": n.astype(np.int32)})

    rows = texts.filter("NOT held_out").select("codes", "rare").mapInArrow(around, "h long, context int, n int")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: tuple[int, bool, np.ndarray, int] | None = None
        for batch in batches:
            for low in range(0, batch.num_rows, 1 << 16):
                h, context, n = (c.to_numpy() for c in batch.slice(low, 1 << 16).columns)
                first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
                pair = context >> 1
                gain = np.add.reduceat((before[pair // w] + behind[pair % w]) * n[:, None].astype(np.int64), first, axis=0)
                count, word, coded = np.add.reduceat(n.astype(np.int64), first), h[first], (context[first] & 1).astype(bool)
                if carried is not None and carried[0] == word[0]:
                    gain[0] += carried[2]
                    count[0] += carried[3]
                elif carried is not None:
                    word, coded = np.append(carried[0], word), np.append(carried[1], coded)
                    gain, count = np.concatenate([carried[2][None], gain]), np.append(carried[3], count)
                carried = (int(word[-1]), bool(coded[-1]), gain[-1], int(count[-1]))
                if len(word) > 1:
                    yield chosen(word[:-1], coded[:-1], gain[:-1], count[:-1])
        if carried is not None:
            yield chosen(np.array([carried[0]]), np.array([carried[1]]), carried[2][None], np.array([carried[3]]))

    def chosen(word: np.ndarray, coded: np.ndarray, gain: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        best = (gain - count[:, None] * own).argmax(axis=1)
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(coded), pa.array(best.astype(np.int16)), pa.array(count)], names=["h", "has_code", "class", "n"])

    rows = rows.repartition("h").sortWithinPartitions("h")
    return written(rows.mapInArrow(assign, "h long, has_code boolean, class short, n long"), "word_classes")


def with_other_words(words: Vocabulary, model: Model, classes: DataFrame) -> Model:
    """The model with the classes of all words that have a code."""
    found = classes.filter("has_code").select("h", "class").toArrow()
    order = np.argsort(words.hashes)
    class_of = model.class_of.copy()
    class_of[order[np.searchsorted(words.hashes[order], found.column("h").to_numpy())]] = found.column("class").to_numpy()
    return Model(model.k, class_of)


def rare_tokens(texts: DataFrame, words: Vocabulary, model: Model, classes: DataFrame) -> DataFrame:
    """row, held_out, class and n (training count, 0 if unseen) of every word without a code, with the class before it and
    whether that word was seen once, and the same behind it; behind is null where that word has no code either.
    """
    w, end, unseen = model.width, words.end, model.k + 1
    shared = texts.sparkSession.sparkContext.broadcast((model.class_of, _once(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, once = shared.value
        for batch in batches:
            rows, held = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for row, n, s, rare, first in sequences(batch.select(["codes", "rare"]), end):
                at = np.flatnonzero(s < 0)
                if not len(at):
                    continue
                text = row + np.searchsorted(first, at - 1, side="right") - 1
                c = class_of[s]
                yield pa.RecordBatch.from_pydict(
                    {"row": rows[text], "held_out": held[text], "place": at - 1 - first[text - row], "h": rare, "before": c[at - 1], "behind": c[at + 1], "once_before": once[s[at - 1]], "once_behind": once[s[at + 1]]}
                )

    fields = "row long, held_out boolean, place long, h long, before short, behind short, once_before boolean, once_behind boolean"
    rows = texts.filter(F.size("rare") > 0).select("row", "held_out", "codes", "rare").mapInArrow(run, fields)
    known = classes.filter("NOT has_code").select("h", "class", "n")
    rows = rows.join(known, "h", "left").select(
        "row", "held_out", "place", "before", "behind", "once_before", "once_behind", F.coalesce("class", F.lit(unseen).cast("short")).alias("class"), F.coalesce("n", F.lit(0)).alias("n")
    )
    order = Window.partitionBy("row").orderBy("place")
    waits = F.col("before") == w - 1
    rows = rows.select(
        "row", "held_out", "class", "n", F.when(waits, F.lag("class").over(order)).otherwise(F.col("before")).alias("before"),
        F.when(waits, F.lag("n").over(order) == 1).otherwise(F.col("once_before")).alias("once_before"),
        F.when(F.col("behind") != w - 1, F.col("behind")).alias("behind"), "once_behind",
    )
    return written(rows, "rare_tokens")


def transitions(texts: DataFrame, words: Vocabulary, model: Model, rare: DataFrame | None) -> np.ndarray:
    """Training counts of (class before, class), and in the row and column of unseen words those from and to words seen once."""
    k, w, end = model.k, model.width, words.end
    shared = texts.sparkSession.sparkContext.broadcast((model.class_of, _once(words)))
    unseen = k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, once = shared.value
        out = np.zeros(w * w, np.int64)
        for batch in batches:
            for _, _, s, _, _ in sequences(batch, end):
                c = class_of[s].astype(np.int64)
                a, b = c[:-1], c[1:]
                out += np.bincount(a * w + b, minlength=w * w)
                out += np.bincount(a[once[s[1:]]] * w + unseen, minlength=w * w)
                out += np.bincount(unseen * w + b[once[s[:-1]]], minlength=w * w)
        keys = np.flatnonzero(out)
        yield pa.RecordBatch.from_pydict({"key": keys, "n": out[keys]})

    rows = texts.filter("NOT held_out").select("codes", "rare").mapInArrow(run, "key long, n long")
    if rare is not None:
        rare = rare.filter("NOT held_out")
        key = lambda a, b: (F.col(a) if isinstance(a, str) else F.lit(a)).cast("long") * w + (F.col(b) if isinstance(b, str) else F.lit(b))
        edges = [
            (F.lit(True), key("before", "class")), (F.col("n") == 1, key("before", unseen)), (F.col("once_before"), key(unseen, "class")),
            (F.col("behind").isNotNull(), key("class", "behind")), ((F.col("n") == 1) & F.col("behind").isNotNull(), key(unseen, "behind")),
            (F.col("once_behind"), key("class", unseen)),
        ]
        each = F.filter(F.array(*[F.when(on, at) for on, at in edges]), lambda x: x.isNotNull())
        rows = rows.unionByName(rare.select(F.explode(each).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")))
    out = np.zeros(w * w)
    for at, n in rows.groupBy("key").agg(F.sum("n").alias("n")).collect():
        out[at] = n
    out = out.reshape(w, w)
    # words whose class was not known are counted with the rare tokens
    out[w - 1], out[:, w - 1] = 0, 0
    return out


def log_transitions(counts: np.ndarray, k: int, tokens: int) -> np.ndarray:
    """log10 of the chance of each class, or of an unseen word, after each class; each row adds up to one."""
    unseen = k + 1
    out = np.zeros(counts.shape)
    if not tokens:
        return out
    known = counts[:, : k + 1].copy()
    share = known[: k + 1].sum(axis=0)
    share = share / share.sum()
    sums = known.sum(axis=1)
    once = counts[: k + 1, unseen].sum()
    new = (counts[:, unseen] * (np.arange(len(counts)) != unseen) + PRIOR * (once + 0.5) / (tokens + 1)) / (sums + PRIOR)
    new = np.minimum(new, 1 - 1e-9)
    with np.errstate(divide="ignore"):
        out[:, : k + 1] = np.log10((known + PRIOR * share) / (sums + PRIOR)[:, None]) + np.log10(1 - new)[:, None]
    out[:, unseen] = np.log10(new)
    return out


def scored_documents(docs: DataFrame, k: int = CLASSES, exchanged: int = EXCHANGED, sweeps: int = SWEEPS, hot: int = HOT) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every text.

    Null texts are empty and have their end as only token. Null ids count as an empty id text. Repeated rows count as
    often as they are there. Without training texts every token is unseen, and the only outcome: scores are zero. Words
    are told apart by 64-bit hashes.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"), "text")
    counts = word_counts(docs)
    words = frequent_words(counts, docs.filter("NOT held_out").count(), hot)
    texts = encoded(docs, words)
    model, pairs, _ = learnt_classes(texts, words, k, exchanged, sweeps)
    classes = other_words(texts, words, model, pairs)
    model = with_other_words(words, model, classes)
    rare = None if words.all_hot else rare_tokens(texts, words, model, classes)
    moves = transitions(texts, words, model, rare)
    log = log_transitions(moves, model.k, words.tokens)
    size = moves[:, : k + 1].sum(axis=0) - moves[k + 1, : k + 1]
    return _scored(texts, words, model, rare, log, size)


def _scored(texts: DataFrame, words: Vocabulary, model: Model, rare: DataFrame | None, log: np.ndarray, size: np.ndarray) -> DataFrame:
    k, w, end, n_train = model.k, model.width, words.end, words.tokens
    total = n_train + ADD * (words.distinct + 1)
    train = np.append(words.train, [words.texts, 0]).astype(np.float64)
    base_of = np.log10((train + ADD) / total)
    own = np.zeros(len(train))
    seen = train > 0
    own[seen] = np.log10(train[seen] / np.maximum(size[np.minimum(model.class_of[seen], k)], 1))
    base_of[-1] = 0.0
    shared = texts.sparkSession.sparkContext.broadcast((model.class_of, base_of, own, seen, log))
    fields = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        class_of, base_of, own, seen, log = shared.value
        log = np.where(np.arange(w)[:, None] == w - 1, 0.0, np.where(np.arange(w)[None, :] == w - 1, 0.0, log))
        for batch in batches:
            for row, n, s, _, first in sequences(batch, end):
                part, c, t = batch.slice(row, n), class_of[s], s[1:]
                score = np.add.reduceat(own[t] + log[c[:-1], c[1:]], first)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), part.column(2), pa.array(np.diff(np.append(first, len(t)))), pa.array(np.add.reduceat(seen[t].astype(np.int64), first)),
                        pa.array(np.add.reduceat(base_of[t], first)), pa.array(score),
                    ],
                    names=[f.split(" ")[0] for f in fields.split(", ")],
                )

    rows = texts.mapInArrow(run, fields)
    if rare is not None:
        step = F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in log])
        of = lambda a, b: F.get(F.get(step, F.col(a).cast("int")), F.col(b).cast("int"))
        sizes = F.array(*[F.lit(float(max(x, 1.0))) for x in size], F.lit(1.0), F.lit(1.0))
        emitted = F.when(F.col("n") > 0, F.log10(F.col("n") / F.get(sizes, F.col("class").cast("int")))).otherwise(0.0)
        more = rare.groupBy("row").agg(
            F.sum((F.col("n") > 0).cast("long")).alias("known"), F.sum(F.log10((F.col("n") + ADD) / F.lit(float(total)))).alias("base"),
            F.sum(of("before", "class") + emitted + F.coalesce(of("class", "behind"), F.lit(0.0))).alias("extra"),
        )
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        rows = rows.join(more, "row", "left").select(
            "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("known")).alias("n_known"),
            (F.col("base_score") + zero("base")).alias("base_score"), (F.col("score") + zero("extra")).alias("score"),
        )
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
