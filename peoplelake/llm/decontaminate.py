"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted verification.

A window is as long as a benchmark item and aligned with it at a shingle that both hold; a window without a common
shingle has similarity zero, so it needs no fingerprint. Of a run of common shingles on one alignment the first stands
for all. Fingerprints of windows and items meet in a multi-index: four blocks of 16 bits, of which one at least
differs in at most four bits when all 64 differ in at most 19, whatever item brought the window about. Candidates are
verified by the Jaccard similarity of their shingles, plain and weighted, of which the larger one counts: a shingle
counts as often as it occurs, when weighted divided by the number of item texts that hold it. Both have fingerprints.
All of it is DataFrame expressions.

Words are in lower case and separated by white space; items of fewer words than a shingle are one shingle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import set_aside, written

SHINGLE = 5
SIMILARITY = 0.8
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 4, 16, 4
#: The largest radius for which some block differs in at most BLOCK_RADIUS bits.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Item shingles are broadcast up to this many rows (about 50 MB), else joined by a shuffle.
BROADCAST_ROWS = 1_000_000
SPACE = " \t\n\x0b\x0c\r"


def words_of(text: Column) -> Column:
    return F.split(F.btrim(F.lower(F.coalesce(text, F.lit(""))), F.lit(SPACE)), r"[\x20\x09-\x0D]+")


def shingle_at(words: Column, place: Column, size: int) -> Column:
    return F.xxhash64(*[F.get(words, (place + i).cast("int")) for i in range(size)])


def _with_shingles(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, h) for every shingle of the column ``words``, repeats included; the size is SHINGLE or all words."""
    rows = rows.select(*keep, "words", F.posexplode("words").alias("p", "_w"))
    n = F.size("words")
    cases = [
        F.when(n == k, F.when(F.col("p") == 0, shingle_at(F.col("words"), F.col("p"), k))) for k in range(1, SHINGLE)
    ]
    long = F.when((n >= SHINGLE) & (F.col("p") <= n - SHINGLE), shingle_at(F.col("words"), F.col("p"), SHINGLE))
    return rows.select(*keep, "p", F.coalesce(*cases, long).alias("h")).filter("h IS NOT NULL")


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """key, item_id, words, n of every item with words; items of the same words have one key, with the same id too they are one."""
    rows = benchmark.select("item_id", words_of(F.col("text")).alias("words")).withColumn("key", F.xxhash64("words"))
    rows = rows.filter("words[0] <> ''").dropDuplicates(["key", "item_id"]).select("key", "item_id", "words")
    return written(rows.withColumn("n", F.size("words")), "items")


def item_shingles(items: DataFrame) -> DataFrame:
    """key, n, offset, h, the shingle before (null at the start) and the weight of every item shingle."""
    rows = _with_shingles(items.dropDuplicates(["key"]), "key", "n")
    held = rows.groupBy("h").agg(F.countDistinct("key").alias("items"))
    rows = rows.join(held, "h").withColumn("weight", 1.0 / F.col("items"))
    before = rows.select("key", (F.col("p") + 1).alias("p"), F.col("h").alias("before"))
    return written(rows.join(before, ["key", "p"], "left"), "item_shingles")


def aligned_windows(docs: DataFrame, shingles: DataFrame) -> DataFrame:
    """doc_id, text hash, start and words of the item-sized windows of all documents that hold an item's shingle."""
    sizes = sorted(r[0] for r in shingles.select(F.least("n", F.lit(SHINGLE))).distinct().collect()) or [SHINGLE]
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), words_of(F.col("text")).alias("words"))
    rows = rows.withColumn("many", F.size("words")).select("doc_id", "th", "words", "many", F.posexplode("words").alias("p", "_w"))
    at = lambda k: F.when(F.col("p") <= F.col("many") - k, shingle_at(F.col("words"), F.col("p"), k))
    if sizes == [SHINGLE]:
        rows = rows.withColumn("h", at(SHINGLE)).withColumn("k", F.lit(SHINGLE))
    else:
        rows = rows.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), at(k).alias("h")) for k in sizes])))
        rows = rows.withColumn("h", F.col("_s.h")).withColumn("k", F.col("_s.k"))
    of_item = shingles.select(
        F.col("h").alias("ih"), F.least("n", F.lit(SHINGLE)).alias("ik"), F.col("p").alias("offset"), "n", "before"
    ).distinct()
    if of_item.count() <= BROADCAST_ROWS:
        of_item = F.broadcast(of_item)
    rows = rows.filter("h IS NOT NULL").join(of_item, (F.col("h") == F.col("ih")) & (F.col("k") == F.col("ik")))
    again = (F.col("p") > 0) & F.col("before").isNotNull() & (shingle_at(F.col("words"), F.col("p") - 1, SHINGLE) == F.col("before"))
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("offset"), F.col("many") - F.col("n")))
    rows = rows.filter(~again).withColumn("start", start)
    window = F.slice("words", F.col("start") + 1, F.col("n"))
    return rows.select("doc_id", "th", "start", window.alias("words")).withColumn("key", F.xxhash64("doc_id", "th", "start", "words"))


def simhashes(shingled: DataFrame) -> DataFrame:
    """(key, fp) by weight and by number of times: bit i is set where the shingle hashes that have it outweigh the others.

    A key's shingles are those of an item or of a window of its length, so their list is short.
    """
    rows = shingled.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("h", "weight", "times"))).alias("s"))
    vote = "aggregate(s, 0D, (v, x) -> v + IF(getbit(x.h, i) = 1, x.{of}, -x.{of}))"
    bits = "aggregate(sequence(0, 63), 0L, (f, i) -> f | IF(" + vote + " > 0D, shiftleft(1L, i), 0L))"
    both = F.array(*[F.expr(bits.format(of=of)) for of in ("weight", "times")])
    return rows.select("key", F.explode(F.array_distinct(both)).alias("fp"))


def _blocks(fp: Column) -> Column:
    value = lambda b: F.shiftrightunsigned(fp, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    return F.array(*[F.struct(F.lit(b).alias("block"), value(b).alias("value")) for b in range(BLOCKS)])


def hamming_pairs(items: DataFrame, windows: DataFrame) -> DataFrame:
    """(item, window) keys whose fingerprints differ in at most RADIUS bits; all such pairs."""
    near = F.expr(f"filter(sequence(0L, {(1 << BLOCK_BITS) - 1}L), m -> bit_count(m) <= {BLOCK_RADIUS})")
    index = items.select(F.col("key").alias("item"), F.col("fp").alias("ifp"), F.explode(_blocks(F.col("fp"))).alias("b"))
    index = index.select("item", "ifp", "b.block", F.explode(F.transform(near, lambda m: F.col("b.value").bitwiseXOR(m))).alias("value"))
    probe = windows.select(F.col("key").alias("window"), F.col("fp").alias("wfp"), F.explode(_blocks(F.col("fp"))).alias("b"))
    probe = probe.select("window", "wfp", "b.block", "b.value")
    distance = F.bit_count(F.col("ifp").bitwiseXOR(F.col("wfp")))
    close = (index["block"] == probe["block"]) & (index["value"] == probe["value"]) & (distance <= RADIUS)
    # merged: the index is many times the size that Spark estimates from the items, too much to broadcast
    return probe.join(index.hint("merge"), close).select("item", "window", distance.alias("hamming")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row for each document and item it holds: doc_id, item_id, similarity, from_word, n_words, hamming, text_hash.

    Each row is the document's window most like the item, of those with at least ``similarity`` (ties: the earliest).
    Null texts hold nothing; items without words are in no document; rows with the same doc_id and text are one.
    """
    items = benchmark_items(benchmark)
    shingles = item_shingles(items)
    windows = written(aligned_windows(docs, shingles), "windows").dropDuplicates(["key"])
    windows = written(windows, "windows")
    weights = shingles.groupBy("h").agg(F.first("weight").alias("weight"))
    of_window = _with_shingles(windows, "key").groupBy("key", "h").agg(F.count(F.lit(1)).alias("times"))
    of_window = of_window.join(weights, "h", "left").withColumn("weight", F.col("times") * F.coalesce("weight", F.lit(1.0)))
    of_window = written(of_window, "window_shingles")
    of_item = shingles.groupBy("key", "h").agg(F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("times"))
    pairs = hamming_pairs(simhashes(of_item), simhashes(of_window)).groupBy("item", "window").agg(F.min("hamming").alias("hamming"))
    sums = lambda name: [F.sum("weight").alias(f"{name}_weight"), F.sum("times").alias(f"{name}_times")]
    total = lambda rows, name: rows.groupBy(F.col("key").alias(name)).agg(*sums(name))
    common = pairs.join(of_window.select(F.col("key").alias("window"), "h", F.col("weight").alias("ww"), F.col("times").alias("wt")), "window")
    common = common.join(of_item.select(F.col("key").alias("item"), "h", F.col("weight").alias("iw"), F.col("times").alias("it")), ["item", "h"])
    both = [F.sum(F.least("ww", "iw")).alias("both_weight"), F.sum(F.least("wt", "it")).alias("both_times")]
    common = common.groupBy("item", "window", "hamming").agg(*both)
    rows = common.join(total(of_window, "window"), "window").join(total(of_item, "item"), "item")
    ratio = lambda of: F.col(f"both_{of}") / (F.col(f"window_{of}") + F.col(f"item_{of}") - F.col(f"both_{of}"))
    rows = rows.withColumn("similarity", F.round(F.greatest(ratio("weight"), ratio("times")), 12)).filter(F.col("similarity") >= similarity)
    rows = rows.join(windows.select(F.col("key").alias("window"), "doc_id", "th", "start", F.size("words").alias("n")), "window")
    rows = rows.join(items.select(F.col("key").alias("item"), "item_id"), "item")
    best = F.max(F.struct("similarity", (-F.col("start")).alias("before"), (-F.col("n")).alias("m"), "hamming"))
    rows = rows.groupBy("doc_id", "th", "item_id").agg(best.alias("b"))
    return rows.select(
        "doc_id", "item_id", "b.similarity", (-F.col("b.before")).alias("from_word"), (-F.col("b.m")).alias("n_words"),
        F.col("b.hamming").alias("hamming"), F.col("th").alias("text_hash"),
    )


def without_benchmark(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents of ``docs`` that hold no benchmark item, with the same columns."""
    found = written(contaminated(docs, benchmark), "contaminated")
    found = found.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_no"), F.col("text_hash").alias("_th")).distinct()
    here = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_no"), F.xxhash64("text").alias("_th")]
    aside, back = set_aside(docs, ("doc_id", "text"))
    return aside.select("*", *here).join(found, ["_id", "_no", "_th"], "left_anti").select(*back)
