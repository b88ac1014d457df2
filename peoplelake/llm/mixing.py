"""Mixing of sources to target weights: a multivariate-hypergeometric splitting tree over output shards.

The words of a source, its documents in the order of a keyed hash, form blocks of ``block_words`` words (the last one
may be shorter). A source gives whole passes over its blocks and then the first blocks of a keyed permutation, the
last of them cut to the word. The tree halves the shards again and again; each node draws how many of its blocks of
every source go left, without replacement, so that all quotas are met exactly. Blocks then go to shards by their place
in the permutation and are ordered inside a shard by another keyed hash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from peoplelake.llm.common import numbered, running_sums, set_aside, written
from peoplelake.llm.words import WORD

SOURCE = ["no_source", "source_name"]


@dataclass(frozen=True)
class MixSettings:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)
    share: float = 1.5
    most: float = 2.0
    block_words: int = 1024
    shards: int = 16
    seed: int = 20240


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sized_documents(docs: DataFrame, settings: MixSettings) -> DataFrame:
    """doc_id, source key, number of words and order hash of every document; one written row each, without the text."""
    return written(
        docs.select(
            F.col("doc_id"),
            F.col("source").isNull().alias("no_source"),
            F.coalesce("source", F.lit("")).alias("source_name"),
            word_count(F.col("text")).alias("size"),
            order_hash(settings).alias("h"),
        ),
        "sized",
    )


def order_hash(settings: MixSettings) -> Column:
    return F.xxhash64(F.lit(settings.seed), F.col("doc_id"), F.xxhash64("text"))


def source_targets(sized: DataFrame, settings: MixSettings) -> DataFrame:
    """source_size, target and whole word quota of every source.

    Weights repeat over the sources by code point, null last. Whatever exceeds ``most`` times a source's size is
    shared among the others by weight until no target is above; each round is one aggregate of two numbers.
    """
    totals = sized.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    rows = numbered(totals, SOURCE, "place").withColumn(
        "weight", F.get(weights, (F.col("place") % len(settings.weights)).cast("int"))
    )
    rows = written(rows.withColumn("ceiling", F.col("source_size") * F.lit(settings.most)), "sources")
    everything = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * settings.share
    level, before = 0.0, None
    while level != before:
        before = level
        open_ = F.col("ceiling") > F.col("weight") * F.lit(level)
        full, weight = rows.agg(
            F.coalesce(F.sum(F.when(~open_, F.col("ceiling"))), F.lit(0.0)), F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0.0))
        ).first()
        level = max(level, (everything - full) / weight) if weight else level
    target = F.least("ceiling", F.col("weight") * F.lit(level))
    return rows.select(*SOURCE, "place", "source_size", target.alias("target"), F.round(target).cast("long").alias("quota"))


def _let(value: str, name: str, body: str) -> str:
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _hypergeometric(total: str, good: str, drawn: str, uniform: str) -> str:
    """SQL of one exact draw by inversion: good ones among ``drawn`` of ``total``.

    Terms follow from each other by a ratio. They start 12 deviations and 20 steps below the mean and end as far above;
    what lies beyond weighs less than the last bit of a double.
    """
    mean = f"(cast({drawn} as double) * {good} / greatest({total}, 1))"
    spread = f"(12 * sqrt({mean} * (1 - cast({good} as double) / greatest({total}, 1)) * ({total} - {drawn}) / greatest({total} - 1, 1)) + 20)"
    ends = (
        f"named_struct('lo', greatest(0, {drawn} + {good} - {total}, cast(floor({mean} - {spread}) as bigint)), "
        f"'hi', least({drawn}, {good}, cast(ceil({mean} + {spread}) as bigint)))"
    )
    ratio = f"(cast({good} - x as double) * ({drawn} - x) / ((x + 1) * cast({total} - {good} - {drawn} + x + 1 as double)))"
    steps = "sequence(e.lo, e.hi)"
    mass = f"aggregate({steps}, named_struct('w', 1D, 'sum', 0D), (s, x) -> named_struct('w', s.w * {ratio}, 'sum', s.sum + s.w)).sum"
    pick = (
        f"aggregate({steps}, named_struct('w', 1D, 'sum', 0D, 'at', e.lo), (s, x) -> named_struct('w', s.w * {ratio}, "
        f"'sum', s.sum + s.w, 'at', if(s.sum <= {uniform} * m, x, s.at))).at"
    )
    return _let(ends, "e", _let(mass, "m", pick))


def split_quotas(quotas: DataFrame, settings: MixSettings) -> DataFrame:
    """(place, shard, cut): blocks of each source that go to the shards up to this one. ``quotas`` has place and blocks.

    A tree node is one row with a count for each source, in memory proportional to the number of sources.
    """
    root = quotas.agg(F.sort_array(F.collect_list(F.struct("place", "blocks"))).alias("all")).select(
        F.lit(0).alias("low"), F.lit(settings.shards).alias("width"), F.expr("transform(all, v -> v.blocks)").alias("counts"),
        F.expr("transform(all, v -> v.place)").alias("places"),
    )
    uniform = f"(shiftrightunsigned(xxhash64({settings.seed}, low, width, size(acc.taken)), 11) * {2.0 ** -53}D)"
    step = _let(_hypergeometric("acc.rest", "c", "acc.draw", uniform), "x", "named_struct('rest', acc.rest - c, 'draw', acc.draw - x, 'taken', concat(acc.taken, array(x)))")
    nodes, width = root, settings.shards
    while width > 1:
        parts = nodes.withColumn("total", F.expr("aggregate(counts, 0L, (s, c) -> s + c)")).withColumn("half", F.expr("cast(width div 2 as int)"))
        parts = parts.withColumn("share", F.expr("cast(total * half div width as bigint)"))
        parts = parts.withColumn(
            "left_", F.when(F.col("width") > 1, F.expr(f"aggregate(counts, named_struct('rest', total, 'draw', share, 'taken', cast(array() as array<bigint>)), (acc, c) -> {step}).taken"))
        )
        parts = written(parts, "tree")
        left = parts.filter("width > 1").select("low", F.col("half").alias("width"), F.col("left_").alias("counts"), "places")
        right = parts.select(
            F.expr("if(width > 1, low + half, low)").alias("low"), F.expr("if(width > 1, width - half, width)").alias("width"),
            F.expr("if(width > 1, zip_with(counts, left_, (c, x) -> c - x), counts)").alias("counts"), "places",
        )
        nodes, width = left.unionByName(right), (width + 1) // 2
    cells = nodes.select(F.col("low").alias("shard"), F.expr("explode(arrays_zip(places, counts)) AS cell")).select("shard", "cell.*")
    upto = Window.partitionBy("places").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cells.select(F.col("places").alias("place"), "shard", F.sum("counts").over(upto).alias("cut"))


@dataclass(frozen=True)
class Mix:
    """documents: every document with its place in its source; draws: one row for each drawn block, pass and shard."""

    documents: DataFrame
    draws: DataFrame
    settings: MixSettings


def mix_sources(docs: DataFrame, settings: MixSettings = MixSettings()) -> Mix:
    """Plan the mix of ``docs`` (doc_id, text, source; further columns are ignored).

    Null texts and texts without words have size 0 and are never taken. Null sources are one source, the last. Repeated
    rows are documents of their own. An empty table gives an empty mix. A source without words gets target 0.
    """
    sized = sized_documents(docs, settings)
    targets = source_targets(sized, settings)
    passes = F.when(F.col("source_size") > 0, F.expr("quota div source_size")).otherwise(F.lit(0))
    targets = written(
        targets.withColumn("passes", passes).withColumn("extra", F.col("quota") - F.col("passes") * F.col("source_size")), "targets"
    )
    placed = written(running_sums(sized, SOURCE, "h", {"start": F.col("size")}, ("doc_id", "size"), per_group=targets), "placed")

    b = settings.block_words
    own = placed.filter("size > 0").withColumn("first", F.expr(f"(start + {b - 1}) div {b}")).withColumn("last", F.expr(f"(start + size - 1) div {b}"))
    blocks = own.filter("first <= last").select(
        *SOURCE, "place", "source_size", "passes", "extra", F.explode(F.sequence("first", "last")).alias("block")
    )
    blocks = blocks.withColumn("words", F.least(F.lit(b), F.col("source_size") - F.col("block") * b).cast("long"))
    blocks = blocks.withColumn("bh", F.xxhash64(F.lit(settings.seed + 1), *SOURCE, "block"))
    blocks = running_sums(blocks, SOURCE, "bh", {"at": F.col("words"), "rank": F.lit(1).cast("long")}, ("block",))
    more = F.greatest(F.lit(0), F.least(F.col("words"), F.col("extra") - F.col("at")))
    blocks = written(blocks.withColumn("more", more), "blocks")

    per_source = blocks.groupBy("place").agg(
        F.count(F.lit(1)).alias("source_blocks"), F.max("passes").alias("passes"), F.count(F.when(F.col("more") > 0, 1)).alias("some")
    )
    per_source = written(per_source.withColumn("blocks", F.col("passes") * F.col("source_blocks") + F.col("some")), "quotas")
    cuts = split_quotas(per_source, settings).groupBy("place").agg(F.sort_array(F.collect_list("cut")).alias("cuts"))
    drawn = blocks.join(per_source.select("place", "source_blocks").join(cuts, "place"), "place")
    whole = drawn.filter("passes > 0").withColumn("pass", F.explode(F.expr("sequence(0L, passes - 1)"))).withColumn("taken", F.col("words"))
    part = drawn.filter("more > 0").withColumn("pass", F.col("passes")).withColumn("taken", F.col("more"))
    draws = whole.unionByName(part).withColumn("ticket", F.col("pass") * F.col("source_blocks") + F.col("rank"))
    draws = draws.withColumn("shard", F.expr("size(filter(cuts, c -> c <= ticket))"))
    order = F.xxhash64(F.lit(settings.seed + 2), "place", "block", "pass")
    return Mix(placed, draws.select(*SOURCE, "block", "pass", "taken", "shard", order.alias("order")), settings)


def document_spans(mix: Mix) -> DataFrame:
    """Word ranges of documents in the mix: source key, start (of the document), pass, shard, order, from_word, n_words."""
    b = mix.settings.block_words
    docs = mix.documents.filter("size > 0").select(
        *SOURCE, "doc_id", "h", "start", "size", F.explode(F.expr(f"sequence(start div {b}, (start + size - 1) div {b})")).alias("block")
    )
    rows = docs.join(mix.draws, [*SOURCE, "block"])
    low = F.greatest(F.col("start"), F.col("block") * b)
    high = F.least(F.col("start") + F.col("size"), F.col("block") * b + F.col("taken"))
    return rows.withColumn("from_word", low - F.col("start")).withColumn("n_words", high - low).filter("n_words > 0")


def mixed_amounts(mix: Mix) -> DataFrame:
    """Every document with its source's size and target, the words that the mix takes of it, and the shards it goes to."""
    taken = document_spans(mix).groupBy(*SOURCE, "start").agg(
        F.sum("n_words").alias("taken"), F.countDistinct("shard").cast("int").alias("n_shards")
    )
    docs = mix.documents.withColumn("_start", F.when(F.col("size") > 0, F.col("start")))
    rows = docs.join(taken.withColumnRenamed("start", "_start"), [*SOURCE, "_start"], "left")
    return rows.select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("n_shards", F.lit(0)).alias("n_shards"),
    )


def mixed_documents(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a whole text for each whole pass, else the drawn pieces of the text.

    A piece keeps its words and the white space between them. A column n_chars is set anew. Shards and their local
    order set the partitions and the order of the rows.
    """
    mix = mix_sources(docs, settings)
    spans = document_spans(mix).groupBy("doc_id", "h", "start", "pass", "size").agg(
        F.sum("n_words").alias("n"), F.min("shard").alias("shard"), F.min("order").alias("order"),
        F.sort_array(F.collect_list(F.struct("from_word", "n_words"))).alias("ranges"),
    )
    spans = spans.groupBy("doc_id", "h", "start").agg(F.collect_list(F.struct("pass", "size", "n", "shard", "order", "ranges")).alias("copies"))
    same = Window.partitionBy("doc_id", "h")
    spans = spans.withColumn("_nth", F.row_number().over(same.orderBy("start"))).drop("start")
    aside, back = set_aside(docs, ("doc_id", "text", "source"))
    rows = aside.withColumn("h", order_hash(settings)).filter(word_count(F.col("text")) > 0)
    rows = rows.withColumn("_nth", F.row_number().over(same.orderBy(F.col("source"))))
    key = (rows["h"] == spans["h"]) & rows["doc_id"].eqNullSafe(spans["doc_id"]) & (rows["_nth"] == spans["_nth"])
    rows = rows.join(spans, key).select(*[rows[c] for c in aside.columns], F.explode("copies").alias("_copy"))
    gap = r"(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])"
    lead = r"^[\\x20\\x09-\\x0D]+"
    piece = f"array_join(transform(_copy.ranges, r -> array_join(slice(split(regexp_replace(text, '{lead}', ''), '{gap}'), int(r.from_word + 1), int(r.n_words)), '')), '')"
    rows = rows.withColumn("text", F.expr(f"if(_copy.n = _copy.size, text, {piece})"))
    if "n_chars" in docs.columns:
        rows = rows.withColumn(aside.columns[docs.columns.index("n_chars")], F.length("text").cast(docs.schema["n_chars"].dataType))
    rows = rows.repartitionByRange(F.col("_copy.shard"), F.col("_copy.order")).sortWithinPartitions("_copy.shard", "_copy.order")
    return rows.select(*back)
