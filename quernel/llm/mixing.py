"""Mixing of sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order that depends on
the seed and the document only. A document's virtual finish time is the number
of its source's words up to and including it, over the source's target. All
queues are merged by finish time and the merged order is cut at the total
budget. A source with a target above its size is passed again, up to
``most`` times.

No step gathers a source: both running sums (over a source, over the merged
order) are taken in blocks of a shuffled, hence even, order, and only the
blocks' sums meet, one row each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quernel.llm.common import n_words, text_hash, unused, whole
from quernel.session import materialize

#: Fixed values of the contract: weights of the sources in order, and the most copies.
WEIGHTS = (1, 2, 3)
MOST = 3

#: Rows of a block, over which one task takes a running sum.
BLOCK_ROWS = 50_000


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, rank, target) from (source, source_size).

    Sources in code point order, null last, have the weights in turn. The total
    of all sizes is shared by weight; no target exceeds ``most`` times its
    source, and what is over is shared again by weight until none is above.
    With sources in ascending order of capacity over weight the capped ones come
    first, so one running sum finds them all. Sums are exact decimals.
    """
    one = F.lit(0)
    by_name = Window.partitionBy(one).orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1) % len(weights)
    whole_number = lambda c: F.col(c).cast("decimal(38,0)")
    ranked = sizes.withColumn("weight", F.get(F.array(*[F.lit(w) for w in weights]), number)).withColumn(
        "cap", F.lit(most) * F.col("source_size")
    )
    order = Window.partitionBy(one).orderBy(
        (F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()
    )
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(one)
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn(
            "rest_weight",
            F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)),
        )
        .withColumn(
            "capped", whole_number("cap") * whole_number("rest_weight") <= whole_number("rest") * whole_number("weight")
        )
    )
    level = filled.withColumn("place", F.row_number().over(order))
    free = F.min(F.when(~F.col("capped"), F.struct("place", "rest", "rest_weight"))).over(everything)
    share = F.col("free.rest") * F.col("weight") / F.col("free.rest_weight")
    target = F.when(
        F.col("free").isNull() | (F.col("place") < F.col("free.place")), F.col("cap").cast("double")
    ).otherwise(share.cast("double"))
    return level.withColumn("free", free).select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = 7, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(doc_id, source, text_hash, size, source_size, target, copies, taken, finish), a row per document.

    A document goes in whole, ``copies`` times (0 to ``most``). ``finish`` is
    its first virtual finish time. Null texts have size 0 and null sources are
    one source, the last. Rows with the same id and text are interchangeable; all
    are kept. An empty table gives an empty table.
    """
    slim = materialize(
        docs.select(
            "doc_id",
            "source",
            # 63 bits, never negative: leading bits and the whole number have one order.
            F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id"), 1).alias("draw"),
            text_hash().alias("text_hash"),
            n_words(whole()).alias("size"),
        ),
        "mix-sizes",
    )
    rows = slim.count()
    # A power of two, so that a block is a prefix of the drawn number's bits.
    bits = max(0, min(20, (rows // block_rows).bit_length()))
    block = F.shiftright("draw", 63 - bits)
    slim = slim.withColumn("block", block.cast("int"))

    blocks = slim.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    sources = source_targets(blocks.groupBy("source").agg(F.sum("block_size").alias("source_size")), weights, most)
    ahead = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("block_size").over(ahead), F.lit(0)))
    starts = (
        starts.alias("b")
        .join(sources.alias("s"), F.col("b.source").eqNullSafe(F.col("s.source")))
        .select("b.source", "b.block", "b.start", "s.source_size", "s.target")
    )
    starts = materialize(starts, "mix-blocks")
    inside = Window.partitionBy("source", "block").orderBy("draw", "doc_id", "text_hash", "size")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = (
        slim.withColumn("inner", F.sum("size").over(inside))
        .alias("q")
        .join(
            starts.alias("t"),
            F.col("q.source").eqNullSafe(F.col("t.source")) & (F.col("q.block") == F.col("t.block")),
        )
        .select(
            "q.doc_id", "q.source", "q.draw", "q.text_hash", "q.size", "t.source_size", "t.target",
            (F.col("t.start") + F.col("q.inner")).alias("queue"),
        )
    )
    queued = materialize(queued, "mix-queue")
    times = [_finish(e) for e in range(most)]
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = _cut(queued, times, most, 1 << bits, kind)
    if cut is None:
        copies = F.lit(0)
    else:
        copies = sum(F.when(_key(e, times, kind) <= cut, 1).otherwise(0) for e in range(most))
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("bigint")
    return queued.select(
        "doc_id", "source", "text_hash", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"), times[0].alias("finish"),
    )


def _finish(epoch: int):
    passed = F.lit(epoch) * F.col("source_size") + F.col("queue")
    return F.try_divide(passed.cast("double"), F.col("target"))


def _key(epoch: int, times, kind: str):
    """The merged order: finish time, then the document, so that ties are settled."""
    return F.struct(
        times[epoch].alias("finish"), F.col("draw"), F.col("doc_id").isNull().alias("no_id"),
        F.coalesce("doc_id", F.lit(0).cast(kind)).alias("id"), F.col("text_hash"),
        F.lit(epoch).alias("epoch"),
    )


def _cut(queued: DataFrame, times, most: int, blocks: int, kind: str):
    """Key of the last place in the merged order that the budget still holds, as a literal.

    By finish time the words come in at an even rate, so ranges of finish time
    are even blocks. Their sums tell which block crosses the budget; the
    running sum is taken there only. One row reaches the driver.
    """
    ranges = 64 * blocks
    passes = F.explode(F.array(*[_key(e, times, kind) for e in range(most)]))
    entries = queued.filter(F.col("size") > 0).select("size", passes.alias("key"))
    entries = entries.withColumn("range", F.floor(F.least(F.col("key.finish"), F.lit(2.0)) * ranges).cast("int"))
    sums = entries.groupBy("range").agg(F.sum("size").alias("words"), F.max("key").alias("last"))
    everything = Window.partitionBy(F.lit(0))
    running = everything.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    budget = queued.select("source", "source_size").distinct().agg(F.sum("source_size")).first()[0]
    crossed = (
        sums.withColumn("upto", F.sum("words").over(running))
        .filter(F.col("upto") >= budget)
        .orderBy("range")
        .first()
    )
    if crossed is None:
        return None
    here = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = (
        entries.filter(F.col("range") == crossed.range)
        .withColumn("upto", F.sum("size").over(here) + F.lit(crossed.upto - crossed.words))
        .filter(F.col("upto") <= budget)
        .agg(F.max("key").alias("key"))
        .first()
    )
    key = found.key
    if key is None:  # not even the first place of this range fits; the range before ends the mix
        key = sums.filter(F.col("range") < crossed.range).agg(F.max("last").alias("key")).first().key
    if key is None:
        return None
    return F.struct(
        F.lit(key.finish).alias("finish"), F.lit(key.draw).cast("bigint").alias("draw"),
        F.lit(key.no_id).alias("no_id"), F.lit(key.id).cast(kind).alias("id"),
        F.lit(key.text_hash).cast("bigint").alias("text_hash"), F.lit(key.epoch).alias("epoch"),
    )


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """Rows of ``docs``, each as often as the mix takes it, with the columns of ``docs``, whatever their names.

    Rows with the same id, text and source share their copies: as many each as can be, one more
    for the first ones by all columns (those of a map type aside).
    """
    key = ["doc_id", "text_hash", "source"]
    taken = mix(docs, **settings).groupBy(*key).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    names = unused(docs, "id", "hash", "from", "copies", "rows", "place", "copy")
    id_, hash_, source, copies, rows, place, copy = names
    taken = materialize(taken.toDF(id_, hash_, source, copies, rows), "mix-copies")
    same = docs["doc_id"].eqNullSafe(F.col(id_)) & (text_hash(docs["text"]) == F.col(hash_))
    joined = docs.join(taken, same & docs["source"].eqNullSafe(F.col(source)))
    times = F.col(copies)
    if not taken.filter(F.col(rows) > 1).isEmpty():
        order = [docs[f"`{c}`"] for c, t in docs.dtypes if "map<" not in t and t != "variant"]
        joined = joined.withColumn(place, F.row_number().over(Window.partitionBy(id_, hash_, source).orderBy(*order)))
        extra = (F.col(place) <= F.col(copies) % F.col(rows)).cast("bigint")
        times = F.floor(F.col(copies) / F.col(rows)) + extra
    kept = joined.withColumn(copies, times.cast("bigint")).filter(F.col(copies) > 0)
    often = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))
    return kept.select(*[docs[f"`{c}`"] for c in docs.columns], often.alias(copy)).drop(copy)
