"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in the order of a hash of their ids, form one stream
of words. Sources whose targets lie between the same powers of four form a
band; its length of a slot is the lower power divided by ``SLOTS_PER_SOURCE``
(one word at least), so a source has some thousands of slots, whatever its size
and that of the others, or one for each word. A band's schedule is a row of
slots: golden-ratio points mapped through its sources' cumulative targets give
each slot its source. A source's stream is cut into equal blocks of about that
length, and its slot number k (counted from 0) takes block k, round again when
the blocks run out, at most ``MAX_EPOCHS`` times. A document's words are those
of the blocks taken; slot i of n stands at (i + 1/2) / n of the mix, and
``first_at`` is the first such place of a document. So a source meets its target
up to the few slots by which the points are uneven, in the whole mix and in any
part of it from the start.

Nothing runs over a whole source, or over all sources, in one task: words are
summed within (source, hash prefix), slots ranked within (source, chunk),
targets within blocks of sources, and short tables of totals carry the offsets.

Defined cases: null text has size 0 and is never taken; a null source is a
source, after all others; repeated rows are separate documents; rows without an
id are ordered by their text; without rows or words the result is empty or
takes nothing. Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import WORD
from strata.operators.keys import dense_key
from strata.sinks.writer import stage

MAX_EPOCHS = 3
# A source has this many slots at least (and up to four times as many), or one for each word of its target.
SLOTS_PER_SOURCE = 4096
# Sources that a broadcast of the per-source table may hold (about 60 bytes each).
MAX_BROADCAST_SOURCES = 20_000
_CHUNK, _ROWS_PER_PREFIX = 4096, 2048
_PHI32 = 2654435769  # 2^32 / golden ratio, odd: fixed value


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and the hash that orders a source's documents."""
    name = F.when(F.col("doc_id").isNull(), F.coalesce("text", F.lit(""))).otherwise(F.col("doc_id").cast("string"))
    return docs.select("doc_id", "source",
                       F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       F.md5(name.cast("binary")).alias("__md5"))


def _ranked(per_source: DataFrame) -> DataFrame:
    """``rank``: 1, 2, ... by code point, the null source last."""
    named = per_source.where(F.col("source").isNotNull())
    null = per_source.where(F.col("source").isNull()).withColumn("rank", F.lit(named.count() + 1).cast("int"))
    return dense_key(named, "source", "rank", first=False, stage_input=False).unionByName(null)


def targets(sized: DataFrame) -> DataFrame:
    """Per source: rank, source_size, weight and target (water filling under the cap, one row a source)."""
    t = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    t = stage(_ranked(t).withColumn("weight", (F.col("rank") - 1) % 3 + 1), "mix-ranks")
    cap = (MAX_EPOCHS * F.col("source_size")).cast("double")
    total, level = float(t.agg(F.sum("source_size").alias("n")).first()["n"] or 0), 0.0
    # the level rises as sources reach their caps; a few sums over the table settle it
    while True:
        full = cap / F.col("weight") < F.lit(level)
        r = t.agg(F.sum(F.when(full, cap)).alias("held"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        new = (total - (r["held"] or 0.0)) / r["open"] if r["open"] else level
        if not r["open"] or new <= level:
            break
        level = new
    return t.select("source", "rank", "source_size", "weight", F.least(cap, F.lit(level) * F.col("weight")).alias("target"))


def cut(per_source: DataFrame, slots: int = SLOTS_PER_SOURCE) -> DataFrame:
    """Adds each source's band, its length of a slot, and the source's blocks: the first ``longer`` of ``blocks`` hold ``length`` + 1 words, the others ``length``."""
    bits = F.length(F.bin(F.greatest(F.floor("target"), F.lit(1)).cast("long"))) - 1
    return (per_source.withColumn("band", F.floor(bits / 2).cast("int"))
            .withColumn("slot_words", F.greatest(F.expr(f"shiftleft(1L, 2 * band) div {max(slots, SLOTS_PER_SOURCE)}L"), F.lit(1)))
            .withColumn("blocks", F.greatest(F.ceil(F.col("source_size") / F.col("slot_words")), F.lit(1)))
            .withColumn("length", F.expr("source_size div blocks")).withColumn("longer", F.expr("source_size % blocks"))
            .withColumn("share", F.floor(F.col("target") * 1000)))


def schedule(cuts: DataFrame, n_sources: int, step: int = _PHI32) -> DataFrame:
    """(rank of the source, its blocks, band, slot, k, at): slot number ``slot`` of its band is the ``k``-th (from 0) of its source and stands at ``at`` of the mix."""
    spans = cuts.where("share > 0").withColumn("__of", F.floor(F.col("rank") / _CHUNK))
    running = F.sum("share").over(Window.partitionBy("band", "__of").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    totals = spans.groupBy("band", "__of").agg(F.sum("share").alias("__sum"), F.max("slot_words").alias("__words"))
    per_band = Window.partitionBy("band")
    totals = totals.select("band", "__of", (F.sum("__sum").over(per_band.orderBy("__of")) - F.col("__sum")).alias("__before"),
                           F.sum("__sum").over(per_band).alias("__total"), "__words")
    n_slots = F.expr("(__total + 1000 * __words - 1) div (1000 * __words)")
    totals = totals.withColumn("__slots", n_slots)
    point = lambda c: F.floor(c / F.col("__total") * F.lit(float(1 << 32)))
    spans = (spans.withColumn("__upto", running).join(totals, ["band", "__of"])
             .select("rank", "blocks", "band", point(F.col("__before") + F.col("__upto") - F.col("share")).alias("__lo"), point(F.col("__before") + F.col("__upto")).alias("__hi")))
    # about a span a cell, so that a slot meets few sources
    cell = 32 - min(31, max(12, math.ceil(math.log2(n_sources + 1))))
    cells = spans.where("__lo < __hi").withColumn("__cell", F.explode(F.sequence(F.shiftright("__lo", cell), F.shiftright(F.col("__hi") - 1, cell))))
    chunks = (totals.groupBy("band").agg(F.max("__slots").alias("__slots"))
              .withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(__slots - 1) div {_CHUNK}")))))
    drawn = (chunks.repartition("band", "__chunk")
             .withColumn("slot", F.explode(F.sequence(F.col("__chunk") * _CHUNK, F.least(F.col("__chunk") * _CHUNK + _CHUNK, F.col("__slots")) - 1)))
             .withColumn("__point", F.col("slot") % (1 << 32) * step % (1 << 32)).withColumn("__cell", F.shiftright("__point", cell))
             .join(cells, ["band", "__cell"]).where("__lo <= __point and __point < __hi")
             .select("rank", "blocks", "band", "slot", "__chunk", ((F.col("slot") + 0.5) / F.col("__slots")).alias("at")))
    drawn = stage(drawn, "mix-drawn")  # read twice below
    offsets = (drawn.groupBy("rank", "__chunk").count()
               .select("rank", "__chunk", (F.sum("count").over(Window.partitionBy("rank").orderBy("__chunk")) - F.col("count")).alias("__offset")))
    within = F.row_number().over(Window.partitionBy("rank", "__chunk").orderBy("slot"))
    return (drawn.withColumn("__n", within).join(offsets, ["rank", "__chunk"])
            .select("rank", "blocks", "band", "slot", (F.col("__offset") + F.col("__n") - 1).alias("k"), "at"))


def draws(cuts: DataFrame, n_sources: int, step: int = _PHI32) -> DataFrame:
    """(rank, band, slot, at, block): the block that each slot takes; slots of a source that has been taken ``MAX_EPOCHS`` times take none."""
    return (schedule(cuts, n_sources, step).where(F.col("k") < MAX_EPOCHS * F.col("blocks"))
            .select("rank", "band", "slot", "at", (F.col("k") % F.col("blocks")).alias("block")))


def _block_of(word: Column) -> Column:
    long_words = F.col("longer") * (F.col("length") + 1)
    return (F.when(word < long_words, F.floor(word / (F.col("length") + 1)))
            .otherwise(F.col("longer") + F.floor((word - long_words) / F.greatest(F.col("length"), F.lit(1)))))


def _start_of(block: Column) -> Column:
    return block * F.col("length") + F.least(block, F.col("longer"))


def mix(docs: DataFrame, slots: int = SLOTS_PER_SOURCE, step: int = _PHI32) -> DataFrame:
    """doc_id, source, size, source_size, target (the source's), taken (words the mix takes) and first_at (null if none) per document."""
    sized = stage(sizes(docs), "mix-sizes")
    cuts = stage(cut(targets(sized), slots), "mix-cuts")
    n_sources, rows = cuts.count(), sized.count()
    digits = max(1, math.ceil(math.log(max(rows, 1) / _ROWS_PER_PREFIX + 1, 16)))

    side = F.broadcast(cuts) if n_sources <= MAX_BROADCAST_SOURCES else cuts
    placed = sized.withColumnRenamed("source", "__source").join(
        side, F.col("__source").eqNullSafe(F.col("source"))).drop("__source", "weight", "share", "band", "slot_words", "blocks")
    placed = placed.withColumn("__prefix", F.substring("__md5", 1, digits))
    totals = placed.groupBy("rank", "__prefix").agg(F.sum("size").alias("__sum"))
    totals = totals.select("rank", "__prefix", (F.sum("__sum").over(Window.partitionBy("rank").orderBy("__prefix")) - F.col("__sum")).alias("__offset"))
    run = Window.partitionBy("rank", "__prefix").orderBy("__md5", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (placed.withColumn("__end", F.sum("size").over(run)).join(totals, ["rank", "__prefix"])
              .withColumn("__end", F.col("__offset") + F.col("__end")).withColumn("__start", F.col("__end") - F.col("size")))

    uses = draws(cuts, n_sources, step).groupBy("rank", F.col("block").alias("__block")).agg(F.count(F.lit(1)).alias("__uses"), F.min("at").alias("__at"))
    # a plan of its own: Spark plans all that is left anew, and describes it, whenever one of a query's exchanges ends
    uses = stage(uses, "mix-uses")
    keys = ["doc_id", "source", "size", "source_size", "target"]
    spread = placed.withColumn("__block", F.explode(F.when(F.col("size") > 0, F.sequence(
        _block_of(F.col("__start")), _block_of(F.col("__end") - 1))).otherwise(F.array(F.lit(-1).cast("long")))))
    overlap = F.least("__end", _start_of(F.col("__block") + 1)) - F.greatest("__start", _start_of(F.col("__block")))
    return (spread.join(uses, ["rank", "__block"], "left")
            .groupBy(*keys, "rank", "__start", "__md5")
            .agg(F.sum(F.coalesce(F.when(F.col("size") > 0, overlap * F.col("__uses")), F.lit(0))).alias("taken"),
                 F.min("__at").alias("first_at"), F.count(F.lit(1)).alias("__rows"))
            # repeated rows without words share one start; each is a row of its own again
            .withColumn("__each", F.explode(F.when(F.col("size") > 0, F.array(F.lit(1).cast("long"))).otherwise(F.sequence(F.lit(1).cast("long"), F.col("__rows")))))
            .select(*keys, F.col("taken").cast("long").alias("taken"), "first_at"))
