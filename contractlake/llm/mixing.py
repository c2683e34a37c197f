"""Mixing sources to target weights by a low-discrepancy schedule.

Sources, in code-point order with null last, get the weights 3, 1, 2, repeating, and share out half as many words again as there
are. A source's target stops at twice its own size; what it can't take is shared anew by weight until no target is above.

The documents of a source are shuffled by a hash and laid end to end, twice, and this stream is cut into blocks of
``BLOCK_WORDS`` words; the mix takes each source's first blocks, as many as hold its target (the last one in part). Which block
comes when is the schedule: the van der Corput points of a power of two are mapped through the sources' cumulative shares, so
each prefix of the schedule holds every source in its share, up to a few blocks. The map is inverted: a source owns an interval
of points, point j/N is drawn at step bitreverse(j), so its steps come out of its interval alone, with no range join. A
source's steps are ranked; the step of rank k carries the source's block k (ranks beyond its last block are left out).

All of it is DataFrame functions. Ranks and offsets go by (source, chunk) with the chunks' counts added up, so a source that
holds a third of all rows is spread over all tasks; documents, blocks and steps meet in one join on (source, block). One row a
source is the only table that a window reads whole or that is broadcast, the latter if its size allows.

Contract: a word is a run of other than ASCII white space; null and empty texts have none, are in no block and take 0. Rows that
repeat an id are told apart by copy number; equal (id, source, size) rows are interchangeable. Orders hang on hashes of id, size
and copy number, so reruns and other layouts of the same rows agree. No words at all give targets of 0; an empty table gives none.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contractlake.llm.stage import broadcast_if_small, saved

WEIGHTS = (3, 1, 2)
#: The mix holds so many words, in hundredths of all words, and no source (and so no document) more often than that.
PERCENT, MOST_TIMES = 150, 2
BLOCK_WORDS = 1024
#: Steps that one numbering chunk holds, and rows that one part of a shuffled source's share holds, about.
CHUNK, PART_ROWS = 1 << 16, 1 << 13


@dataclass
class Mix:
    """``sources``: (number, source, source_size, target, words, blocks). ``documents``: one row per input row.
    ``pieces``: (step, number, block, id, copy, first_word, n_words), the mix in the order of ``step``."""
    sources: DataFrame
    documents: DataFrame
    pieces: DataFrame


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Rows (source, source_size) -> also number, weight and target. A table of one row a source.

    Sorted by the level at which they fill up, sources before some point are full; the first that the rest's even share doesn't
    fill gives the level of all that follow. Sums and products are exact decimals, divided once.
    """
    big = "decimal(38,0)"
    ordinal = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).cast("long")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("number") % len(WEIGHTS) + 1).cast("int"))
    whole = 1
    for w in WEIGHTS:
        whole *= w
    full = (F.col("source_size") * MOST_TIMES).cast(big)
    rows = sizes.withColumn("number", ordinal).withColumn("weight", weight).withColumn("full", full)
    order = Window.orderBy((F.col("full") * (F.lit(whole) / F.col("weight")).cast("int")).cast(big), "number")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = (rows.withColumn("left", F.sum("weight").over(after).cast(big))
            # in hundredths of words
            .withColumn("room", (F.sum("source_size").over(everything).cast(big) * PERCENT - F.coalesce(F.sum("full").over(before), F.lit(0)).cast(big) * 100).cast(big)))
    fills = (F.col("full") * 100 * F.col("left")).cast(big) <= (F.col("room") * F.col("weight")).cast(big)
    rows = rows.withColumn("fills", fills).withColumn("at", F.row_number().over(order))
    level = F.min(F.when(~F.col("fills"), F.struct("at", "room", "left"))).over(everything)
    share = (F.col("level.room") * F.col("weight")).cast("double") / (F.col("level.left") * 100).cast("double")
    return (rows.withColumn("level", level)
            .withColumn("target", F.when(F.col("fills"), F.col("full").cast("double")).otherwise(share))
            .select("number", "source", "source_size", "weight", "target"))


def schedule(sources: DataFrame) -> DataFrame:
    """Rows (number, block, step): the step of every block that the mix takes, from rows (number, blocks)."""
    wanted = sources.where("blocks > 0").select("number", "blocks")
    total = wanted.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (total - 1).bit_length())
    points = 1 << bits
    upto = F.sum("blocks").over(Window.orderBy("number")).cast("decimal(38,0)")
    bound = lambda edge: F.ceil(edge * points / F.lit(max(total, 1)).cast("decimal(38,0)")).cast("long")
    owned = wanted.withColumn("upto", upto).select("number", "blocks", bound(F.col("upto") - F.col("blocks")).alias("lo"), bound(F.col("upto")).alias("hi"))
    some = owned.where("lo < hi").select("number", "blocks", "hi", F.explode(F.sequence("lo", F.col("hi") - 1, F.lit(CHUNK).cast("long"))).alias("lo")).repartition("number", "lo")
    step = F.conv(F.reverse(F.lpad(F.bin("point"), bits, "0")), 2, 10).cast("long")
    drawn = some.select("number", "blocks", F.explode(F.sequence("lo", F.least(F.col("lo") + CHUNK, F.col("hi")) - 1)).alias("point")).select("number", "blocks", step.alias("step"))
    drawn = saved(drawn.withColumn("chunk", F.floor(F.col("step") / CHUNK)), "mix-steps")
    before = Window.partitionBy("number").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = drawn.groupBy("number", "chunk").count().withColumn("ahead", F.coalesce(F.sum("count").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("number", "chunk").orderBy("step")) - 1 + F.col("ahead")
    return (drawn.join(counts.drop("count"), ["number", "chunk"]).withColumn("block", rank.cast("long"))
            .where("block < blocks").select("number", "block", "step"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """The mix of ``docs``. Other columns are not read."""
    sized = saved(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"))
                  .groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    rounded = F.least(F.floor(F.col("target") + 0.5).cast("long"), F.col("source_size") * MOST_TIMES)
    sources = saved(targets(sizes).withColumn("words", rounded).withColumn("blocks", F.ceil(F.col("words") / BLOCK_WORDS).cast("long")), "mix-sources")

    # one row per input row, copies numbered; many copies of one row are spread before they are counted out
    few = sized.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(CHUNK).cast("long")))).repartition("id", "size", "from")
    each = few.withColumn("copy", F.explode(F.sequence("from", F.least(F.col("from") + CHUNK - 1, F.col("copies")))))
    mixed_up = F.md5(F.concat_ws("/", F.coalesce(F.col("id").cast("string"), F.lit("null")), F.col("size").cast("string"), F.col("copy").cast("string")))
    known = sources.select(F.col("source").alias("name"), "number", "source_size", "target", "words")
    each = each.withColumn("draw", mixed_up).join(broadcast_if_small(known), F.col("source").eqNullSafe(F.col("name")))
    rows = sized.agg(F.sum("copies")).first()[0] or 0
    parts = 1 + rows // PART_ROWS
    part = F.floor(F.conv(F.substring("draw", 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32)) * parts)
    each = saved(each.select("id", "source", "size", "copy", "number", "source_size", "target", "words", "draw", part.alias("part")), "mix-documents")

    inside = Window.partitionBy("number", "part").orderBy("draw", F.col("id").asc_nulls_first(), "size", "copy").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("number").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    some = each.where("size > 0")
    offsets = some.groupBy("number", "part").agg(F.sum("size").alias("n")).select("number", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    start = F.coalesce(F.sum("size").over(inside), F.lit(0)) + F.col("ahead")
    laid = some.join(offsets, ["number", "part"]).withColumn("at", start)
    laid = laid.withColumn("time", F.explode(F.sequence(F.lit(0), F.lit(MOST_TIMES - 1)))).withColumn("start", F.col("at") + F.col("time") * F.col("source_size"))
    laid = laid.where("start < words").withColumn("end", F.least(F.col("start") + F.col("size"), F.col("words")))
    block = F.explode(F.sequence(F.floor(F.col("start") / BLOCK_WORDS), F.floor((F.col("end") - 1) / BLOCK_WORDS)))
    cut = laid.withColumn("block", block).withColumn("lo", F.greatest("start", F.col("block") * BLOCK_WORDS)).withColumn("hi", F.least("end", (F.col("block") + 1) * BLOCK_WORDS))
    cut = cut.select("number", "block", "id", "size", "copy", (F.col("lo") - F.col("start")).alias("first_word"), (F.col("hi") - F.col("lo")).alias("n_words"))
    return Mix(sources, each.select("id", "source", "number", "size", "copy", "source_size", "target"), cut.join(schedule(sources), ["number", "block"]))


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Rows (id, size, source_size, target, taken), one per input row: the words that the blocks of the mix take of it, repeats counted."""
    m = mix(docs, id_col, text_col, source_col)
    key = ["number", "id", "size", "copy"]
    every = m.documents.select(*key, "source_size", "target", F.lit(0).cast("long").alias("n_words"))
    took = m.pieces.select(*key, F.lit(None).cast("long").alias("source_size"), F.lit(None).cast("double").alias("target"), "n_words")
    return (every.unionByName(took).groupBy(*key).agg(F.max("source_size").alias("source_size"), F.max("target").alias("target"), F.sum("n_words").alias("taken"))
            .select(F.col("id").alias(id_col), "size", "source_size", "target", "taken"))
