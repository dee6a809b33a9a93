"""The ids that have an outcome, kept as ranges: gaps and islands instead of one row per entry."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

#: A range lies within one block of 2^20 ids, so that no task merges more; the table is stored by spans of 2^32.
BLOCK_BITS, SPAN_BITS = 20, 32
#: Entries are compared with ranges by words of 2^6 ids.
WORD_BITS = 6
RANGES = "block BIGINT, lo BIGINT, hi BIGINT, span BIGINT"


def merged(ranges: DataFrame) -> DataFrame:
    """(block, lo, hi, span): overlapping and adjacent ranges of a block as one."""
    order = W.partitionBy("block").orderBy("lo", "hi")
    before = F.max("hi").over(order.rowsBetween(W.unboundedPreceding, -1))
    starts = ranges.select("block", "lo", "hi", F.coalesce((F.col("lo") > before + 1).cast("int"), F.lit(1)).alias("starts"))
    islands = starts.withColumn("island", F.sum("starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
    whole = islands.groupBy("block", "island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return whole.select("block", "lo", "hi", F.shiftright("block", SPAN_BITS - BLOCK_BITS).alias("span"))


def ranges_of(ids: DataFrame) -> DataFrame:
    """The ranges of an ``id`` column; null ids have none."""
    known = ids.filter("id IS NOT NULL")
    return merged(known.select(F.shiftright("id", BLOCK_BITS).alias("block"), F.col("id").alias("lo"), F.col("id").alias("hi")))


def with_ids(ranges: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole spans of ``ranges`` that ``ids`` touch, with those ids; the other spans stay as they are."""
    new = ranges_of(ids)
    old = ranges.join(new.select("span").distinct(), "span", "left_semi")
    return merged(old.select("block", "lo", "hi").unionByName(new.select("block", "lo", "hi")))


def first_island(ranges: DataFrame) -> tuple[int, int] | None:
    """(first, last) of the ids that are done without a gap from the smallest on; None without any.

    Ranges of a block are merged, so only its first one can go on in the next block, and blocks meet one row each.
    """
    blocks = ranges.groupBy("block").agg(F.min("lo").alias("lo"), F.min("hi").alias("hi"))
    after = blocks.select((F.col("block") - 1).alias("block"), F.col("lo").alias("after"))
    follows = F.coalesce(F.col("after") == F.col("hi") + 1, F.lit(False))
    found = blocks.join(after, "block", "left").agg(F.min("lo").alias("first"), F.min(F.when(~follows, F.col("hi"))).alias("last")).first()
    if found["first"] is None:
        return None
    return found["first"], found["last"]


def words(ranges: DataFrame) -> DataFrame:
    """(word, bits): for every 2^6 ids that the ranges touch, a bit per done id."""
    each = F.explode(F.sequence(F.shiftright("lo", WORD_BITS), F.shiftright("hi", WORD_BITS))).alias("word")
    start = f"shiftleft(word, {WORD_BITS})"
    bits = f"shiftleft(-1L, int(greatest(lo - {start}, 0L))) & shiftrightunsigned(-1L, int(greatest({start} + {(1 << WORD_BITS) - 1} - hi, 0L)))"
    return ranges.select("lo", "hi", each).groupBy("word").agg(F.bit_or(F.expr(bits)).alias("bits"))


def pending(entries: DataFrame, ranges: DataFrame) -> DataFrame:
    """Entries whose id lies in no range.

    Ids outside the first island are asked for by literals, which skip the files and row
    groups of all that was done in order. The others meet one row at most: that of their
    block where the whole block is done, else the word that holds their bit.
    """
    done = first_island(ranges)
    if done is None:
        return entries
    rest = entries.filter(F.col("id").isNull() | (F.col("id") < done[0]) | (F.col("id") > done[1]))
    own = ranges.filter((F.col("hi") < done[0]) | (F.col("lo") > done[1]))
    is_whole = F.col("hi") - F.col("lo") == (1 << BLOCK_BITS) - 1
    whole = own.filter(is_whole).select(F.col("block").alias("_block"))
    some = words(own.filter(~is_whole)).select(F.col("word").alias("_word"), F.col("bits").alias("_bits"))
    inside = (F.shiftright("id", WORD_BITS) == F.col("_word")) & F.expr(f"shiftrightunsigned(_bits, int(id & {(1 << WORD_BITS) - 1})) & 1L = 1L")
    left = rest.join(F.broadcast(whole), F.shiftright("id", BLOCK_BITS) == F.col("_block"), "left_anti")  # a row per 2^20 ids
    return left.join(some, inside, "left_anti")
