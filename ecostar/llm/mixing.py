"""Mixing sources to target weights by balanced sampling with the cube method."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ecostar.llm.common import drop_staged, let_go, spread_join, staged

#: Weights of the sources in their order, repeating; a source's target is at most so many times its size.
WEIGHTS, MOST = (1, 2, 3), 3
#: Documents of a source whose fractions move together in one round.
BLOCK = 4096
#: Fractions of a source that the landing decides together.
LANDING = 12
_EPS = 1e-9


def size_of(text: Column) -> Column:
    """Words of a text between ASCII white space; null: 0."""
    words = F.size(F.split(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")), " "))
    blank = F.coalesce(F.regexp_like(text, F.lit(r"^[\x20\x09-\x0D]*$")), F.lit(True))
    return F.when(blank, 0).otherwise(words).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, docs, target, place) from (source, source_size, docs).

    Sources weigh ``weights`` in the order of their code points, null last, repeating. All
    words are shared by weight; a target beyond ``most`` times its source's size stops
    there, and what is over is shared again by weight until none is above. Each round adds
    up the sources where they lie; the order numbers rows per range partition, so that
    neither needs all sources in one place.
    """
    ordered = staged(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("_at", F.monotonically_increasing_id()), "sources")
    part = F.shiftright("_at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()  # a row per partition
    before, total = {}, 0
    for r in counts:
        before[r["part"]] = total
        total += r["n"]
    if not total:
        drop_staged(ordered)
        return sizes.withColumns({"target": F.lit(0.0), "place": F.lit(0).cast("long")})
    starts = F.create_map(*[F.lit(x) for kv in before.items() for x in kv])
    place = starts[part] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    rated = ordered.withColumn("place", place).withColumn("weight", weight).drop("_at")
    sums = rated.agg(F.sum("source_size").alias("all"), F.sum("weight").alias("w")).first()
    level, capped = sums["all"] / sums["w"], -1
    while True:
        full = F.col("source_size") * most <= F.col("weight") * level
        s = rated.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)).alias("size"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("w"), F.count_if(full).alias("n"),
        ).first()
        if s["n"] == capped or not s["w"]:
            break
        capped, level = s["n"], (sums["all"] - s["size"]) / s["w"]
    target = F.least(F.col("source_size") * most, F.col("weight") * level).cast("double")
    return rated.withColumn("target", target).drop("weight")


def flight(p: np.ndarray, sizes: np.ndarray, seed: int, leave: int = 2) -> np.ndarray:
    """Move inclusion probabilities until at most ``leave`` (two or more) are left between 0 and 1.

    Three open units at a time move along the null space of the two constraints (sum of
    sizes, number of documents) in a random direction as far as one of them becomes 0 or
    1. Both expected totals stay what they were at every step.
    """
    p, rng = p.copy(), np.random.default_rng(seed)
    open_ = [int(i) for i in np.flatnonzero((p > _EPS) & (p < 1 - _EPS))]
    held, draws, at = [], rng.random(len(open_)), 0
    prob, size = p.tolist(), sizes.tolist()
    while True:
        while len(held) < 3 and at < len(open_):
            held.append(open_[at])
            at += 1
        if len(held) + len(open_) - at <= leave:
            break
        a, b, c = (size[i] for i in held)
        u = (b - c, c - a, a - b)  # cross product of (a, b, c) and (1, 1, 1)
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for i, x in zip(held, u, strict=True):
            if x > 0:
                up, down = min(up, (1 - prob[i]) / x), min(down, prob[i] / x)
            elif x < 0:
                up, down = min(up, -prob[i] / x), min(down, (prob[i] - 1) / x)
        go = up if draws[at - 1] * (up + down) < down else -down
        draws[at - 1] = (draws[at - 1] * 7919 + 0.6180339887498949) % 1
        for i, x in zip(held, u, strict=True):
            prob[i] = min(1.0, max(0.0, prob[i] + go * x))
        held = [i for i in held if _EPS < prob[i] < 1 - _EPS]
    return np.round(np.array(prob), 12) if prob else p


def land(p: np.ndarray, sizes: np.ndarray, expected: float) -> np.ndarray:
    """0 or 1 for the last fractions: the choice whose words come nearest to the expected ones.

    A very long document among few can still leave a gap; then documents change sides one
    by one, each time the one whose size is nearest to the gap, while that narrows it.
    """
    open_ = np.flatnonzero((p > _EPS) & (p < 1 - _EPS))
    out = np.round(p)
    out[open_] = 0
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    out[open_] = choices[np.abs(out @ sizes + choices @ sizes[open_] - expected).argmin()]
    while True:
        gap = expected - out @ sizes
        sides = np.flatnonzero((out == (0 if gap > 0 else 1)) & (sizes > 0) & (sizes < 2 * abs(gap)))
        if not len(sides) or abs(gap) < 1:
            return out
        at = sides[np.abs(sizes[sides] - abs(gap)).argmin()]
        out[at] = 1 - out[at]


def _fly(pdf: pd.DataFrame, seed: int, leave: int) -> pd.DataFrame:
    let_go()
    pdf = pdf.sort_values(["rank", "id", "size"], kind="stable", ignore_index=True)
    pdf["p"] = flight(pdf["p"].to_numpy(), pdf["size"].to_numpy(float), seed=seed, leave=leave)
    return pdf


def _round(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return _fly(pdf, int(key[1]) % (1 << 31), 2)


def _landing(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    expected = float(pdf["p"].to_numpy() @ pdf["size"].to_numpy(float))
    pdf = _fly(pdf, 0, LANDING)
    pdf["p"] = land(pdf["p"].to_numpy(), pdf["size"].to_numpy(float), expected)
    return pdf


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block: int = BLOCK,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken, text_key), one row per row of ``docs``; text_key is a hash of the text.

    A source whose target is r times its size takes each document floor(r) times, and
    once more with probability r - floor(r), by balanced sampling: blocks of about
    ``block`` documents fly first, the two fractions that each leaves meet in blocks again
    until a source has one block, whose last dozen land where the words come nearest to the
    target. So a hot source is many tasks. The order in a block is a hash of the id, hence
    reruns agree. A null source is a source of its own; null and blank texts have size 0
    and never count; repeated rows are drawn each, and may swap their copies; no rows
    give no rows.
    """
    base = staged(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size_of(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("text_key"))
        .withColumn("rank", F.xxhash64("id")), "sizes",
    )
    found = staged(targets(base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), weights, most), "targets")
    by_source = found.withColumn("source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    keyed = base.withColumn("source", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = spread_join(keyed, by_source, ["source"], ["id", "size"]).withColumn("rate", rate)
    drawn = rated.select("id", "size", "rank", "place", "source_size", "target", F.floor("rate").alias("whole"), (F.col("rate") - F.floor("rate")).alias("p"), "docs", "text_key")
    schema = "id long, size long, rank long, place long, source_size long, target double, whole long, p double, docs long, text_key long, blocks long"
    now = drawn.withColumn("blocks", F.ceil(F.col("docs") / block))
    done = []
    largest = found.agg(F.max("docs")).first()[0] or 0
    while largest > block:
        dealt = now.withColumn("_block", F.pmod(F.xxhash64("rank", "size"), "blocks"))
        flown = staged(dealt.groupBy("place", "_block").applyInPandas(_round, schema.replace("blocks long", "blocks long, _block long")).drop("_block"), "flown")
        open_ = (F.col("p") > _EPS) & (F.col("p") < 1 - _EPS)
        done.append(flown.filter(~open_))
        now = flown.filter(open_).withColumn("blocks", F.ceil(F.col("blocks") * 2 / block))
        largest = largest * 2 // block + 2
    landed = now.groupBy("place").applyInPandas(_landing, schema)
    for part in done:
        landed = landed.unionByName(part)
    copies = (F.col("whole") + F.when(F.col("size") > 0, F.round("p")).otherwise(0)).cast("long")
    return landed.select(F.col("id").alias(id_col), "size", "source_size", "target", copies.alias("copies"), (F.col("size") * copies).alias("taken"), "text_key")
