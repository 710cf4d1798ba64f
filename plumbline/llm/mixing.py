"""Mixing sources to target weights by balanced (cube) sampling.

Every document of a source is wanted ``target / source size`` times.  The whole
part is taken for certain; the fractional part is an inclusion probability.  The
cube method rounds these probabilities to 0 or 1 while the sum of probabilities
(documents) and the sum of probability * size (tokens) stay what they were:

* flight: three units at a time move along the null vector of the two
  constraints, in a random direction that keeps expectations, until one of them
  is settled;
* a block of units of one source is flown in one task and leaves at most two
  units open; the open units of all blocks of a source form the next, some
  thousand times smaller level;
* landing: the last two units of a source keep the token total only, the very
  last one is drawn by its probability, and then units of the last block are
  turned over as long as that brings the token total nearer to its target.

So the sampled tokens of a source differ from its target by less than one of its
documents, whatever the number of blocks, and no task holds more than a block.

Null sources form a source of their own, which comes last.  Null and empty texts
have size 0 and are not taken.  Rows with the same id, text and source are one
unit: all of them are taken equally often.  An empty table gives no rows.
Extra columns are kept, whatever their names, but those that the result adds
(``size``, ``source_size``, ``target``, ``copies``, ``taken``) replace columns of
the same name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.columns import aside, row_hashes
from plumbline.llm.words import WORD
from plumbline.session import written

SETTLED = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """(source, source_size) to (source, source_size, target); one row per source.

    Sources in code point order, null last, get the weights in turn.  All sizes
    together are shared out by weight; a share above ``most`` times the source's
    size stops there, and the excess is shared among the others again.  That ends
    at the level L with sum(min(most * size, weight * L)) = total: in the order of
    most * size / weight, sources are full as long as the level left for the rest
    is not below them.
    """
    listed = F.array(*(F.lit(float(w)) for w in weights))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    by_fill = Window.orderBy(F.col("_full") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    ranked = sizes.select(
        "source", "source_size", F.get(listed, ((F.row_number().over(order) - 1) % len(weights))).alias("_weight"),
        (F.col("source_size") * float(most)).alias("_full"))
    left = ranked.select(
        "*", ((F.sum("source_size").over(whole) - F.coalesce(F.sum("_full").over(before), F.lit(0.0)))
              / (F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))).alias("_left"))
    return left.select("source", "source_size",
                       F.least("_full", F.col("_weight") * F.max("_left").over(whole)).alias("target"))


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Moves probabilities, three units at a time, until at most two are open. Keeps sum(p) and sum(p * size)."""
    out = p.astype(float)
    draws = iter(rng.random(len(p)).tolist())
    hand: list[tuple[int, float, float]] = []
    for unit in zip(range(len(p)), out.tolist(), size.astype(float).tolist()):
        hand.append(unit)
        if len(hand) < 3:
            continue
        (a, pa_, sa), (b, pb, sb), (c, pc, sc) = hand
        ua, ub, uc = sb - sc, sc - sa, sa - sb
        if ua == 0 and ub == 0 and uc == 0:
            ua, ub = 1.0, -1.0
        moves = [(p_, u) for p_, u in ((pa_, ua), (pb, ub), (pc, uc)) if u]
        up = min((1 - p_) / u if u > 0 else p_ / -u for p_, u in moves)
        down = min(p_ / u if u > 0 else (1 - p_) / -u for p_, u in moves)
        step = up if next(draws) * (up + down) < down else -down
        hand = []
        for i, p_, s, u in ((a, pa_, sa, ua), (b, pb, sb, ub), (c, pc, sc, uc)):
            moved = p_ + step * u
            if moved < SETTLED:
                out[i] = 0.0
            elif moved > 1 - SETTLED:
                out[i] = 1.0
            else:
                hand.append((i, moved, s))
    for i, p_, _ in hand:
        out[i] = p_
    return out


def landing(p: np.ndarray, flown: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Settles the last units: two at a time with the token total kept, then one by its own probability.

    ``p`` are the probabilities before the flight of this block.
    """
    out = flown.copy()
    while True:
        open_ = np.flatnonzero((out > SETTLED) & (out < 1 - SETTLED))
        if len(open_) < 2:
            break
        a, b = open_[:2]
        ua, ub = (float(size[b]), -float(size[a])) if size[a] > 0 and size[b] > 0 else (1.0, 0.0)
        room = lambda p_, u: np.inf if u == 0 else (1 - p_) / u if u > 0 else p_ / -u
        up, down = min(room(out[a], ua), room(out[b], ub)), min(room(out[a], -ua), room(out[b], -ub))
        step = up if rng.random() * (up + down) < down else -down
        out[a], out[b] = out[a] + step * ua, out[b] + step * ub
        out[np.abs(out) < SETTLED] = 0.0
        out[np.abs(out - 1) < SETTLED] = 1.0
    for i in np.flatnonzero((out > SETTLED) & (out < 1 - SETTLED)):
        out[i] = float(rng.random() < out[i])
    out = np.round(out)
    # The landing problem: turn over the unit that brings the token total nearest to its target, while one does.
    for _ in range(16):
        off = float((out - p) @ size)
        turned = np.abs(off + (1 - 2 * out) * size)
        best = int(turned.argmin()) if len(turned) else -1
        if best < 0 or turned[best] >= abs(off) - SETTLED:
            break
        out[best] = 1 - out[best]
    return out


def _fly(seed: int, level: int):
    def run(key: tuple, units: pd.DataFrame) -> pd.DataFrame:
        units = units.sort_values(["_key", "_more_key", "_size"], kind="stable")
        rng = np.random.default_rng([seed, level, zlib.crc32(repr((key[0], int(key[1]))).encode())])
        size = units["_size"].to_numpy()
        p = units["_p"].to_numpy(float)
        flown = flight(p, size, rng)
        return units.assign(_p=landing(p, flown, size, rng) if key[2] == 1 else flown)  # a source's only block ends the flight
    return run


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, seed: int = 1,
          block_rows: int = 4096, source: str = "source", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with size, source_size, target (of the source), copies (how often the mix takes the row) and taken (words).

    ``block_rows`` bounds what one task flies at a time.  Same rows, same draws:
    units are ordered by a hash of the row's id and text, and a block's draws
    depend only on the seed, the level, the source and the block.
    """
    away, back = aside(docs, "size", "source_size", "target", "copies", "taken")
    first, second = row_hashes(doc_id, text, source)
    rows = docs.select(
        *away, F.col(f"`{source}`").alias("_source"),
        word_count(F.col(f"`{text}`")).alias("_size"), first.alias("_key"), second.alias("_more_key"))
    unit = ["_source", "_key", "_more_key"]
    units = written(rows.groupBy(*unit).agg(F.sum("_size").alias("_size")), "mix-units")
    sizes = units.groupBy("_source").agg(F.sum("_size").alias("source_size"), F.count("*").alias("_units"))
    sizes = written(sizes.withColumnRenamed("_source", "source"), "mix-sizes")
    aims = written(targets(sizes.select("source", "source_size"), weights, most), "mix-targets").select(
        F.col("source").alias("_aim"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("_times"))
    # Whole copies for certain, and what is left as a probability.
    whole = F.floor(F.col("_times") + SETTLED)
    part = F.when(F.col("_times") - whole < SETTLED, 0.0).otherwise(F.col("_times") - whole)
    of_source = F.col("_source").eqNullSafe(F.col("_aim"))
    open_ = units.join(aims, of_source).select(*unit, "_size", part.alias("_p")).filter("_p > 0")
    counts = sizes.select(F.col("source").alias("_of"), "_units")
    level, settled = 0, None
    while True:
        blocked = (open_.join(counts, F.col("_source").eqNullSafe(F.col("_of")))
                   .withColumn("_blocks", F.ceil(F.col("_units") / block_rows))
                   .withColumn("_block", F.pmod(F.xxhash64("_key", F.lit(level)), F.col("_blocks")))
                   .select(*unit, "_block", "_blocks", "_size", "_p"))
        flown = written(blocked.groupBy("_source", "_block", "_blocks").applyInPandas(_fly(seed, level), blocked.schema)
                        .select(*unit, "_size", "_p"), "mix-flown")
        settled = flown if settled is None else settled.unionByName(flown)
        open_ = flown.filter("_p > 0 and _p < 1")
        if open_.isEmpty():
            break
        counts = written(open_.groupBy(F.col("_source").alias("_of")).agg(F.count("*").alias("_units")), "mix-counts")
        level += 1
    taken = settled.filter("_p = 1").select(*[F.col(c).alias(f"{c}_taken") for c in unit])
    same = (F.col("_key") == F.col("_key_taken")) & (F.col("_more_key") == F.col("_more_key_taken")) & F.col("_source").eqNullSafe(F.col("_source_taken"))
    copies = F.when(F.col("_size") > 0, whole + F.when(F.col("_key_taken").isNotNull(), 1).otherwise(0)).otherwise(0)
    return (rows.join(taken, same, "left").join(aims, of_source)
            .select(*back, F.col("_size").alias("size"), "source_size",
                    "target", copies.cast("long").alias("copies"), (F.col("_size") * copies).cast("long").alias("taken")))
