"""Mixing sources to target weights by fitting budgets of words exactly.

A source's target is its share of all words. Documents are counted by their exact
length, a share of every length is taken, in whole passes and parts of one, and a
bounded-knapsack table over the lengths fits the budget that remains. Of a length the first documents by a seeded
hash are taken.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bronzeway.operators.ranking import with_position
from bronzeway.sources.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: No document is taken more often.
MOST = 3
SEED = 214
#: The table covers budgets up to so many words for each of the lengths together, but
#: from LEAST_WIDTH to MOST_WIDTH; above it documents are taken one by one, longest first.
WORK, LEAST_WIDTH, MOST_WIDTH = 1 << 28, 1 << 14, 1 << 21
#: So many times the longest document are left to the table, or its width.
RESERVE = 4
#: Documents of a length are ranked in parts of about so many.
PART_ROWS = 1 << 16
#: So many repeated rows stay together.
PIECE_ROWS = 1 << 16


def word_count(text: Column) -> Column:
    """Words of a text; a NULL one has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int, more: np.ndarray | None = None) -> np.ndarray:
    """How many of each size to take, so that their sum is nearest to the budget.

    Of two sums as near the smaller one counts. Sums up to twice the budget are
    looked at, as none above is nearer than nothing. Counts are cut into powers of
    two; ``by`` tells by which piece a sum was reached first, so the pieces of a sum
    are found by going back. ``more`` can be taken of each size once ``counts`` don't do.
    """
    taken = np.zeros(len(sizes), np.int64)
    limit = 2 * budget
    if budget <= 0:
        return taken
    mask = (1 << (limit + 1)) - 1
    reached, by = 1, np.full(limit + 1, -1, np.int32)
    pieces: list[tuple[int, int]] = []

    def places(bits: int) -> np.ndarray:
        data = np.frombuffer(bits.to_bytes(limit // 8 + 1, "little"), np.uint8)
        return np.flatnonzero(np.unpackbits(data, bitorder="little"))

    for there in (counts, more) if more is not None else (counts,):
        for i in np.argsort(-sizes, kind="stable").tolist():
            size, left, piece = int(sizes[i]), int(min(there[i], limit // sizes[i])), 1
            while left and not reached >> budget & 1:
                times = min(piece, left)
                left, piece = left - times, piece * 2
                new = (reached << size * times) & mask & ~reached
                if new:
                    by[places(new)] = len(pieces)
                    pieces.append((i, times))
                    reached |= new
    sums = places(reached)
    at = int(sums[np.abs(sums - budget).argmin()])
    while at:
        i, times = pieces[by[at]]
        taken[i] += times
        at -= int(sizes[i]) * times
    return taken


def chosen_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, often: int = 1) -> np.ndarray:
    """How many documents of each size to take, each ``often`` times at most.

    The same share of every size, rounded down, for the budget less RESERVE of the
    longest; then one more of a size, longest first, while what is left is wider than the
    table; then the table.
    """
    taken = np.zeros(len(sizes), np.int64)
    real = np.flatnonzero(sizes > 0)
    size, there = sizes[real], counts[real]
    words = sum(int(s) * int(c) for s, c in zip(size, there))
    if budget <= 0 or not words:
        return taken
    width = min(max(WORK // len(real), LEAST_WIDTH), MOST_WIDTH)
    share = max(0, budget - min(RESERVE * int(size.max()), width)) / words
    own = np.minimum(there * often, np.floor(there * share * (1 - 1e-12)).astype(np.int64))
    left = budget - sum(int(s) * int(c) for s, c in zip(size, own))
    for i in np.argsort(-size, kind="stable").tolist():
        if left - size[i] >= width and own[i] < there[i] * often:
            own[i] += 1
            left -= int(size[i])
    once = np.maximum(there * -(-own // there) - own, 0)
    once[once == 0] = np.minimum(there, there * often - own)[once == 0]
    taken[real] = own + knapsack(size, once, left, there * often - own - once)
    return taken


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source_size`` and ``target`` of each source (source, source_size).

    Sources by code point, NULL last, weigh as ``weights`` repeat. Together the targets
    are all words; none is above ``most`` times its source, and what would be is shared
    by weight among the others. One sum over all sources a round finds which are full.
    """
    placed = with_position(sources, [F.asc_nulls_last("source")], "place")
    weight = F.get(F.lit(list(weights)), ((F.col("place") - 1) % len(weights)).cast("int"))
    rows = stored(placed.select("source", "source_size", weight.cast("bigint").alias("weight")), "sources")
    full = F.col("source_size") * most
    total = rows.agg(F.sum("source_size"), F.sum("weight")).first()
    each = total[0] / total[1] if total[1] else 0.0
    while True:
        above = full < F.col("weight") * F.lit(each)
        held = rows.agg(F.sum(F.when(above, full)), F.sum(F.when(~above, F.col("weight")))).first()
        # Whole numbers, so that every run divides the same two.
        again = (total[0] - (held[0] or 0)) / held[1] if held[1] else each
        if again <= each:
            break
        each = again
    target = F.least(full.cast("double"), F.col("weight") * F.lit(each))
    return rows.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    text: str = "text",
    id: str = "doc_id",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies, source.

    ``size`` is the number of words, 0 for NULL and for texts without any. ``target``
    is the document's source's (see ``targets``). ``copies`` is how often the mix takes
    the document, ``most`` times at most, and ``taken`` the words that gives.

    A source's taken words come to its target as near as counts of each length can:
    see ``chosen_counts``. Which documents of
    a length are taken is decided by a hash of source, id and ``seed``, so reruns
    agree; all others have been taken before one is taken again. Rows equal in source, id and size are told apart by nothing and need not be:
    so many of them as asked for are taken. NULL ids and sources are values like
    others; no rows give none. Texts may be of any length; they are counted where they
    are read and don't move. Other columns of ``docs`` are left out, whatever their
    names.
    """
    rows = docs.select(
        F.col(source).alias("source"), F.col(id).alias("id"), word_count(F.col(text)).alias("size")
    )
    # Copies of a row meet as a count, made before anything moves.
    counted = rows.groupBy("source", "size", "id").agg(F.count("*").alias("n"))
    pieces = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / PIECE_ROWS)))
    own = F.least(F.lit(PIECE_ROWS), F.col("n") - F.col("piece") * PIECE_ROWS)
    place = F.xxhash64(F.lit(seed), "source", "id", "piece")
    grouped = stored(
        counted.withColumn("piece", pieces).select("source", "size", "id", own.alias("n"), place.alias("place")),
        "sizes",
    )
    lengths = grouped.groupBy("source", "size").agg(F.sum("n").alias("n"))
    lengths = stored(lengths, "lengths")
    sized = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    shares = stored(targets(sized, weights, most), "targets").withColumnRenamed("source", "of")
    histograms = lengths.join(shares, F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "size", "n", "source_size", "target"
    )
    kind = docs.select(F.col(source).alias("source")).schema[0].dataType.simpleString()

    def plan(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("size", kind="stable")
        # To the nearest word.
        budget = math.floor(frame["target"].iloc[0] + 0.5)
        sizes, counts = (frame[c].to_numpy(np.int64) for c in ("size", "n"))
        return frame.assign(chosen=chosen_counts(sizes, counts, budget, most))

    # A source has few lengths: k different ones need k * (k + 1) / 2 words.
    planned = histograms.groupBy("source").applyInPandas(
        plan,
        f"source {kind}, size bigint, n bigint, source_size bigint, target double, chosen bigint",
    )
    planned = stored(planned, "counts").withColumnsRenamed({"source": "of", "size": "long", "n": "many"})
    # The documents of a length, in order of their hashes, in parts of about equal size.
    parts = F.ceil(F.col("many") / PART_ROWS)
    spot = F.col("place") / F.lit(2.0**64) + F.lit(0.5)
    part = F.least(F.floor(spot * parts), parts - 1).cast("bigint")
    joined = grouped.join(planned, F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long")))
    dealt = joined.withColumn("part", part).drop("of", "long")
    before = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    fronts = dealt.groupBy("source", "size", "part").agg(F.sum("n").alias("n")).select(
        F.col("source").alias("of"), F.col("size").alias("long"), F.col("part").alias("piece"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("front"),
    )
    same = (
        F.col("source").eqNullSafe(F.col("of")) & (F.col("size") == F.col("long")) & (F.col("part") == F.col("piece"))
    )
    inside = (
        Window.partitionBy("source", "size", "part").orderBy("place", "id").rowsBetween(Window.unboundedPreceding, -1)
    )
    ahead = F.col("front") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    placed = dealt.join(fronts, same).withColumn("ahead", ahead)
    each = placed.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n"))))
    rank, again = F.col("ahead") + F.col("k"), F.floor(F.col("chosen") / F.col("many"))
    copies = (again + F.when(rank <= F.col("chosen") - again * F.col("many"), 1).otherwise(0)).cast("int")
    return each.select(
        F.col("id").alias(id), "size", "source_size", "target",
        (F.col("size") * copies).alias("taken"), copies.alias("copies"), F.col("source").alias(source),
    )
