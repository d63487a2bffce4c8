"""Mixing sources to target weights along a time-varying curriculum.

Targets: sources in code-point order (null last) get the weights 3, 1, 2, repeating, and
share ``budget`` times all words; a source takes at most ``epochs`` times its size, and the
excess is shared again by weight until none is above (``targets``, in closed form).

Curriculum: a source's weight changes linearly over training, from ``ramp[0]`` to
``ramp[1]`` times its mean. Its integral is the words of the source seen by time t; the
source's documents, in a hashed order and one epoch after another, are laid along that
demand, and the inverse of the integral gives the time at which each is reached. Sorting
all copies by that time (a range sort) is the training order (``training_order``).

A document is taken once for every epoch whose demand reaches it whole; the one document in
which the demand ends is taken in part (``taken`` counts its words), so a source's words are
its target rounded down. No order depends on how rows are dealt: it is md5 of the key.

Running totals never put a source in one task: the hashed order is cut into cells, cells are
totalled (combined before the shuffle), running totals over cells give where each begins,
and only a cell is ordered in one task. Cells grow in number with the rows.

Edge cases: a null text has size 0; documents of size 0 are taken 0 times; a null source is a
source; equal rows are separate rows; an empty table gives an empty result; a null key
hashes as the empty string.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
RAMP = (0.5, 1.5)
ROWS_A_CELL = 2000


def targets(sizes: DataFrame, budget: float = BUDGET, epochs: int = EPOCHS, weights: tuple = WEIGHTS) -> DataFrame:
    """sizes: source, size (long). Returns source, source_size, weight, target.

    min(epochs * size, weight * level): sources fill up in the order of epochs * size / weight, and the
    level is what the budget leaves to the others over their weights. One row a source, so small windows.
    """
    sized = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
    weighed = sized.select("source", "source_size", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int")).alias("weight"))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")), F.asc_nulls_last("source"))
    everything = Window.partitionBy(F.lit(1))
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    share = F.lit(float(budget)) * F.sum("source_size").over(everything)
    full_before = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * epochs
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levels = weighed.select("*", ((share - full_before) / weight_left).alias("level"),
                            (F.col("source_size") * F.lit(float(epochs))).alias("most"))
    # A source is full if its cap is within its own level, given that all before it are full. The first
    # that is not sets the level of the rest; from there on these levels fall.
    below = F.when(F.col("most") > F.col("weight") * F.col("level"), F.col("level"))
    return levels.select("source", "source_size", "weight", F.least(
        "most", F.coalesce(F.col("weight") * F.max(below).over(everything), F.col("most"))).alias("target"))


def demand_time(words: Column, target: Column, ramp: tuple = RAMP) -> Column:
    """Time in [0, 1] by which a source has had ``words`` words: the inverse of its integrated weight.

    The weight at t is a + (b - a) t with mean 1, so words / target = a t + (b - a) t^2 / 2.
    """
    mean = (ramp[0] + ramp[1]) / 2
    a, slope = ramp[0] / mean, (ramp[1] - ramp[0]) / mean
    share = F.least(F.try_divide(words, target), F.lit(1.0))
    if slope == 0:
        return share
    return F.least((F.sqrt(F.lit(a * a) + F.lit(2 * slope) * share) - F.lit(a)) / F.lit(slope), F.lit(1.0))


def sized(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(*keep, words.alias("size"))


def mix(rows: DataFrame, budget: float = BUDGET, epochs: int = EPOCHS, weights: tuple = WEIGHTS,
        ramp: tuple = RAMP, key: str = "doc_id") -> DataFrame:
    """rows: key, source, size. Adds source_size, target, taken and ``times`` (array<double>: when each
    copy is reached) and ``words_each`` (how many words of it are taken).

    ``rows`` is read three times, so pass a stored table.
    """
    n = rows.count()
    digits = max(1, math.ceil(math.log(max(n, 1) / ROWS_A_CELL, 16)))
    order = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    label = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))  # a key that is never null
    hashed = rows.select("*", label.alias("_s"), order.alias("_order"), F.substring(order, 1, digits).alias("_cell"))
    before = lambda *part: Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    total_before = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    # Running totals over a source's cells, by way of groups of cells, so that no task holds all cells either.
    cells = hashed.groupBy("_s", "_cell").agg(F.sum("size").alias("_n")).withColumn(
        "_top", F.substring("_cell", 1, max(1, digits // 2)))
    tops = cells.groupBy("_s", "_top").agg(F.sum("_n").alias("_m")).select(
        F.col("_s").alias("_s2"), F.col("_top").alias("_top2"),
        total_before("_m", before("_s").orderBy("_top")).alias("_before_top"))
    cells = cells.withColumn("_in_top", total_before("_n", before("_s", "_top").orderBy("_cell")))
    begins = cells.join(tops, (F.col("_s") == F.col("_s2")) & (F.col("_top") == F.col("_top2"))).select(
        F.col("_s").alias("_s3"), F.col("_cell").alias("_cell3"), (F.col("_before_top") + F.col("_in_top")).alias("_begin"))
    goal = targets(rows.select("source", "size"), budget, epochs, weights).select(
        label.alias("_s4"), "source_size", "target")
    begins = begins.join(goal, F.col("_s3") == F.col("_s4"))
    placed = hashed.join(begins, (F.col("_s") == F.col("_s3")) & (F.col("_cell") == F.col("_cell3")))
    within = before("_s", "_cell").orderBy("_order", F.asc_nulls_first(key), "size")
    full = placed.withColumn("_at", F.col("_begin") + total_before("size", within))
    whole = F.floor("target")
    begin = lambda e: F.col("_at") + e * F.col("source_size")
    got = lambda e: F.greatest(F.least(whole - begin(e), F.col("size")), F.lit(0))
    copies = F.array(*[F.struct(got(e).alias("n"), demand_time(begin(e), F.col("target"), ramp).alias("t"))
                       for e in range(epochs)])
    full = full.withColumn("_copies", F.filter(copies, lambda x: x["n"] > 0))
    taken = F.aggregate("_copies", F.lit(0).cast("long"), lambda s, x: s + x["n"])
    return full.select(*rows.columns, "source_size", "target", taken.alias("taken"),
                       F.transform("_copies", lambda x: x["t"]).alias("times"),
                       F.transform("_copies", lambda x: x["n"]).alias("words_each"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row for each copy, range-sorted by the time it is reached: copy, words, time."""
    copies = mixed.select("*", F.posexplode(F.arrays_zip("times", "words_each")).alias("copy", "_c"))
    return (copies.select("*", F.col("_c.words_each").alias("words"), F.col("_c.times").alias("time"))
            .drop("_c", "times", "words_each").orderBy("time", "source", "copy"))
