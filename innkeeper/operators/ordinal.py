"""Exact 1-based line numbers at scale, without a window over a whole file.

Two sources of order exist:
  * physical text splits: rows of one split are contiguous in one task, so the
    position inside the split is ``mid - min(mid)`` (``mid`` from
    ``monotonically_increasing_id`` at the scan). One small row per split
    (count, first id) is prefix-summed per file and joined back.
  * a sortable order key (table-derived feeds): rows are range-partitioned and
    sorted by (file, key); the same per-(partition, file) counts give offsets.

Either way only a table with one row per split/partition is aggregated; a hot file
is spread over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged


def _offsets(df: DataFrame, group: str, unit: str, pos: str) -> DataFrame:
    # Positions are contiguous, and rows may repeat (a file that two jobs asked for): count by the ends.
    stats = df.groupBy(group, unit).agg((F.max(pos) - F.min(pos) + 1).alias("_n"), F.min(pos).alias("_first"))
    w = Window.partitionBy(group).orderBy(unit).rowsBetween(Window.unboundedPreceding, -1)
    return stats.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))


def number_by_splits(df: DataFrame, group: str = "file", unit: str = "_split",
                     pos: str = "_mid", name: str = "line_no",
                     keep: DataFrame | None = None) -> DataFrame:
    """Line numbers for rows whose (group, unit, pos) come from a text scan.

    ``keep`` (a filtered subset of ``df`` with the same columns) limits the join to
    the rows that need a number (e.g. rejects); all rows are still counted.
    """
    offs = _offsets(df, group, unit, pos)
    target = df if keep is None else keep
    out = target.join(offs, [group, unit], "inner")
    return out.withColumn(name, F.col("_before") + (F.col(pos) - F.col("_first")) + 1) \
              .drop("_n", "_first", "_before")


def number_by_order(df: DataFrame, group: str, order: str, name: str = "line_no",
                    keep_filter=None) -> DataFrame:
    """Line numbers = rank of the unique ``order`` key within ``group``.

    Range-partitions by (group, order) so one group may span many tasks. The ranged
    rows, with their partition and position, are written once under the shared
    folder: the counts per partition and the rows they number then come from one
    and the same shuffle, whatever else the frame carries. ``keep_filter`` (a
    Column) restricts the returned rows after numbering.
    """
    ranged = staged(df.repartitionByRange(F.col(group), F.col(order))
                    .sortWithinPartitions(group, order)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_mid", F.monotonically_increasing_id()), "ranged")
    offs = _offsets(ranged, group, "_pid", "_mid")
    target = ranged if keep_filter is None else ranged.filter(keep_filter)
    out = target.join(offs, [group, "_pid"], "inner")
    return out.withColumn(name, F.col("_before") + (F.col("_mid") - F.col("_first")) + 1) \
              .drop("_n", "_first", "_before", "_pid", "_mid")
