"""Row position within a group, in a given order, at any group size.

Several operators need "the i-th row of this run / this equipment in time
order" (least-squares slope on the row index, first-half vs second-half
means, first N rows in file order). A window ``row_number() OVER (PARTITION
BY g ORDER BY o)`` does it, but puts each group in one task, which breaks
down when a single group holds a large share of all rows.

Here the positions come from Spark's range partitioner itself: rows are
range-partitioned and sorted by (group, order), a row's place in its
partition is counted as it streams by, and the number of a group's rows in
earlier partitions (one row per group and partition it has rows in, a prefix
sum) is added. A group of any size is spread over as many partitions as its
share asks for; nothing is sized by an estimate.

The partitioner samples, and another evaluation may cut elsewhere, so a
sorted frame is either used once (``segments``: everything is aggregated in
the pass that counts) or written once (``ordered_index``: a checkpoint).

The order must be total (end it with a unique key) so that a recomputed
task reproduces the same positions. Nulls come last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

#: ``monotonically_increasing_id``: partition number above these bits, place in the partition below.
PLACE_BITS = 33


def _range_sorted(df: DataFrame, cols: Sequence[str], partitions: int | None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``cols``, with ``__part`` and ``__place``: partition and place in it."""
    keys = [F.col(c).asc_nulls_last() for c in cols]
    d = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    at = F.monotonically_increasing_id()
    return (d.sortWithinPartitions(*keys).withColumn("_at", at)
            .withColumn("__part", F.shiftright("_at", PLACE_BITS))
            .withColumn("__place", F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))).drop("_at"))


def _offsets(seg: DataFrame, by: Sequence[str]) -> DataFrame:
    """``seg(by, __part, _n, ...)`` plus ``_off``: the group's rows in earlier partitions."""
    before = Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    return seg.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))


def segments(df: DataFrame, by: Sequence[str], order: Sequence[str], aggs: Sequence[Column],
             partitions: int | None = None) -> DataFrame:
    """One row per group and range partition: ``by``, ``_off``, ``_n``, ``_k0`` and ``aggs``.

    ``aggs`` aggregate over the columns of ``df`` and ``__place``; the position of
    a row in its group is ``_off + __place - _k0``. One evaluation of ``df``'s
    sorted rows; groups and partitions bound the result.
    """
    by = list(by)
    seg = _range_sorted(df, [*by, *order], partitions).groupBy(*by, "__part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("__place").alias("_k0"), *aggs)
    return _offsets(seg, by).drop("__part")


def ordered_index(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "_ix",
                  buckets: int | None = None) -> DataFrame:
    """Add ``name``: the 0-based position of each row inside its ``by`` group,
    by the columns ``order`` ascending, nulls last.

    ``buckets``: how many range partitions (None: as the session shuffles; 1: a plain window).
    """
    by, order = list(by), list(order)
    if buckets == 1:
        w = Window.partitionBy(*by).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        return df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))
    ensure_checkpoint_dir(df.sparkSession)
    d = _range_sorted(df, [*by, *order], buckets).checkpoint()
    seg = _offsets(d.groupBy(*by, "__part").agg(F.count(F.lit(1)).alias("_n"), F.min("__place").alias("_k0")), by)
    seg = seg.select(F.col("__part").alias("_sp"), *[F.col(b).alias(f"_s{i}") for i, b in enumerate(by)],
                     (F.col("_off") - F.col("_k0")).alias("_shift"))
    cond = [F.col("__part") == F.col("_sp")] + [F.col(b).eqNullSafe(F.col(f"_s{i}")) for i, b in enumerate(by)]
    out = d.join(seg, cond).withColumn(name, (F.col("__place") + F.col("_shift")).cast("long"))
    return out.drop("__part", "__place", "_sp", "_shift", *[f"_s{i}" for i in range(len(by))])


def largest_group(df: DataFrame, by: Sequence[str]) -> int:
    """Row count of the biggest group (partial aggregation, one number back)."""
    row = df.groupBy(*by).count().agg(F.max("count").alias("m")).first()
    return int(row["m"] or 0) if row else 0


#: Hash buckets of ``groups_within``.
GROUP_BUCKETS = 1 << 16


def groups_within(df: DataFrame, by: Sequence[str], limit: int) -> bool:
    """True: no group has more than ``limit`` rows. False: one may have.

    Rows are counted by a hash of the group, so however many groups there are, a task sends at most
    ``GROUP_BUCKETS`` counts; a bucket holds whole groups, so its count bounds theirs.
    """
    bucket = F.pmod(F.xxhash64(*by), F.lit(GROUP_BUCKETS))
    row = df.groupBy(bucket.alias("_g")).count().agg(F.max("count").alias("m")).first()
    return int(row["m"] or 0) <= limit if row else True
