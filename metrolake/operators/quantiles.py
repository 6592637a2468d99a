"""Exact per-group quantiles (linear interpolation) at any group size.

``percentile`` keeps a value->count map per group and merges it map-side;
its size is bounded by the group's row count. ``group_quantiles`` therefore
checks the largest group first (one aggregation): when every group is
below ``max_map_rows`` it uses ``percentile``; otherwise it selects by
histogram refinement, with no sort and no rank of all values:

* the values sought are those at the places ``floor(h)`` and ``floor(h) + 1``
  of each quantile, ``h = (n - 1) * p``;
* each pass counts the values of the ranges still open in ``BINS`` equal bins
  (partial aggregation: a task sends at most a bin's count, least and greatest
  value), and a prefix sum over the bins of a range says in which bin a place
  lies; the bin's least and greatest value are the next range;
* a range whose ends are equal is found; a pass narrows a range ``BINS``
  times, and at most a few passes over ever fewer values are needed.

Quantiles are mixed as ``percentile`` mixes them:
``q = (1 - f) * v[floor(h)] + f * v[floor(h) + 1]`` with ``f = h - floor(h)`` (equal values as they are),
so both ways give the same result to the last bit, and neither collects a group
into one task. ``approx`` uses the fixed-size ``percentile_approx`` sketch instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .ordered import largest_group

MAX_MAP_ROWS_CONF = "metrolake.quantiles.maxMapRows"
DEFAULT_MAX_MAP_ROWS = 2_000_000
BINS = 1024
#: All the doubles there are (2,100 binary orders of magnitude, ten a pass) need fewer passes; usual values need a few.
MAX_PASSES = 400


def _select_places(d: DataFrame, by: list[str], value: str, places: DataFrame) -> DataFrame:
    """``places(by, place)`` plus ``v``: the value at that 0-based place of the group's ascending values."""
    keys = [f"_b{i}" for i in range(len(by))]
    vals = d.select(*[F.col(b).alias(k) for b, k in zip(by, keys, strict=True)], F.col(value).cast("double").alias("_v"))
    same = [F.col(k).eqNullSafe(F.col(f"_s{k}")) for k in keys]
    ends = vals.groupBy(*keys).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    want = places.select(*[F.col(b).alias(f"_s{k}") for b, k in zip(by, keys, strict=True)], "place")
    # One row per group and place: the range that holds it and how many values lie below the range.
    state = ends.join(want, same).select(*keys, "place", "lo", "hi", F.lit(0).cast("long").alias("below")).checkpoint()
    done = None
    for _ in range(MAX_PASSES):
        found = state.filter("lo = hi").select(*keys, "place", F.col("lo").alias("v"))
        done = found if done is None else done.unionByName(found)
        state = state.filter("lo < hi")
        if not state.take(1):
            return done.select(*[F.col(k).alias(b) for b, k in zip(by, keys, strict=True)], "place", "v")
        ranges = state.select(*[F.col(k).alias(f"_s{k}") for k in keys], "lo", "hi", "below").distinct()
        # A value lies in at most one of a group's ranges: they are equal or apart.
        inside = vals.join(ranges, [*same, F.col("_v").between(F.col("lo"), F.col("hi"))])
        # A range as wide as all doubles is measured in halves, where it can't overflow.
        wide = F.col("hi") - F.col("lo") == float("inf")
        share = F.when(wide, (F.col("_v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2)).otherwise(
            (F.col("_v") - F.col("lo")) / (F.col("hi") - F.col("lo")))
        bins = inside.groupBy(*keys, "lo", "hi", "below", F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin")).agg(
            F.count(F.lit(1)).alias("c"), F.min("_v").alias("lo2"), F.max("_v").alias("hi2"))
        w = Window.partitionBy(*keys, "lo", "hi", "below").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        bins = bins.withColumn("from", F.col("below") + F.coalesce(F.sum("c").over(w), F.lit(0)))  # BINS rows a range
        bins = bins.select(*[F.col(k).alias(f"_s{k}") for k in keys], F.col("lo").alias("lo1"), F.col("hi").alias("hi1"),
                           "from", "c", "lo2", "hi2")
        at = (F.col("place") >= F.col("from")) & (F.col("place") < F.col("from") + F.col("c"))
        state = state.join(bins, [*same, F.col("lo") == F.col("lo1"), F.col("hi") == F.col("hi1"), at]).select(
            *keys, "place", F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), F.col("from").alias("below")).checkpoint()
    raise RuntimeError("quantile ranges did not settle")


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str], strategy: str = "auto", tie_break: Sequence[str] = (),
                    accuracy: int = 100000, max_map_rows: int | None = None) -> DataFrame:
    """``by`` columns + one column per name: the ``probs`` quantiles of the
    non-null ``value`` of each group (groups without values are absent).

    ``strategy``: auto, map (``percentile``), ranked (histogram refinement) or
    approx. ``tie_break`` is not needed by any of them: equal values are one.
    """
    by = list(by)
    d = df.filter(F.col(value).isNotNull())
    if strategy == "auto":
        limit = max_map_rows or int(df.sparkSession.conf.get(MAX_MAP_ROWS_CONF, str(DEFAULT_MAX_MAP_ROWS)))
        strategy = "map" if largest_group(d, by) <= limit else "ranked"
    if strategy == "map":
        q = F.percentile(value, F.array(*[F.lit(float(p)) for p in probs]))
        return d.groupBy(*by).agg(q.alias("_q")).select(
            *by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if strategy == "approx":
        q = F.percentile_approx(value, [float(p) for p in probs], accuracy)
        return d.groupBy(*by).agg(q.alias("_q")).select(
            *by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
    if strategy != "ranked":
        raise ValueError(f"unknown strategy {strategy!r}")
    ensure_checkpoint_dir(df.sparkSession)
    counts = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).checkpoint()
    hs = [(F.col("_n") - 1) * float(p) for p in probs]
    places = F.array(*[x for h in hs for x in (F.floor(h), F.least(F.floor(h) + 1, F.col("_n") - 1))])
    places = counts.select(*by, F.explode(F.array_distinct(places)).alias("place"))
    got = _select_places(d, by, value, places).select(*[F.col(b).alias(f"_q{i}") for i, b in enumerate(by)], "place", "v")
    j = counts.join(got, [F.col(b).eqNullSafe(F.col(f"_q{i}")) for i, b in enumerate(by)])
    aggs = []
    for i, h in enumerate(hs):
        aggs.append(F.max(F.when(F.col("place") == F.floor(h), F.col("v"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when(F.col("place") == F.floor(h) + 1, F.col("v"))).alias(f"_hi{i}"))
        aggs.append(F.first(h - F.floor(h)).alias(f"_fr{i}"))
    got = j.groupBy(*by).agg(*aggs)
    out = []
    for i, n in enumerate(names):
        lo, hi, fr = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        out.append(F.when(hi.isNull() | (fr == 0) | (lo == hi), lo).otherwise((1 - fr) * lo + fr * hi).alias(n))
    return got.select(*by, *out)
