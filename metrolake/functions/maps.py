"""Map helpers for the map-shaped raw rows."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def last_wins_policy(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.mapKeyDedupPolicy", "EXCEPTION").upper() == "LAST_WIN"


def map_last_wins(keys: Column, values: Column, session_last_wins: bool = False) -> Column:
    """``map_from_arrays`` where a repeated key keeps its *last* value.

    With the session policy ``spark.sql.mapKeyDedupPolicy=LAST_WIN`` (set by
    metrolake's session) the built-in does exactly that; otherwise the
    duplicates are removed first with array functions (slower: lambdas are
    interpreted). ``keys`` should be a column reference, not an expression.
    """
    if session_last_wins:
        return F.map_from_arrays(keys, values)
    k, v = keys, values
    keep = F.filter(F.sequence(F.lit(1), F.size(k)),
                    lambda i: ~F.exists(F.slice(k, i + 1, F.size(k)), lambda x: x == F.element_at(k, i)))
    keep = F.when(F.size(k) > 0, keep).otherwise(F.array().cast("array<int>"))
    return F.map_from_arrays(F.transform(keep, lambda i: F.element_at(k, i)),
                             F.transform(keep, lambda i: F.element_at(v, i)))


def fit_to(values: Column, n: Column) -> Column:
    """Pad with nulls / cut ``values`` to length ``n``.

    Built from array functions without a lambda: an array expression used
    inside a lambda would be re-evaluated for every element once Catalyst
    inlines it."""
    pad = F.array_repeat(F.lit(None).cast("string"), F.greatest(n - F.size(values), F.lit(0)))
    return F.slice(F.concat(values, pad), 1, F.greatest(n, F.lit(1)))
