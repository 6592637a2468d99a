"""Balanced label propagation (operator 4), in DataFrame operations only.

Documents with equal texts are linked. Every document starts in a shard by
hash; then, in rounds, linked documents move to the shard that most of their
neighbours are in, as far as that shard's quota has room. Documents of a group
in one shard have the same neighbours, so a round works on pre-aggregated rows
(group, shard, how many), never on pairs of documents. Moves with the largest
gain in uncut edges are let in first, by a distributed running total against
the room.

The law is ``rows``: in the end shard sizes differ by one row at most. Rows
over a shard's share (smallest groups first) go, group by group, to shards
that lack rows, and unlinked documents fill the rest.

Cases: a null text counts as the empty text, one byte of size, CRC 0; null ids
are placed like others; repeated rows are separate rows of one group; an empty
table gives no rows; 64-bit text hashes that collide only link unrelated texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolake.llm.common import cut, running_total, table


def _of_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), shard + 1)


def _sums(df: DataFrame, key: str, shards: int) -> list[int]:
    """Total of n by shard number: one row a shard."""
    got = {r[key]: r["n"] for r in df.groupBy(key).agg(F.sum("n").alias("n")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _clip(room: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("n"), room - F.col("before")))


def cut_edges(state: DataFrame) -> int:
    """Links between shards in ``state(g, shard, n)``: pairs of a group in different shards."""
    g = state.groupBy("g").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    return int(g.agg(F.sum((F.col("n") * F.col("n") - F.col("own")) / 2)).first()[0] or 0)


def propagate(state: DataFrame, quota: list[int], rounds: int, slack: float = 0.02) -> DataFrame:
    """Rounds of moves on ``state(g, shard, n)``; loads stay near ``quota`` (within ``slack``)."""
    shards = len(quota)
    for _ in range(rounds):
        load = _sums(state, "shard", shards)
        free = [int(q * (1 + slack)) + 1 - x for q, x in zip(quota, load, strict=True)]
        # The shard with most of the group that is not full; the group's rows in other shards want there, those
        # of a fuller part only if the whole group has room there.
        open_ = F.when(_of_shard(free, F.col("shard")) > 0, F.struct("n", F.xxhash64("g", "shard").alias("tie"), "shard"))
        best = state.groupBy("g").agg(F.max(open_).alias("b"), F.sum("n").alias("all")).filter("b is not null").select(
            F.col("g").alias("bg"), "all", F.col("b.n").alias("there"), F.col("b.shard").alias("to"))
        movers = cut(state.join(best, F.col("g") == F.col("bg")).filter("shard <> to").filter(
            (F.col("there") >= F.col("n")) | (F.col("all") - F.col("there") <= _of_shard(free, F.col("to"))))
            .select("g", "shard", "to", "n", F.greatest(F.lit(0), F.col("there") - F.col("n")).alias("gain")))
        leaving = _sums(movers, "shard", shards)
        if not any(leaving):
            break
        # Half of those who want to leave will have left.
        room = [x + y // 2 for x, y in zip(free, leaving, strict=True)]
        ranked = running_total(movers, ["to"], [F.col("g"), F.col("shard")], F.col("n"), "before",
                               lead=F.lit(63) - F.floor(F.log2(F.col("gain") + 1)))
        moved = cut(ranked.select("g", "shard", "to", _clip(_of_shard(room, F.col("to"))).alias("n")).filter("n > 0"))
        new = (state.select("g", "shard", "n")
               .unionByName(moved.select("g", "shard", (-F.col("n")).alias("n")))
               .unionByName(moved.select("g", F.col("to").alias("shard"), "n"))
               .groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))
        state = cut(new)
        if not moved.take(1):
            break
    return state


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 8,
                    rounds: int = 6) -> DataFrame:
    """(doc_id, size, text_crc32, g, shard) for every row, ``g`` the group of equal texts."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = cut(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g")))
    total = own.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    groups = own.groupBy("g").count().filter("count > 1").select(F.col("g").alias("lg"))
    linked = cut(own.join(groups, F.col("g") == F.col("lg"), "left_semi"))
    start = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(shards)).cast("int")
    state = cut(linked.groupBy("g", start.alias("shard")).agg(F.count(F.lit(1)).alias("n")))
    state = propagate(state, quota, rounds)

    # Rows over a shard's share leave, those of small groups first, and go where rows lack, a group together.
    load = _sums(state, "shard", shards)
    over = [max(0, x - q) for x, q in zip(load, quota, strict=True)]
    lack = [max(0, q - x) for x, q in zip(load, quota, strict=True)]
    if any(over):
        ranked = running_total(state, ["shard"], [F.col("g")], F.col("n"), "before",
                               lead=F.floor(F.log2(F.col("n"))))
        parted = cut(ranked.select("g", "shard", "n", _clip(_of_shard(over, F.col("shard"))).alias("out")))
        leave = cut(parted.groupBy("g").agg(F.sum("out").alias("n")).filter("n > 0"))
        ends = [sum(lack[:s + 1]) for s in range(shards)]
        into = F.explode(F.array(*[
            F.struct(F.lit(s).alias("shard"), F.greatest(F.lit(0).cast("long"), F.least(
                F.col("before") + F.col("n"), F.lit(ends[s])) - F.greatest(F.col("before"), F.lit(ends[s] - lack[s])))
                     .alias("n")) for s in range(shards)]))
        come = running_total(leave, [], [F.col("g")], F.col("n"), "before").select("g", into.alias("x")).select(
            "g", "x.shard", "x.n")
        state = cut(parted.select("g", "shard", (F.col("n") - F.col("out")).alias("n")).unionByName(come)
                    .groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"))
        load = _sums(state, "shard", shards)
    # A group's rows in order take its places shard by shard (a row a shard and group).
    w = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = state.withColumn("hi", F.sum("n").over(w)).select(
        F.col("g").alias("pg"), (F.col("hi") - F.col("n")).alias("lo"), "hi", F.col("shard").alias("pshard"))
    ranked = running_total(linked, ["g"], [F.col("doc_id")], F.lit(1), "rank")
    placed = (ranked.join(place, (F.col("g") == F.col("pg")) & (F.col("rank") >= F.col("lo"))
                          & (F.col("rank") < F.col("hi")))
              .select("doc_id", "size", "text_crc32", "g", F.col("pshard").alias("shard")))
    # Unlinked rows fill what the shards lack.
    rest = cut(own.join(groups, F.col("g") == F.col("lg"), "left_anti"))
    ends = [sum(quota[:s + 1]) - sum(load[:s + 1]) for s in range(shards)]
    ranked = running_total(rest, [], [F.col("doc_id"), F.col("g")], F.lit(1), "rank")
    into = reduce(lambda c, s: F.when(F.col("rank") < ends[s], s).otherwise(c), reversed(range(shards - 1)),
                  F.lit(shards - 1))
    return placed.unionByName(ranked.select(
        "doc_id", "size", "text_crc32", "g", into.cast("int").alias("shard")))


def with_slots(placed: DataFrame) -> DataFrame:
    """``placed`` plus slot: places 0, 1, 2, ... inside each shard."""
    return running_total(cut(placed), ["shard"], [F.col("doc_id"), F.col("g")], F.lit(1), "slot")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = with_slots(shard_documents(table(spark, sf_dir, "documents").select("doc_id", "text")))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
