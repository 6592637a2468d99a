"""Embedding near-dedup (operator 1) by a pivot-permutation index.

Each vector is described by its ``nearest`` reference points (pivots) in order
of cosine. Inverted lists by pivot bring together vectors that share pivots;
inside a list, pairs that share at least ``shared`` of their nearest pivots
are candidates, and candidates are verified by cosine in double precision.
Pivots are a sample of the vectors (least hash), ``4 * sqrt(n)`` of them but
at most ``MAX_PIVOTS``, less those within cosine ``APART`` of an earlier one: a
large group of near vectors has few pivots inside, so that its members agree
on their nearest. Every vector is indexed. Measured recall is in the tests
(1.0 on near copies, over 0.9 on pairs at the threshold itself).

Equal vectors are one class from the start. A pair is counted only in the list
of its first shared pivots. A list of more than ``block_rows`` vectors is cut by
hash into blocks, and every pair of its blocks is one piece of work. A piece
returns one row per vector: the sum of its links and its root in a spanning
forest, so no list becomes all its pairs. For larger corpora
``key_pivots=2`` keys the lists by pairs of pivots, with the same results.

Cases: vectors that are null, empty, zero or hold a null or non-finite
component link with nothing; vectors of different lengths are not compared;
null ids are linked, and a component without an id has a null id; repeated
rows are separate vectors; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, components, cut, forest, table, whole_keys

MAX_PIVOTS = 4096
#: No two pivots have a greater cosine.
APART = 0.8
STRIPE = 256


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Unit rows in double precision."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spread(sample: np.ndarray, apart: float = APART) -> np.ndarray:
    """Rows of ``sample`` that are not within cosine ``apart`` of an earlier row that stays."""
    left, keep = np.arange(len(sample)), []
    while len(left):
        keep.append(left[0])
        left = left[1:][sample[left[1:]] @ sample[left[0]] <= apart]
    return sample[keep]


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The k nearest pivots of each row, nearest first (ties: lower number first)."""
    s = x @ pivots.T
    if k < s.shape[1]:
        top = np.sort(np.argpartition(-s, k - 1, axis=1)[:, :k], axis=1)
    else:
        top = np.broadcast_to(np.arange(s.shape[1]), s.shape)
    order = np.argsort(-np.take_along_axis(s, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1)


def block_links(x: np.ndarray, near: np.ndarray, weight: np.ndarray, side: np.ndarray | None, key: list[int],
                pivots: int, shared: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the weights of linked rows, forest label) of each row of one list block.

    ``side``: 0 or 1 where only rows of different sides are to be paired.
    """
    m = len(x)
    words = -(-pivots // 64)
    bits = np.zeros((m, words), np.uint64)
    for c in range(near.shape[1]):
        bits[np.arange(m), near[:, c] // 64] |= np.uint64(1) << (near[:, c] % 64).astype(np.uint64)
    # Pivots below the list's largest one: a pair belongs here if it shares just the key's others there.
    low = np.zeros(words, np.uint64)
    top = max(key)
    low[:top // 64] = ~np.uint64(0)
    low[top // 64] = (np.uint64(1) << np.uint64(top % 64)) - np.uint64(1)
    used = np.flatnonzero(bits.any(axis=0))
    links, lab = np.zeros(m, np.int64), np.arange(m)
    for a in range(0, m, STRIPE):
        z = min(m, a + STRIPE)
        n = np.zeros((z - a, m), np.uint8)
        for w in used:
            n += np.bitwise_count(bits[a:z, None, w] & bits[None, :, w])
        ok = n >= shared
        ok &= np.arange(a, z)[:, None] < np.arange(m)
        if side is not None:
            ok &= side[a:z, None] != side[None, :]
        if not ok.any():
            continue
        ok &= x[a:z] @ x.T >= threshold
        i, j = np.nonzero(ok)
        i += a
        mine = np.bitwise_count(bits[i] & bits[j] & low).sum(axis=1) == len(key) - 1
        i, j = i[mine], j[mine]
        links += np.bincount(i, weight[j], m).astype(np.int64) + np.bincount(j, weight[i], m).astype(np.int64)
        lab = forest(m, i, j, lab)
    return links, lab


def _index(classes: DataFrame, dim: int, n: int, threshold: float, nearest: int, shared: int, key_pivots: int,
           block_rows: int, pivots: int | None, scratch: Scratch) -> DataFrame:
    """(cid, links, root) rows of all list blocks of ``classes(cid, vec, n)``, vectors of one length."""
    spark = classes.sparkSession
    count = min(n, MAX_PIVOTS, pivots or max(32, math.ceil(4 * math.sqrt(n))))
    rows = classes.orderBy(F.xxhash64("vec"), "cid").select("vec").limit(count)
    sample = spread(_matrix(pa.array([r["vec"] for r in rows.collect()], pa.list_(pa.float64())), dim))
    count = len(sample)
    shared_pivots = spark.sparkContext.broadcast(sample)  # MAX_PIVOTS vectors at most
    k = min(nearest, count)
    need, keys = min(shared, k), min(key_pivots, shared, k)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, b.num_rows, 2048):
                s = b.slice(a, 2048)
                near = nearest_pivots(_matrix(s.column("vec"), dim), shared_pivots.value, k).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*s.columns, pa.ListArray.from_arrays(pa.array(np.arange(0, near.size + 1, k), pa.int32()),
                                                          pa.array(near.ravel()))], names=[*b.schema.names, "near"])

    kind = classes.schema["vec"].dataType.simpleString()
    told, _ = scratch.save(classes.select("cid", "vec", "n").mapInArrow(
        describe, f"cid long, vec {kind}, n long, near array<int>"), "near")
    # Lists by pivot, or by every choice of key_pivots of them, in ascending order.
    asc = F.array_sort("near")
    key = F.array(*[sum((F.element_at(asc, c + 1).cast("long") * MAX_PIVOTS ** e for e, c in enumerate(combo)),
                        F.lit(0).cast("long")) for combo in combinations(range(k), keys)])
    posts = told.withColumn("key", F.explode(key))
    hot = posts.groupBy("key").count().filter(F.col("count") > block_rows).select(
        F.col("key").alias("hk"), F.ceil(F.col("count") / block_rows).cast("int").alias("c"))
    c = F.coalesce(F.col("c"), F.lit(1))
    dealt = (posts.join(hot, F.col("key") == F.col("hk"), "left")
             .select("key", "cid", "vec", "n", "near", c.alias("c"), F.pmod(F.xxhash64("cid"), c).cast("int").alias("o"))
             .select("key", "cid", "vec", "n", "near", "o", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("p"))
             .select("key", F.least("o", "p").alias("a"), F.greatest("o", "p").alias("b"), "cid", "vec", "n", "near",
                     "o"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(parts, "key", "a", "b").sortWithinPartitions("key", "a", "b")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_keys(batches, ["key", "a", "b"]):
            ka, a, b = (t.column(x).to_numpy() for x in ("key", "a", "b"))
            edge = np.flatnonzero(np.r_[True, (np.diff(ka) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0), True])
            for s, e in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                if e - s < 2:
                    continue
                part = t.slice(s, e - s)
                cid, side = part.column("cid").to_numpy(), part.column("o").to_numpy()
                near = part.column("near").combine_chunks().flatten().to_numpy().reshape(-1, k)
                own = [int(ka[s]) // MAX_PIVOTS ** x % MAX_PIVOTS for x in range(keys)]
                links, lab = block_links(_matrix(part.column("vec"), dim), near, part.column("n").to_numpy(),
                                         None if a[s] == b[s] else side == a[s], own, count, need, threshold)
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([pa.array(cid[hit]), pa.array(links[hit]), pa.array(cid[lab[hit]])],
                                                 names=["cid", "links", "root"])
    return dealt.mapInArrow(link, "cid long, links long, root long")


def embedding_components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                         threshold: float = 0.9, nearest: int = 10, shared: int = 2, key_pivots: int = 1,
                         block_rows: int = 2048, pivots: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    scratch = Scratch(vectors.sparkSession)
    v = F.col("vec")
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    fine = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec")).select(
        "vec_id", "vec", F.coalesce(fine, F.lit(False)).alias("fine"),
        F.xxhash64("vec").alias("h1"), F.xxhash64(F.lit(1), "vec").alias("h2"))  # 128 bits: equal vectors
    good = rows.filter("fine")
    classes = cut(good.groupBy("h1", "h2").agg(F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"),
                                               F.min("vec_id").alias("least"))
                  .withColumn("cid", F.monotonically_increasing_id()))
    told = None
    for r in classes.groupBy(F.size("vec").alias("dim")).count().collect():  # one row a vector length
        one = _index(classes.filter(F.size("vec") == r["dim"]), r["dim"], r["count"], threshold, nearest, shared,
                     key_pivots, block_rows, pivots, scratch)
        told = one if told is None else told.unionByName(one)
    if told is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    told = cut(told)
    scratch.close()
    links = told.groupBy("cid").agg(F.sum("links").alias("links"))
    comp = components(told.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    by = (classes.select("h1", "h2", "cid", "n", "least").join(links, "cid", "left")
          .join(comp, F.col("cid") == F.col("node"), "left")
          .select("h1", "h2", "least", F.coalesce("comp", "cid").alias("comp"),
                  (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    of = by.groupBy("comp").agg(F.min("least").alias("component_id"))
    by = by.join(of, "comp").select("h1", "h2", "n_links", "component_id")
    linked = good.select("vec_id", "h1", "h2").join(by, ["h1", "h2"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter("not fine").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                           F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_components(table(spark, sf_dir, "embeddings"))


ORACLE_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(id, r) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT reach.id, link.b FROM reach JOIN link ON reach.r = link.a),
comp AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0) AS n_links, comp.component_id, e.vec_id = comp.component_id AS kept
FROM embeddings e JOIN comp ON comp.id = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
