"""Helpers shared by the training-data operators: lineage cuts, row packing,
connected components and distributed running totals."""

from __future__ import annotations

import atexit
import contextlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolake.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise a small frame in the cluster's checkpoint folder and forget its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Parquet tables in the shared folder named by ``spark.checkpoint.dir``.

    For wide intermediate tables that are read more than once. ``drop``
    removes a table as soon as nothing needs it; whatever a returned frame
    still reads goes when the driver process ends.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = ensure_checkpoint_dir(spark).rstrip("/") + f"/llm-{uuid.uuid4().hex}"
        self.n = 0
        atexit.register(self.close)

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def save(self, df: DataFrame, tag: str) -> tuple[DataFrame, str]:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{tag}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def drop(self, path: str) -> None:
        self._delete(path)

    def close(self) -> None:
        with contextlib.suppress(Exception):  # the session may be gone at exit
            self._delete(self.root)


def short_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Send texts to Python in batches of ``rows`` at most: a few MB, not tens, in each worker of an executor."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_bytes(col: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in col.cast(pa.binary()).to_pylist()]


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema) -> DataFrame:
    """``fn`` over every Arrow batch; a batch for which it returns None adds no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def whole_keys(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``keys`` so that no key is cut between two tables.

    Only the rows of the last key are held back, so memory follows the
    largest key; callers bound that by their choice of key.
    """
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        first, last = ([b.column(k)[i].as_py() for k in keys] for i in (0, -1))
        if first == last and (len(held) == 1 or [held[0].column(k)[0].as_py() for k in keys] == first):
            continue  # still one key
        t = pa.Table.from_batches(held)
        same = np.ones(t.num_rows, bool)
        for k, v in zip(keys, last, strict=True):
            same &= t.column(k).to_numpy() == v
        cut_at = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if cut_at:
            yield t.slice(0, cut_at).combine_chunks()
        held = t.slice(cut_at).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def pack_counts(rows: np.ndarray, grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Distinct grams of a block in ascending order, how many rows hold each, which (16 bits), and how often."""
    first = np.flatnonzero(np.diff(grams, prepend=-1))
    parts = [np.diff(np.r_[0, grams[first]]).astype("<u8"), np.diff(np.r_[first, len(grams)]).astype("<u4"),
             rows.astype("<u2"), counts.astype("<u4")]
    head = np.array([len(first), len(grams)], "<u4").tobytes()
    # Byte planes: the high bytes are mostly zero.
    body = b"".join(p.view(np.uint8).reshape(len(p), p.itemsize).T.tobytes() for p in parts)
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def unpack_counts(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(grams, rows of each, row numbers, counts) of a packet."""
    n, m = np.frombuffer(blob[:8], "<u4").tolist()
    body, at, out = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[8:]), np.uint8), 0, []
    for size, kind in ((n, "<u8"), (n, "<u4"), (m, "<u2"), (m, "<u4")):
        w = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(body[at:at + size * w].reshape(w, size).T).view(kind).ravel().astype(np.int64))
        at += size * w
    return np.cumsum(out[0]), out[1], out[2], out[3]


def deal(packets: DataFrame, model: DataFrame) -> DataFrame:
    """``packets(shard, block, ...)`` next to their shard's ``model``: it comes first, with null in the other columns.

    A model shard goes once to each of a few lanes and the packets are dealt over them, so no shard's packets
    gather in one task.
    """
    n = int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = model.count()
    lanes = max(1, -(-n // max(1, shards)))
    kind = model.schema["model"].dataType
    null = [F.lit(None).cast(f.dataType).alias(f.name) for f in packets.schema.fields if f.name not in ("shard", "block")]
    m = model.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long"))).alias("lane"),
                     F.lit(-1).cast("long").alias("block"), *null, "model")
    p = packets.select("shard", F.pmod("block", F.lit(lanes)).alias("lane"), *packets.columns[1:],
                       F.lit(None).cast(kind).alias("model"))
    return m.unionByName(p).repartition(n, "shard", "lane").sortWithinPartitions("shard", "lane", "block")


def forest(n: int, i: np.ndarray, j: np.ndarray, lab: np.ndarray | None = None) -> np.ndarray:
    """Component label (smallest member) of nodes 0..n-1 under links i-j; ``lab`` continues earlier labels."""
    lab = np.arange(n) if lab is None else lab
    while True:
        a, b = lab[i], lab[j]
        m = a != b
        if not m.any():
            return lab
        i, j, a, b = i[m], j[m], a[m], b[m]
        np.minimum.at(lab, np.maximum(a, b), np.minimum(a, b))
        while True:
            nxt = lab[lab]
            if (nxt == lab).all():
                break
            lab = nxt


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs) as ``(node, comp)``, comp the smallest node.

    Alternating large-star and small-star rounds, one checkpoint a round. A
    round keeps at most one edge a node beside the stars' hubs, never all
    pairs of a component; minima are pre-aggregated before they are
    shuffled, and a hub's join partition is split by AQE's skew join.
    Nodes without edges are not returned.
    """
    e = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(max_rounds):
        # Large star: every neighbour larger than u moves to the least of u's neighbourhood.
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = (both.filter("b > a").join(low, F.col("a") == F.col("u"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # Small star: every smaller neighbour of u, and u, move to the least of them.
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        j = large.join(low, F.col("a") == F.col("u"))
        small = (j.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
                 .filter("a <> b").distinct())
        e = cut(small)
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("comp")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct())


def running_total(df: DataFrame, part: list[str], order: list[Column], weight: Column,
                  name: str, rows_per_bucket: int = 20_000, lead: Column | None = None) -> DataFrame:
    """Add ``name``: the sum of ``weight`` over the rows before this one inside ``part``.

    Rows are first cut into hash buckets of about ``rows_per_bucket`` rows; the
    order is (``lead``, a small class; bucket; ``order``). Only a bucket is ever
    sorted in one task; a part's bucket totals (one row a bucket) give the
    offsets. So a part may hold any share of all rows. ``df`` is read twice
    and must not change between reads: give a materialised frame.
    """
    n = df.count()
    buckets = max(1, -(-n // rows_per_bucket))
    bucket = F.pmod(F.xxhash64(*order), F.lit(buckets))
    if lead is not None:
        bucket = lead.cast("long") * buckets + bucket
    d = df.withColumn("_bk", bucket.cast("long")).withColumn("_wt", weight.cast("long"))
    w = Window.partitionBy(*part, "_bk").orderBy(*order)
    inner = F.sum("_wt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_wt")
    tot = d.groupBy(*part, "_bk").agg(F.sum("_wt").alias("_tot"))
    before = Window.partitionBy(*part).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(*[F.col(p).alias(f"_o_{p}") for p in part], F.col("_bk").alias("_o_bk"),
                     F.coalesce(F.sum("_tot").over(before), F.lit(0)).alias("_off"))
    on = [F.col(p).eqNullSafe(F.col(f"_o_{p}")) for p in part] + [F.col("_bk") == F.col("_o_bk")]
    out = d.withColumn("_in", inner).join(off, on)
    return out.withColumn(name, F.col("_in") + F.col("_off")).drop(
        "_bk", "_wt", "_in", "_off", "_o_bk", *[f"_o_{p}" for p in part])
