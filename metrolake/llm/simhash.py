"""SimHash near-dedup (operator 8).

Fingerprints are 64-bit votes over word shingles. The distinct fingerprints
are linked at ``max_bits`` or fewer differing bits with a Gray-order
hierarchical index:

1. Of ``segments`` bit segments, two linked fingerprints agree on at least
   ``segments - max_bits``; every choice of that many segments is a table and
   the bits in them a key, so linked fingerprints share a key in some table.
2. The rows of a key are sorted by Gray rank, which puts words with long shared
   bit patterns side by side. Leaves of 16 words, and nodes of 16 children
   above them, keep the bits that all their words share (mask and value).
3. A key's words are joined with themselves from the top node down. A pair of
   nodes accumulates the differences on newly shared bits only; it is dropped
   with all its words beyond ``max_bits``, and linked without looking inside
   when even all unshared bits together stay within ``max_bits``.

A key of more than ``block_rows`` words is cut into blocks by hash, and every
pair of its blocks is one piece of work. A piece returns a spanning forest of
its links, at most one edge a word, so a group of n near copies never becomes
n * n rows. Exact copies are one fingerprint from the start.

Cases: null or empty text, or one without a word: fingerprint zero, linked
like any other; null ids get a fingerprint, and a component whose ids are all
null has a null id; repeated rows each come back; empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import components, cut, forest, table, text_bytes, whole_keys

SEED = 42
FAN = 16
PIECE = 1 << 20


def fingerprint(text: bytes, shingle: int, seed: int = SEED) -> int:
    """64-bit SimHash of the lower-cased (A-Z) text's word shingles, as a signed long."""
    words = text.lower().split()  # bytes: A-Z only, and white space is \x20 \x09-\x0D
    n = len(words)
    if not n:
        return 0
    whole = b" ".join(words)
    if n <= shingle:
        h = np.array([xxhash.xxh64_intdigest(whole, seed)], np.uint64)
        return int(h.view(np.int64)[0])
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    m = n - shingle + 1
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, m, PIECE):  # a very long text in pieces
        a, b = starts[k:min(m, k + PIECE)].tolist(), (ends[k + shingle - 1:min(m, k + PIECE) + shingle - 1] - 1).tolist()
        h = np.array([digest(whole[x:y], seed) for x, y in zip(a, b, strict=True)], ">u8")
        # 255 rows of 0/1 bytes add up without carrying into the next byte.
        bits = np.unpackbits(h.view(np.uint8)).reshape(-1, 64)
        pad = -len(bits) % 255
        if pad:
            bits = np.concatenate((bits, np.zeros((pad, 64), np.uint8)))
        lanes = bits.view(np.uint64).reshape(-1, 255, 8).sum(axis=1, dtype=np.uint64)
        votes += lanes.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > m).view(">u8").astype(np.uint64).view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, h, fp) for every row; h is the hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = pa.array([fingerprint(t, shingle) for t in text_bytes(b.column(1))], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), fp], names=["doc_id", "h", "fp"])
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"),
                        text_hash(text_col).alias("h"))
            .mapInArrow(run, "doc_id long, h long, fp long"))


def text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _gray_rank(x):
    """Rank of a code word in Gray order: each bit is the parity of the bits from the top down to it."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, s))
    return x


class _Level:
    """Nodes of one level: shared mask and value, and where their children start."""

    def __init__(self, key: np.ndarray, all_and: np.ndarray, all_or: np.ndarray):
        """``key``: group of each child, ascending; a node takes FAN children of one group at most."""
        n = len(key)
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        at = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
        self.first = np.flatnonzero(at % FAN == 0)
        self.size = np.diff(np.r_[self.first, n])
        self.key = key[self.first]
        self.all_and = np.bitwise_and.reduceat(all_and, self.first)
        self.all_or = np.bitwise_or.reduceat(all_or, self.first)
        self.mask = ~(self.all_and ^ self.all_or)
        self.value = self.all_and & self.mask


def _spread(i, j, child_first, child_size):
    """All child pairs of the node pairs (i, j); of a node with itself each pair once."""
    ni, nj = child_size[i], child_size[j]
    total = ni * nj
    of = np.repeat(np.arange(len(i)), total)
    at = np.arange(len(of)) - np.repeat(np.cumsum(total) - total, total)
    a, b = child_first[i[of]] + at // nj[of], child_first[j[of]] + at % nj[of]
    ok = (i[of] != j[of]) | (a <= b)
    return of[ok], a[ok], b[ok]


def links_forest(key: np.ndarray, fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Component label of each word under links at ``max_bits`` inside equal keys.

    ``key`` ascending, and words in Gray order inside a key.
    """
    n = len(fp)
    lab = np.arange(n)
    levels = [_Level(key, fp, fp)]
    while len(levels[-1].key) > len(np.unique(levels[-1].key)):
        up = levels[-1]
        levels.append(_Level(up.key, up.all_and, up.all_or))
    top = levels[-1]
    word_first = [levels[0].first]  # first word under each node, by level
    for up in levels[1:]:
        word_first.append(word_first[-1][up.first])
    node = np.arange(len(top.key))
    # (level, i, j, differences so far, bits they were counted on)
    todo = [(len(levels) - 1, node, node, np.zeros(len(node), np.int64), np.zeros(len(node), np.uint64))]
    while todo:
        depth, i, j, diff, on = todo.pop()
        if len(i) > PIECE // FAN:  # bounded memory: go down half by half
            h = len(i) // 2
            todo += [(depth, i[:h], j[:h], diff[:h], on[:h]), (depth, i[h:], j[h:], diff[h:], on[h:])]
            continue
        lv = levels[depth]
        shared = lv.mask[i] & lv.mask[j]
        diff = diff + np.bitwise_count((lv.value[i] ^ lv.value[j]) & shared & ~on)
        alive = diff <= max_bits
        free = np.bitwise_count(~shared)
        sure = alive & (diff + free <= max_bits)
        if sure.any():
            lab = _link_nodes(lab, word_first[depth], n, i[sure], j[sure])
        alive &= ~sure
        i, j, diff, shared = i[alive], j[alive], diff[alive], shared[alive]
        if not len(i):
            continue
        of, a, b = _spread(i, j, lv.first, lv.size)
        if depth:
            todo.append((depth - 1, a, b, diff[of], shared[of]))
            continue
        apart = a != b
        a, b = a[apart], b[apart]
        far = np.bitwise_count(fp[a] ^ fp[b]) <= max_bits
        lab = forest(n, a[far], b[far], lab)
    return lab


def _link_nodes(lab, first, n, i, j):
    """Link all words under nodes i and j with each other (a chain is enough)."""
    last = np.r_[first[1:], n]
    size = last[i] - first[i] + last[j] - first[j]
    hub = np.repeat(first[i], size)
    at = np.arange(len(hub)) - np.repeat(np.cumsum(size) - size, size)
    own = np.repeat(last[i] - first[i], size)
    word = np.where(at < own, hub + at, np.repeat(first[j], size) + at - own)
    return forest(n, hub, word, lab)


def fingerprint_links(fps: DataFrame, max_bits: int, segments: int, block_rows: int) -> DataFrame:
    """Spanning forests ``(a, b)`` of the links between the distinct fingerprints of ``fps(fp)``."""
    if not max_bits < segments <= 64:
        raise ValueError("segments must be over max_bits")
    edge = [round(64 * s / segments) for s in range(segments + 1)]
    masks = [sum(((1 << (edge[s + 1] - edge[s])) - 1) << (64 - edge[s + 1]) for s in c)
             for c in combinations(range(segments), segments - max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    rows = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("t", "k"))
    # Keys too large for one block: cut by hash into c blocks, and the word goes to each pair with its own.
    hot = rows.groupBy("t", "k").count().filter(F.col("count") > block_rows).select(
        F.col("t").alias("ht"), F.col("k").alias("hk"), F.ceil(F.col("count") / block_rows).cast("int").alias("c"))
    j = rows.join(hot, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left")
    c = F.coalesce(F.col("c"), F.lit(1))
    own = F.pmod(F.xxhash64("fp"), c).cast("int")
    pairs = (j.select("fp", "t", "k", c.alias("c"), own.alias("o"))
             .select("fp", "t", "k", "o", F.explode(F.sequence(F.lit(0), F.col("c") - 1)).alias("p"))
             .select(F.xxhash64("t", "k", F.least("o", "p"), F.greatest("o", "p")).alias("piece"),
                     _gray_rank(F.col("fp")).alias("rank"), "fp"))
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(n, "piece").sortWithinPartitions("piece", "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_keys(batches, ["piece"]):
            fp = t.column("fp").to_numpy()
            lab = links_forest(t.column("piece").to_numpy(), fp.view(np.uint64), max_bits)
            i = np.flatnonzero(lab != np.arange(len(lab)))
            yield pa.RecordBatch.from_arrays([pa.array(fp[i]), pa.array(fp[lab[i]])], names=["a", "b"])
    return dealt.mapInArrow(run, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       max_bits: int = 4, segments: int | None = None, block_rows: int = 4096) -> DataFrame:
    """(doc_id, h, fp, component_id) for every row: the fingerprint and the smallest id reachable by links.

    ``segments`` defaults to ``max_bits + 1`` (five tables for four bits);
    more segments give more, finer keys, and the same links.
    """
    own = cut(fingerprints(docs, id_col, text_col, shingle))
    edges = fingerprint_links(own.select("fp").distinct(), max_bits, segments or max_bits + 1, block_rows)
    comp = components(edges).select(F.col("node").alias("n"), "comp")
    return _label(own, comp)


def _label(own: DataFrame, comp: DataFrame) -> DataFrame:
    least = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    fps = least.join(comp, F.col("fp") == F.col("n"), "left").select(
        "fp", "least", F.coalesce("comp", "fp").alias("comp"))
    of = fps.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_fp = fps.join(of, "comp").select("fp", "component_id")
    return own.join(by_fp, "fp").select("doc_id", "h", "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of each component, same columns: that of the least id, of equal ids that of the least text hash.

    Null ids come last, so a component of null ids keeps one row as well.
    """
    c = simhash_components(docs, id_col, text_col, **params)
    none = F.lit(1 << 62).cast("long")
    group = F.coalesce(F.col("component_id"), F.col("fp"))  # without an id: equal fingerprints
    best = (c.groupBy(F.col("component_id").isNull(), group)
            .agg(F.min(F.struct(F.coalesce("doc_id", none).alias("i"), F.col("h"))).alias("b"))
            .select(F.col("b.i").alias("__bi"), F.col("b.h").alias("__bh")))
    own = docs.select(*[F.col(x) for x in docs.columns], F.coalesce(F.col(id_col).cast("long"), none).alias("__i"),
                      text_hash(text_col).alias("__h"))
    kept = own.join(best, (F.col("__i") == F.col("__bi")) & (F.col("__h") == F.col("__bh")), "left_semi")
    return kept.dropDuplicates(["__i", "__h"]).select(*docs.columns)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_components(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
