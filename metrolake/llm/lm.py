"""LM scoring by deleted interpolation (operator 10).

p(w | h) mixes the maximum-likelihood estimates of bigram, unigram and a
uniform unknown. The weights depend on a bucket of how often the context h
occurs, and are learned by expectation-maximisation on held-out counts: each
training occurrence is deleted in turn from the counts that predict it.

All n-gram counts are taken over all training documents, and no n-gram is
sent per document:

1. Each task turns its texts into blocks: word hashes, and the tokens as
   numbers of these words.
2. Each block asks for its distinct unigrams and bigrams, with its own training
   counts, packed by hash range; a range's shard adds up the counts of all
   blocks and answers each block with totals in the order asked.
3. Answers meet their block; one pass gathers a bounded histogram of
   deleted estimates for EM, a second one scores.

Bigrams are known by 56 hash bits, words by 64: of 10**9 distinct bigrams
about one in 10**8 would share its count with another.

Cases: null or empty text is one end token; null ids neither train nor are
held out; repeated rows each train and each come back; without training text
the model is uniform over nothing known and every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, cut, table, text_bytes, whole_keys
from metrolake.llm.langid import fold

#: What a task holds at once. Packets between blocks and shards number tokens**2 / (one * other): for corpora
#: far over 100 GB raise both with the executors' memory.
BLOCK_TOKENS = 1_000_000
SHARD_TOKENS = 1_200_000
#: Words hold no white space, so these are no words.
END, START = b" ", b"  "
PAIR_BITS = 56
STEPS, ZERO = 4, 200  # histogram: quarter powers of two down to 2**-50; bin of probability zero
BUCKETS = 40
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as zstd-compressed byte planes of the width that the largest needs."""
    v = np.ascontiguousarray(values, "<u8")
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    planes = v.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return (len(v).to_bytes(4, "little") + bytes([width])
            + zstandard.ZstdCompressor(level=1, write_content_size=True).compress(planes))


def unpack(blob: bytes) -> np.ndarray:
    n, width = int.from_bytes(blob[:4], "little"), blob[4]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[5:]), np.uint8).reshape(width, n).T
    return out.view("<u8").ravel().astype(np.uint64)


def blocks(docs: DataFrame) -> DataFrame:
    """(block, doc, held, train, size, words, tokens) of ``docs(doc, held, train, t)``.

    ``size``: tokens of each document, start included; ``words``: sorted
    distinct word hashes; ``tokens``: places in it, each document from START to END.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no = TaskContext.get().partitionId(), 0
        rows, known, ids, total = [], {START: 0, END: 1}, [], 0

        def out() -> pa.RecordBatch:
            h = np.array([xxhash.xxh64_intdigest(w) for w in known], np.uint64)
            words, place = np.unique(h, return_inverse=True)
            cols = list(zip(*rows, strict=True))
            lists = [pa.array([list(c)], pa.list_(t)) for c, t in
                     zip(cols, (pa.int64(), pa.bool_(), pa.bool_(), pa.int32()), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([part * 1_000_000 + no]), *lists, pa.array([pack(np.diff(words, prepend=np.uint64(0)))]),
                 pa.array([pack(place[np.concatenate(ids)])]), pa.array([total])],
                names=["block", "doc", "held", "train", "size", "words", "tokens", "total"])

        for b in batches:
            for doc, held, train, text in zip(*(b.column(k).to_pylist() for k in range(3)),
                                              text_bytes(b.column(3)), strict=True):
                own = [0, *[known.setdefault(w, len(known)) for w in text.lower().split()], 1]
                rows.append((doc, held, train, len(own)))
                ids.append(np.array(own, np.int32))
                total += len(own)
                if total >= BLOCK_TOKENS:
                    yield out()
                    no += 1
                    rows, known, ids, total = [], {START: 0, END: 1}, [], 0
        if rows:
            yield out()
    return docs.mapInArrow(run, "block long, doc array<long>, held array<boolean>, train array<boolean>, "
                                "size array<int>, words binary, tokens binary, total long")


class Block:
    """A block's tokens: word and bigram of each predicted token, by place among the distinct ones."""

    def __init__(self, size: list[int], train: list[bool], words: bytes, tokens: bytes):
        self.words = np.cumsum(unpack(words), dtype=np.uint64)
        tok = unpack(tokens).astype(np.int64)
        size = np.array(size, np.int64)
        doc = np.repeat(np.arange(len(size)), size)
        goal = np.ones(len(tok), bool)
        goal[np.cumsum(size) - size] = False  # START is only a context
        at = np.flatnonzero(goal)
        self.word, self.ctx, self.doc = tok[at], tok[at - 1], doc[at]
        self.train = np.array(train, bool)[self.doc]
        h = self.words
        pair = ((h[self.ctx] ^ (h[self.word] >> np.uint64(29))) * _MIX + h[self.word] * np.uint64(0xD6E8FEB86659FD93))
        pair = (pair ^ (pair >> np.uint64(32))) * _MIX >> np.uint64(64 - PAIR_BITS)
        self.pairs, self.pair = np.unique(pair, return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the block's words and bigrams; START counts as often as it is a context."""
        one = np.bincount(self.word[self.train], minlength=len(self.words))
        start = int(np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(START))))
        end = int(np.searchsorted(self.words, np.uint64(xxhash.xxh64_intdigest(END))))
        one[start] = one[end]
        return one, np.bincount(self.pair[self.train], minlength=len(self.pairs))


def requests(made: DataFrame, bits: int) -> DataFrame:
    """(shard, block, four packed columns): what each block asks of each hash range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                x = Block(r["size"], r["train"], r["words"], r["tokens"])
                one, two = x.counts()
                edge = [np.searchsorted(v, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(w - bits))
                        for v, w in ((x.words, 64), (x.pairs, PAIR_BITS))]
                for s in range(1 << bits):
                    row = []
                    for v, n, e, w in ((x.words, one, edge[0], 64), (x.pairs, two, edge[1], PAIR_BITS)):
                        a, z = e[s - 1] if s else 0, e[s] if s < len(e) else len(v)
                        low = np.uint64(s << (w - bits))
                        row += [pack(np.diff(v[a:z], prepend=low)), pack(n[a:z])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([s], pa.int32()), pa.array([r["block"]]), *[pa.array([c]) for c in row]],
                        names=["shard", "block", "w", "wn", "p", "pn"])
    return made.select("block", "size", "train", "words", "tokens").mapInArrow(
        run, "shard int, block long, w binary, wn binary, p binary, pn binary")


def answers(asked: DataFrame, bits: int) -> DataFrame:
    """(shard, block, w, p, types, total): corpus counts in the order asked; types and total once a shard."""
    start = xxhash.xxh64_intdigest(START)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_keys(batches, ["shard"]):  # SHARD_TOKENS n-grams or so
            shards = t.column("shard").to_numpy()
            for s in np.unique(shards):
                rows = t.filter(pa.array(shards == s))
                got, types, total = [], 0, 0
                for name, width in (("w", 64), ("p", PAIR_BITS)):
                    low = np.uint64(int(s) << (width - bits))
                    keys = [np.cumsum(unpack(x), dtype=np.uint64) + low for x in rows.column(name).to_pylist()]
                    n = np.concatenate([unpack(x) for x in rows.column(name + "n").to_pylist()])
                    ends = np.cumsum([len(k) for k in keys])
                    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
                    sums = np.bincount(at, weights=n, minlength=len(distinct)).astype(np.uint64)
                    if name == "w":
                        own = sums[distinct != start]
                        types, total = int((own > 0).sum()), int(own.sum())
                    got.append([pack(x) for x in np.split(sums[at], ends[:-1])])
                k = rows.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(s)] * k, pa.int32()), rows.column("block").combine_chunks(), pa.array(got[0]),
                     pa.array(got[1]), pa.array([types] + [0] * (k - 1)), pa.array([total] + [0] * (k - 1))],
                    names=["shard", "block", "w", "p", "types", "total"])
    n = int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(
        run, "shard int, block long, w binary, p binary, types long, total long")


def _answered(made: DataFrame, said: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row, block, word counts, bigram counts)`` for each block with its answers."""
    none = [F.lit(None).cast(t).alias(c) for c, t in (
        ("doc", "array<long>"), ("held", "array<boolean>"), ("train", "array<boolean>"), ("size", "array<int>"))]
    a = said.select("block", "shard", *none, F.col("w").alias("words"), F.col("p").alias("tokens"))
    m = made.select("block", F.lit(1 << 30).alias("shard"), "doc", "held", "train", "size", "words", "tokens")
    n = int(made.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = a.unionByName(m).repartition(n, "block").sortWithinPartitions("block", "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = [], []
        for b in batches:
            for k in range(b.num_rows):
                r = b.slice(k, 1).to_pylist()[0]
                if r["size"] is None:
                    one.append(unpack(r["words"]))
                    two.append(unpack(r["tokens"]))
                    continue
                x = Block(r["size"], r["train"], r["words"], r["tokens"])
                yield fn(r, x, np.concatenate(one).astype(np.int64), np.concatenate(two).astype(np.int64))
                one, two = [], []
    return dealt.mapInArrow(run, schema)


def _bucket(n: np.ndarray) -> np.ndarray:
    """Context-frequency bucket: bit length of the count."""
    return np.where(n > 0, np.floor(np.log2(np.maximum(n, 1))).astype(np.int64) + 1, 0)


def _bin(p: np.ndarray) -> np.ndarray:
    return np.where(p > 0, np.minimum(ZERO - 1, (-np.log2(np.maximum(p, 1e-300)) * STEPS).astype(np.int64)), ZERO)


def _histogram(tokens: int):
    def fn(r, x: Block, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
        m = x.train
        ctx, w, pair = one[x.ctx[m]] - 1, one[x.word[m]] - 1, two[x.pair[m]] - 1
        p2 = np.where(ctx > 0, pair / np.maximum(ctx, 1), 0.0)
        p1 = w / max(1, tokens - 1)
        key = (_bucket(ctx) * (ZERO + 1) + _bin(p2)) * (ZERO + 1) + _bin(p1)
        key, n = np.unique(key, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])
    return fn


def mixture(key: np.ndarray, n: np.ndarray, unknown: float, rounds: int = 60) -> np.ndarray:
    """Weights (bigram, unigram, unknown) of each context bucket by EM on a histogram of deleted estimates."""
    grid = np.r_[2.0 ** (-(np.arange(ZERO) + 0.5) / STEPS), 0.0]
    b, p2, p1 = key // (ZERO + 1) ** 2, grid[key // (ZERO + 1) % (ZERO + 1)], grid[key % (ZERO + 1)]
    p = np.stack([p2, p1, np.full(len(key), unknown)], axis=1)
    lam = np.full((BUCKETS, 3), 1 / 3)
    lam[0] = (0, 0.5, 0.5)  # a context never seen tells nothing
    prior = (lam > 0) * 0.01
    for _ in range(rounds):
        part = lam[b] * p
        part *= (n / part.sum(axis=1))[:, None]
        new = prior.copy()
        np.add.at(new, b, part)
        lam = new / new.sum(axis=1, keepdims=True)
    return lam


def _score(lam: np.ndarray, tokens: int, types: int):
    def fn(r, x: Block, one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
        docs = len(r["size"])
        ctx, w, pair = one[x.ctx], one[x.word], two[x.pair]
        l2, l1, l0 = lam[_bucket(ctx)].T
        p = l2 * pair / np.maximum(ctx, 1) + l1 * w / max(1, tokens) + l0 / (types + 1)
        base = (w + 0.1) / (tokens + 0.1 * (types + 1))
        total = lambda v: np.bincount(x.doc, v, docs)
        return pa.RecordBatch.from_arrays(
            [pa.array(r["doc"], pa.int64()), pa.array(r["held"], pa.bool_()), pa.array(np.array(r["size"], np.int64) - 1),
             pa.array(total(w > 0).astype(np.int64)), pa.array([tokens] * docs, pa.int64()),
             pa.array(total(np.log10(base))), pa.array(total(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return fn


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row.

    Learns from the documents whose CRC-32 of the id (as text) modulo
    ``folds`` is not 0. Scores are log10 probabilities.
    """
    scratch = Scratch(docs.sparkSession)
    f = fold(id_col, folds)
    own = docs.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(f == 0, F.lit(False)).alias("held"),
                      F.coalesce(f != 0, F.lit(False)).alias("train"), F.col(text_col).cast("string").alias("t"))
    made, blocks_at = scratch.save(blocks(own), "blocks")
    size = made.agg(F.sum("total")).first()[0] or 0
    bits = max(1, (-(-size // SHARD_TOKENS) - 1).bit_length()) if size else 1
    said, answers_at = scratch.save(answers(requests(made, bits), bits), "answers")
    types, tokens = said.agg(F.sum("types"), F.sum("total")).first()
    types, tokens = types or 0, tokens or 0
    lam = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    if tokens:
        # BUCKETS * (ZERO + 1) ** 2 rows at most, whatever the corpus.
        rows = (_answered(made, said, _histogram(tokens), "key long, n long").groupBy("key")
                .agg(F.sum("n").alias("n")).toPandas())
        lam = mixture(rows["key"].to_numpy(), rows["n"].to_numpy(np.float64), 1 / (types + 1))
    out = cut(_answered(made, said, _score(lam, tokens, types),
                        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                        "base_score double, score double"))
    scratch.drop(blocks_at)
    scratch.drop(answers_at)
    return out


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))
