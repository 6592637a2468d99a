"""Byte-level BPE encoding and decoding (operator 6).

A batch's texts are cut into pieces by the tokenizer's pattern. Distinct
pieces are encoded together: they are bucketed by length into padded numpy
matrices, one piece a row, and each round merges every row's leftmost pair of
least rank. Ranks of pairs come from an open-addressing hash table; a merge
deletes one cell a row, which compacts the matrix by one column, and finished
rows leave it. Pieces over ``MAX_ROW`` bytes (a run of one letter, say) would
need as many rounds as bytes; they are merged one by one from a heap, in the
same order.

Cases: null or empty text has no tokens and decodes to no bytes; null ids
decode to no bytes; repeated rows each come back; special-token strings are
ordinary text.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import short_batches, table

MAX_ROW = 256
CELLS = 1 << 19
CACHE = 100_000
PART = 1 << 20
NONE = np.int32(2**31 - 1)
MULT = np.uint64(0x9E3779B97F4A7C15)
#: White space as Unicode's White_Space property has it, and letters of ASCII to Latin Extended-B.
_WS = "\\t-\\r \x85\xa0  -     　"
_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-ɏ"


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by id, from a file of base64 token and rank per line."""
    with open(path, "rb") as f:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, f)}
    if sorted(ranks) != list(range(len(ranks))) or len(ranks) > 1 << 20:
        raise ValueError("ranks must be 0 to n-1, of a vocabulary below 2**20")
    return [ranks[i] for i in range(len(ranks))]


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * MULT) >> np.uint64(64 - bits)).astype(np.int64)


class Merges:
    """Pair ranks of one vocabulary in an open-addressing hash table."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        self.tokens, self.ids = tokens, ids
        self.byte = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        pairs = [(ids[t[:k]], ids[t[k:]], r) for r, t in enumerate(tokens) for k in range(1, len(t))
                 if t[:k] in ids and t[k:] in ids]
        a, b, r = np.array(pairs, np.int64).reshape(-1, 3).T
        self.bits = max(4, int(len(a) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.rank = np.full(1 << self.bits, NONE, np.int32)
        key, at = (a << 32) | b, None
        at = _slot(key, self.bits)
        left = np.arange(len(key))
        while len(left):  # of rows that want one free slot the first gets it, the others go on by one
            free = self.keys[at[left]] < 0
            rows = left[free]
            _, one = np.unique(at[rows], return_index=True)
            won = rows[one]
            self.keys[at[won]], self.rank[at[won]] = key[won], r[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs; NONE where there is none or one side is padding (-1)."""
        out = np.full(a.shape, NONE, np.int32)
        ok = np.flatnonzero(((a >= 0) & (b >= 0)).ravel())
        key = (a.ravel()[ok].astype(np.int64) << 32) | b.ravel()[ok]
        at, flat = _slot(key, self.bits), out.ravel()
        while len(ok):
            found = self.keys[at]
            hit = found == key
            flat[ok[hit]] = self.rank[at[hit]]
            go = ~hit & (found >= 0)
            ok, key, at = ok[go], key[go], (at[go] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(a.shape)

    def matrix(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of pieces of up to MAX_ROW bytes, as one padded matrix."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = int(size.max())
        m = np.full((len(pieces), width), -1, np.int32)
        m[np.arange(width) < size[:, None]] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.lookup(m[:, :-1], m[:, 1:])
        rows, out = np.arange(len(pieces)), [None] * len(pieces)
        while True:
            best = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(m), np.int64)  # the leftmost minimum
            at = np.arange(len(m))
            least = rank[at, best] if rank.shape[1] else np.full(len(m), NONE)
            done = least == NONE
            if done.any():
                for i, row, n in zip(rows[done].tolist(), m[done], (m[done] >= 0).sum(axis=1).tolist(), strict=True):
                    out[i] = row[:n].tolist()
                go = ~done
                if not go.any():
                    return out
                m, rank, rows, best, least = m[go], rank[go], rows[go], best[go], least[go]
                at = np.arange(len(m))
            m[at, best] = least
            keep = np.ones(m.shape, bool)
            keep[at, best + 1] = False
            m = m[keep].reshape(len(m), -1)
            keep = np.ones(rank.shape, bool)
            keep[at, best] = False
            rank = rank[keep].reshape(len(m), -1)
            if rank.shape[1]:
                right = best < rank.shape[1]
                rank[at[right], best[right]] = self.lookup(m[at[right], best[right]], m[at[right], best[right] + 1])
                left = best > 0
                rank[at[left], best[left] - 1] = self.lookup(m[at[left], best[left] - 1], m[at[left], best[left]])

    def long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece: a heap of (rank, place) over linked tokens."""
        tok = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n, raw, ids = len(tok), self.tokens, self.ids
        prev, nxt, size = list(range(-1, n - 1)), list(range(1, n + 1)), [1] * n
        pair = lambda i: ids.get(raw[tok[i]] + raw[tok[nxt[i]]]) if nxt[i] < n else None
        heap = [(r, i) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not size[i] or pair(i) != r:
                continue
            j = nxt[i]
            tok[i], size[j], nxt[i] = r, 0, nxt[j]
            if nxt[i] < n:
                prev[nxt[i]] = i
            for k in (prev[i], i):
                if k >= 0 and (q := pair(k)) is not None:
                    heapq.heappush(heap, (q, k))
        return [t for t, s in zip(tok, size, strict=True) if s]

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        out: list = [None] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if (whole := self.ids.get(p)) is not None:
                out[i] = [whole]
            elif len(p) > MAX_ROW:
                out[i] = self.long(p)
            else:
                buckets.setdefault((len(p) - 1).bit_length(), []).append(i)
        for width, rows in buckets.items():
            step = max(1, CELLS >> width)
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                for i, ids in zip(part, self.matrix([pieces[i] for i in part]), strict=True):
                    out[i] = ids
        return out


def splitter(pattern: str):
    """findall of ``pattern``; texts of ASCII and Latin letters alone take an equal, faster one."""
    import re

    full = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
    if pattern != public_tokenizers.PATTERN:
        return full.findall
    fast = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^{_WS}0-9{_LATIN}]+"
                      rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+")
    other = re.compile(rf"[^\x00-\x7f{_LATIN[6:]}]")
    return lambda t: (full if other.search(t) else fast).findall(t)


def _parts(texts: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch in runs of about PART characters, so that only a run's pieces are held at once."""
    run, size = [], 0
    for t in texts:
        t = t.as_py()
        run.append(t)
        size += len(t or "")
        if size >= PART:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "token_ids", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``docs`` plus ``ids_col``: the text's token ids (array of int). ``path``: a file of ranks."""
    tokens = load_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    shared = docs.sparkSession.sparkContext.broadcast(tokens)  # a vocabulary file, below 2**20 tokens
    short_batches(docs.sparkSession)
    out = docs.drop(ids_col)
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges, cut, cache = Merges(shared.value), splitter(pattern), {}
        for b in batches:
            ids = []
            for part in _parts(b.column(text_col)):
                texts = [cut(t) if t else [] for t in part]
                if len(cache) > CACHE:
                    cache.clear()
                new = list(set().union(*texts).difference(cache))
                cache.update(zip(new, merges.encode([p.encode() for p in new]), strict=True))
                ids += [np.fromiter(chain.from_iterable(map(cache.__getitem__, t)), np.int32) for t in texts]
            ends = np.cumsum([0, *map(len, ids)])
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                names=[*names, ids_col])
    schema = out.withColumn(ids_col, F.lit(None).cast("array<int>")).schema
    return out.mapInArrow(run, schema)


def decode(docs: DataFrame, ids_col: str = "token_ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``docs`` plus ``out_col``: the bytes that the token ids stand for."""
    tokens = load_ranks(path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    shared = docs.sparkSession.sparkContext.broadcast(tokens)
    short_batches(docs.sparkSession)
    out = docs.drop(out_col)
    names = out.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for b in batches:
            raw = [b"".join(map(token, x.tolist())) if x is not None else b""
                   for x in (s.values.to_numpy() if s.is_valid else None for s in b.column(ids_col))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(raw, pa.binary())],
                                             names=[*names, out_col])
    return out.mapInArrow(run, out.withColumn(out_col, F.lit(None).cast("binary")).schema)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decode(encode(docs).drop("text"))
    return out.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.transform("token_ids", lambda i: i.cast("string")), ",").cast("binary"),
                             256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))
