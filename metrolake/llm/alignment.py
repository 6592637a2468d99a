"""Cross-tokenizer alignment (operator 12).

A text's tokens by two tokenizers are byte ranges over one string; offsets
where tokens of both end cut them into groups. The two arrays of ends are
walked with an index shift: as long as token i of A and token i + shift of B
end alike, exponential probing (1, 2, 4 ... ends compared at once, then
halving) jumps the whole one-to-one stretch. Where they part, the irregular
group is resolved locally, the end that lies behind moving on until both
agree, which updates the shift. The texts of a block are walked as one.

Links are the pairs of an A and a B token whose bytes overlap. A pair's count
is the number of documents that hold it linked: blocks of texts pack their
distinct pairs by shard (hash of the A id, so that all pairs of an A id are in
one shard), counts are summed from the packets, and the same packets are then
scored by their shard's counts. Each text is encoded once and never shuffled;
shards are bounded by the two vocabularies, not by the corpus, and a frequent
pair is one entry of a block.

A is a byte-level BPE in the tokenizers library's JSON. Where its merges are in
the order of their ids and its split is the usual one (checked on loading) the
same vocabulary runs as ranks in tiktoken, several times faster with equal ids
(compared at every code point); any other file is encoded by tokenizers itself.
B is a sentencepiece model with byte fallback.

Cases: null or empty texts, and texts whose joined tokens differ from space and
text (B may normalise), have no tokens; a null id is a document of its own;
repeated rows count as documents each; very long texts are a block of their
own; an empty table gives no rows; ``align`` replaces columns named like its own.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, cut, deal, pack_counts, short_batches, table, unpack_counts

SHARDS = 16
#: Characters of a block of texts (or one longer text), and texts of it: a row's number has 16 bits.
BLOCK_CHARS = 2 << 20
BLOCK_TEXTS = 60_000
#: A run of white space that long is left to the tokenizers library: its split has no backtracking.
LONG_GAP = " " * 2000


# ---- the two tokenizers -------------------------------------------------------

def byte_letters() -> dict[str, int]:
    """Letter of each byte in byte-level vocabularies: printable Latin-1 stands for itself, the rest from U+0100 up."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: ids of texts and the bytes of each id."""

    def __init__(self, spec: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_str(spec)
        self.own.encode_special_tokens = True  # their strings in a text are ordinary text
        d, letter = json.loads(spec), byte_letters()
        vocab = d["model"]["vocab"]
        special = {t["content"] for t in d.get("added_tokens", ())}
        raw = {t: bytes(letter[c] for c in t) for t in vocab if t not in special}
        self.bytes = [b""] * (max([*vocab.values(), *(t["id"] for t in d.get("added_tokens", ()))]) + 1)
        for t, b in raw.items():
            self.bytes[vocab[t]] = b
        merges = [m.split(" ") if isinstance(m, str) else m for m in d["model"]["merges"]]
        ids = [vocab["".join(m)] for m in merges]
        pre = d.get("pre_tokenizer") or {}
        plain = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
                 and not d.get("normalizer") and ids == sorted(ids) and len(ids) + 256 == len(raw))
        self.fast = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                      mergeable_ranks={b: vocab[t] for t, b in raw.items()}) if plain else None

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None and not any(LONG_GAP in t for t in texts):
            return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int64) for t in texts]
        return [np.asarray(e.ids, np.int64) for e in self.own.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """Tokenizer B."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.bytes = [bytes([int(self.own.id_to_piece(i)[3:-1], 16)]) if self.own.is_byte(i)
                      else self.own.id_to_piece(i).replace("▁", " ").encode() for i in range(self.own.vocab_size())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.asarray(x, np.int64) for x in self.own.encode(texts, num_threads=1)]


# ---- alignment ------------------------------------------------------------------

def group_sizes(ea: np.ndarray, eb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each group; ``ea``, ``eb``: their ends, ascending, with one last end."""
    ea, eb = ea.astype("<i8"), eb.astype("<i8")
    # Behind the last end no comparison holds.
    a, b, la, lb = ea.tobytes() + b"\xff" * 8, eb.tobytes() + b"\xfe" * 8, ea.tolist(), eb.tolist()
    n, m, i, j = len(la), len(lb), 0, 0
    stretch, pa_, qb = [], [], []  # one-to-one groups before each irregular one, and its tokens
    while i < n and j < m:
        x, y, w = 8 * i, 8 * j, 8
        while a[x:x + w] == b[y:y + w]:  # probe: 1, 2, 4 ... ends at the present shift
            x += w
            y += w
            w += w
        w >>= 1
        while w >= 8:  # the stretch ends within the last step
            if a[x:x + w] == b[y:y + w]:
                x += w
                y += w
            w >>= 1
        stretch.append(x // 8 - i)
        i, j = x // 8, y // 8
        if i == n or j == m:
            break
        u, v = i, j
        s, t = la[u], lb[v]
        while s != t:  # whoever ends first moves on
            if s < t:
                u += 1
                s = la[u]
            else:
                v += 1
                t = lb[v]
        pa_.append(u + 1 - i)
        qb.append(v + 1 - j)
        i, j = u + 1, v + 1
    k = np.array(stretch, np.int64)
    size_a = np.ones(int(k.sum()) + len(pa_), np.int64)
    size_b = size_a.copy()
    at = np.cumsum(k)[:len(pa_)] + np.arange(len(pa_))
    size_a[at], size_b[at] = pa_, qb
    return size_a, size_b


def linked_tokens(ea: np.ndarray, eb: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens of every link."""
    one = (size_a == 1) & (size_b == 1)
    ia, ib = (np.cumsum(size_a) - 1)[one], (np.cumsum(size_b) - 1)[one]
    ra, rb = np.flatnonzero(np.repeat(~one, size_a)), np.flatnonzero(np.repeat(~one, size_b))
    # In irregular groups each stretch between neighbouring ends is the overlap of one pair.
    ends = np.union1d(ea[ra], eb[rb])
    return (np.concatenate([ia, ra[np.searchsorted(ea[ra], ends)]]) if len(ends) else ia,
            np.concatenate([ib, rb[np.searchsorted(eb[rb], ends)]]) if len(ends) else ib)


class Block:
    """Some texts, encoded by both tokenizers and aligned as one sequence."""

    def __init__(self, a: ByteLevel, b: Pieces, texts: list[str | None]):
        use = [k for k, t in enumerate(texts) if t]
        spaced = [" " + texts[k] for k in use]
        ids = list(zip(use, spaced, a.encode(spaced), b.encode([texts[k] for k in use]), strict=True))
        same = lambda s, x, v: b"".join(map(v.bytes.__getitem__, x.tolist())) == s
        kept = [(k, x, y) for k, s, x, y in ids if same(raw := s.encode(), x, a) and same(raw, y, b)]
        none = np.zeros(0, np.int64)
        self.n = len(texts)
        self.n_a, self.n_b = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        for k, x, y in kept:
            self.n_a[k], self.n_b[k] = len(x), len(y)
        self.a = np.concatenate([none, *(x for _, x, _ in kept)])
        self.b = np.concatenate([none, *(y for *_, y in kept)])
        len_a, len_b = (np.fromiter(map(len, v.bytes), np.int64, len(v.bytes)) for v in (a, b))
        self.ea, self.eb = np.cumsum(len_a[self.a]), np.cumsum(len_b[self.b])
        self.size_a, self.size_b = group_sizes(self.ea, self.eb)
        last = np.cumsum(self.size_a)  # A tokens up to each group's end; texts end with groups
        self.n_groups = np.diff(np.searchsorted(last, np.cumsum(self.n_a), "right"), prepend=0)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, A id, B id) of every link."""
        ia, ib = linked_tokens(self.ea, self.eb, self.size_a, self.size_b)
        return np.repeat(np.arange(self.n), self.n_a)[ia], self.a[ia], self.b[ib]

    def group_texts(self) -> list[memoryview]:
        """Each text's groups as bytes ``a1,a2|b1;a3|b2,b3``."""
        # Elements in order (a group's A ids, then its B ids), the digits of each and the sign after it.
        na, nb = np.cumsum(self.size_a), np.cumsum(self.size_b)
        at_a = np.arange(len(self.a)) + np.repeat(nb - self.size_b, self.size_a)
        at_b = np.arange(len(self.b)) + np.repeat(na, self.size_b)
        n = len(self.a) + len(self.b)
        ids, sign = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[at_a], ids[at_b] = self.a, self.b
        if n:
            sign[at_a[na - 1]], sign[at_b[nb - 1]] = ord("|"), ord(";")
        # A row an element: its digits, the sign behind them, and what is cut off.
        most = int(ids.max(initial=0)) + 1
        width = len(str(most))
        table_ = np.zeros((most, width + 1), np.uint8)
        digits = np.ones(most, np.int64)
        for k in range(1, width):
            digits += np.arange(most) >= 10 ** k
        rest = np.arange(most)
        for k in range(width):
            go = np.flatnonzero(digits > k)
            table_[go, digits[go] - 1 - k] = 48 + rest[go] % 10
            rest //= 10
        cells, size = table_[ids], digits[ids]
        cells[np.arange(n), size] = sign
        out = cells[np.arange(width + 1) <= size[:, None]]
        end = np.cumsum(size + 1)
        # A text ends without the last semicolon.
        stop = np.concatenate([[0], end])[np.cumsum(self.n_a + self.n_b)]
        start, raw = np.concatenate([[0], stop[:-1]]), memoryview(out)
        return [raw[x:max(x, z - 1)] for x, z in zip(start.tolist(), stop.tolist(), strict=True)]


def _slices(texts: list[str | None]) -> Iterator[slice]:
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and (size + n > BLOCK_CHARS or i - at >= BLOCK_TEXTS):
            yield slice(at, i)
            at, size = i, 0
        size += n
    if at < len(texts):
        yield slice(at, len(texts))


def _vocabularies(spark: SparkSession, a_path: str | None, b_path: str | None):
    with open(a_path or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    with open(b_path or public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return spark.sparkContext.broadcast((spec, model))  # two vocabulary files of a few MB


def align(docs: DataFrame, text_col: str = "text", a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """``docs`` plus ``a_ids``, ``b_ids`` and, group by group, how many of each: ``a_sizes``, ``b_sizes``."""
    new = ["a_ids", "b_ids", "a_sizes", "b_sizes"]
    short_batches(docs.sparkSession)
    shared, own = _vocabularies(docs.sparkSession, a_path, b_path), docs.drop(*new)
    names = own.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(shared.value[0]), Pieces(shared.value[1])
        for batch in batches:
            texts = batch.column("t").to_pylist()
            for s in _slices(texts):
                x = Block(a, b, texts[s])
                lists = [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()),
                                                  pa.array(v, pa.int32()))
                         for n, v in ((x.n_a, x.a), (x.n_b, x.b), (x.n_groups, x.size_a), (x.n_groups, x.size_b))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(s.start, s.stop - s.start), *lists], names=["row", *new])
    inp = own.select(F.struct(*own.columns).alias("row"), F.col(text_col).cast("string").alias("t"))
    out = inp.mapInArrow(run, f"row {inp.schema['row'].dataType.simpleString()}, "
                         + ", ".join(f"{c} array<int>" for c in new))
    return out.select(*[F.col("row")[c].alias(c) for c in names], *new)


# ---- counts over the corpus --------------------------------------------------------

_META = {"doc": "long", "n_a": "long", "n_b": "long", "n_groups": "long", "sha": "string"}


def _packets(docs: DataFrame, id_col: str, text_col: str, shared) -> DataFrame:
    """(shard, block, body, and for shard 0 the block's documents): distinct pairs of a block by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = ByteLevel(shared.value[0]), Pieces(shared.value[1])
        part, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column("id"), batch.column("t").to_pylist()
            for s in _slices(texts):
                x = Block(a, b, texts[s])
                row, ta, tb = x.links()
                pair, at = np.unique((ta % SHARDS) << 48 | ta << 16 | tb, return_inverse=True)
                key, n = np.unique(at << 16 | row, return_counts=True)
                edge = np.searchsorted(key, np.searchsorted(pair >> 48, np.arange(SHARDS + 1)) << 16)
                sha = [hashlib.sha256(t).hexdigest() if len(t) else "" for t in x.group_texts()]
                meta = [ids.slice(s.start, s.stop - s.start), *(pa.array(v) for v in (x.n_a, x.n_b, x.n_groups)),
                        pa.array(sha, pa.string())]
                for k in range(SHARDS):
                    lo, hi = edge[k], edge[k + 1]
                    if lo == hi and k:
                        continue
                    body = pack_counts(key[lo:hi] & 0xFFFF, pair[key[lo:hi] >> 16] & (1 << 48) - 1, n[lo:hi])
                    lists = [pa.ListArray.from_arrays(pa.array([0, x.n], pa.int32()), v) if not k
                             else pa.nulls(1, pa.list_(v.type)) for v in meta]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([part * 1_000_003 + block], pa.int64()),
                         pa.array([x.n], pa.int64()), pa.array([body], pa.binary()), *lists],
                        names=["shard", "block", "size", "body", *_META])
                block += 1
    inp = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return inp.mapInArrow(run, "shard int, block long, size long, body binary, "
                          + ", ".join(f"{c} array<{t}>" for c, t in _META.items()))


def _sum_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pair, docs) of many packets, summed as far as a task's memory is given to it."""
    def total() -> pa.RecordBatch:
        pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
        n = np.bincount(at, np.concatenate(counts), len(pair)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "docs"])
    pairs, counts, held = [], [], 0
    for b in batches:
        for body in b.column("body"):
            g, rows, _, _ = unpack_counts(body.as_py())
            pairs.append(g)
            counts.append(rows)  # how many documents of the block hold the pair
            held += len(g)
        if held > 2_000_000:
            yield total()
            pairs, counts, held = [], [], 0
    if held:
        yield total()


def pair_counts(packets: DataFrame) -> DataFrame:
    """(a, b, docs): in how many documents each pair of ids is linked."""
    return (packets.select("body").mapInArrow(_sum_pairs, "pair long, docs long").groupBy("pair")
            .agg(F.sum("docs").alias("docs"))
            .select(F.shiftright("pair", 16).cast("int").alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFF)).cast("int").alias("b"),
                    "docs"))


def _shard_tables(counts: DataFrame) -> DataFrame:
    """(shard, model): sorted pairs of a shard, their counts, and whether a count is its A id's highest."""
    def build(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(["a", "b"])
        a, n = p["a"].to_numpy(np.int64), p["docs"].to_numpy(np.int64)
        first = np.flatnonzero(np.diff(a, prepend=-1))
        top = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(a))))
        pair = a << 16 | p["b"].to_numpy(np.int64)
        return pd.DataFrame({"shard": [int(a[0] % SHARDS)],
                             "model": [[pair.tobytes(), n.tobytes(), (n == top).tobytes()]]})
    return counts.withColumn("shard", F.col("a") % SHARDS).groupBy("shard").applyInPandas(
        build, "shard int, model array<binary>")


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_path: str | None = None,
          b_path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best``: links whose count is the highest of their A id; ``count_sum``: counts summed over links.
    """
    spark = docs.sparkSession
    short_batches(spark)
    scratch = Scratch(spark)
    packets, _ = scratch.save(_packets(docs, id_col, text_col, _vocabularies(spark, a_path, b_path)), "links")
    model = cut(_shard_tables(pair_counts(packets)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table_ = None
        for b in batches:
            for r in range(b.num_rows):
                if b.column("model")[r].is_valid:
                    m = [x.as_py() for x in b.column("model")[r].values]
                    table_ = np.frombuffer(m[0], np.int64), np.frombuffer(m[1], np.int64), np.frombuffer(m[2], bool)
                    continue
                size = b.column("size")[r].as_py()
                g, rows, row, n = unpack_counts(b.column("body")[r].as_py())
                if not len(g):
                    continue
                at = np.searchsorted(table_[0], g)
                docs_, top = np.repeat(table_[1][at], rows), np.repeat(table_[2][at], rows)
                best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
                np.add.at(best, row, n * top)
                np.add.at(total, row, n * docs_)  # integers: a float's 53 bits may not hold the sum
                yield pa.RecordBatch.from_arrays(
                    [b.column("block").slice(r, 1), *(pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), pa.array(v))
                                                      for v in (best, total))], names=["block", "best", "total"])
    parts = deal(packets.select("shard", "block", "size", "body"), model).mapInArrow(
        add, "block long, best array<long>, total array<long>")
    meta = packets.filter("shard = 0").select("block", *_META)
    # A block's rows meet again: one of documents, one of sums for each shard.
    rows = meta.unionByName(parts, allowMissingColumns=True)

    def finish(t: pa.Table) -> pa.Table:
        own = t.column("doc").is_valid().to_pylist().index(True)
        meta = [t.column(c)[own].values for c in _META]
        best, total = (sum((x.values.to_numpy() for x in t.column(c) if x.is_valid), np.zeros(len(meta[0]), np.int64))
                       for c in ("best", "total"))
        return pa.Table.from_arrays([*meta, pa.array(best), pa.array(total)], names=[*_META, "best", "total"])
    out = rows.groupBy("block").applyInArrow(
        finish, "doc long, n_a long, n_b long, n_groups long, sha string, best long, total long")
    return out.select("doc", "n_a", "n_b", "n_groups", (F.col("n_a") + F.col("n_b") - F.col("n_groups")).alias("n_links"),
                      F.col("best").alias("n_best"), F.col("total").alias("count_sum"), F.col("sha").alias("groups_sha256"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.withColumnRenamed("doc", "doc_id")
