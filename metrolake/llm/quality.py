"""Quality classifier (operator 5).

An interpolated modified Kneser-Ney model of character trigrams, trained on
trusted text. Trigrams are counted once, by half of the trusted texts; the
counts are sharded by the middle character, so that a trigram, its context and
its bigram lie in one shard. Shards first give the counts of counts (for the
three discounts of each order) and the continuation counts of characters, which
are summed over shards, then their tables of probabilities and back-off
weights. Every text gets a perplexity; a text goes if its cross-entropy is
above its language's limit, taken from quantiles of the trusted texts of that
language. A model knows the texts it was trained on, the more so the more
characters a script has; so for the limits each half of the trusted texts is
scored by a model of the other half. (An id's half is a hash of it.) All three models (all texts, and either
half) come from the same counts in the same two passes over the shards.

Scoring is a sharded join too. Each task packs the distinct trigrams of a
block of texts by shard; a shard looks each distinct trigram up once and
returns partial sums per text, by the model of the other half as well. No text
is shuffled or written; which rows are trusted is joined to the scores.

Bounds: every text of a trusted id is trained on and gives limits. Up to
``MAX_PACKED`` trusted ids go to the counting tasks as compressed differences (a
byte or two an id); more are joined to the texts by a shuffle. There are as many
shards as the distinct trigrams ask for (``SHARD_GRAMS`` each, ``SHARDS`` at
least); the quantiles are exact at any number of trusted texts. The alphabet is every
character of the trusted text, with as many bits a character as it needs (9 at
least, 21 for all of Unicode); characters that no trusted text has are one
unknown character.

Cases: null or empty text has no perplexity and is kept (nothing speaks against
it); a null language, or one with fewer than ``min_trusted`` trusted texts,
takes the limits of all trusted texts; without trusted text at all everything
is kept; null labels are not trusted; rows with equal id and text share one
result; short texts are drawn to their language's median by ``prior_chars``
pseudo-characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import cut, deal, pack_counts, table, unpack_counts
from metrolake.operators.quantiles import group_quantiles

#: Codes: 0 before the text, 1 unknown, 2 and up the alphabet; they have this many bits at least.
MIN_BITS = 9
#: Model shards at least, and the distinct trigrams for which there is one more: tables of some 100 MB.
SHARDS = 8
SHARD_GRAMS = 1 << 20
#: Trusted ids that a counting task holds at most (8 bytes each).
MAX_PACKED = 1 << 23
BLOCK_CHARS = 1 << 19
#: Code points of the raw counts are packed in 21 bits each; 0x110000 stands before the text.
START = 0x110000


def _code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts, each after two START; row of each; and where a text's own ones are."""
    raw = [(t or "").encode("utf-32-le", "surrogatepass") for t in texts]
    n = np.fromiter((len(r) // 4 for r in raw), np.int64, len(raw))
    row = np.repeat(np.arange(len(raw)), n + 2)
    own = np.ones(len(row), bool)
    first = np.cumsum(n + 2) - n - 2
    own[first], own[first + 1] = False, False
    cp = np.full(len(row), START, np.int64)
    cp[own] = np.frombuffer(b"".join(raw), "<u4")
    return cp, row, own


def _blocks(texts: list[str | None]) -> Iterator[slice]:
    """Runs of texts of about BLOCK_CHARS characters (or one longer text), 60,000 texts at most."""
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t or "") + 2
        if i > a and (size + n > BLOCK_CHARS or i - a >= 60_000):
            yield slice(a, i)
            a, size = i, 0
        size += n
    if a < len(texts):
        yield slice(a, len(texts))


def pack_ids(ids: DataFrame) -> list[bytes]:
    """The distinct longs of the one column of ``ids``: a task's as compressed differences."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.sort(np.concatenate([np.zeros(0, np.int64), *(b.column(0).to_numpy() for b in batches)]))
        if len(own):
            blob = zstandard.ZstdCompressor(level=3).compress(np.diff(own, prepend=0).view(np.uint8).reshape(-1, 8).T.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["ids"])
    return [bytes(r["ids"]) for r in ids.mapInArrow(run, "ids binary").collect()]


def unpack_ids(blobs: list[bytes]) -> np.ndarray:
    """All ids of ``pack_ids``, ascending."""
    parts = [np.frombuffer(zstandard.ZstdDecompressor().decompress(x), np.uint8).reshape(8, -1) for x in blobs]
    return np.sort(np.concatenate([np.zeros(0, np.int64), *(
        np.cumsum(np.ascontiguousarray(p.T).view(np.int64).ravel()) for p in parts)]))


def trigram_counts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str, half_col: str) -> DataFrame:
    """(g, n0, n1): counts of raw trigrams (21 bits a code point) in the texts of half 0 and of half 1.

    Of the texts whose id is among ``ids(tid)``, a materialised frame of distinct ids.
    """
    spark, packed = docs.sparkSession, None
    if ids.count() <= MAX_PACKED:
        packed = spark.sparkContext.broadcast(pack_ids(ids))
    else:
        docs = docs.join(ids, F.col(id_col) == F.col("tid"), "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = unpack_ids(packed.value) if packed else None
        for b in batches:
            if known is not None:
                at = np.minimum(np.searchsorted(known, b.column(2).to_numpy()), len(known) - 1)
                b = b.filter(pa.array(known[at] == b.column(2).to_numpy())) if len(known) else b.slice(0, 0)
            texts, halves = b.column(0).to_pylist(), b.column(1).to_numpy()
            for s in _blocks(texts):
                cp, row, own = _code_points(texts[s])
                i = np.flatnonzero(own)
                raw, half = (cp[i - 2] << 42) | (cp[i - 1] << 21) | cp[i], halves[s][row[i]]
                for k in (0, 1):
                    g, n = np.unique(raw[half == k], return_counts=True)
                    cols = [n, np.zeros_like(n)] if k == 0 else [np.zeros_like(n), n]
                    yield pa.RecordBatch.from_arrays([pa.array(g), *(pa.array(c.astype(np.int64)) for c in cols)],
                                                     names=["g", "n0", "n1"])
    return (docs.filter(F.col(id_col).isNotNull())
            .select(F.col(text_col).cast("string").alias("t"), F.col(half_col).cast("int").alias("half"), F.col(id_col).alias("id"))
            .mapInArrow(run, "g long, n0 long, n1 long").groupBy("g").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


def discounts(n: dict[int, int]) -> np.ndarray:
    """Modified Kneser-Ney discounts by count (0, 1, 2, 3 or more) from the counts of counts."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if min(n1, n2, n3, n4):
        y = n1 / (n1 + 2 * n2)
        d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        if all(0 < x <= k for k, x in enumerate(d, 1)):
            return np.array([0.0, *d])
    return np.array([0.0, 0.5, 1.0, 1.5])  # too few counts to estimate them


#: The models: of all trusted texts, for texts of half 0 (counts of half 1), for texts of half 1.
MODELS = (lambda n0, n1: n0 + n1, lambda n0, n1: n1, lambda n0, n1: n0)


def _level(n: np.ndarray, ctx: np.ndarray, d: np.ndarray, low) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, contexts, back): interpolated probabilities of one order and back-off weights; rows are sorted by context."""
    first = np.flatnonzero(np.diff(ctx, prepend=-1))
    size = np.diff(np.append(first, len(ctx)))
    cut_ = d[np.minimum(n, 3)]
    tot, free = np.add.reduceat(n, first), np.add.reduceat(cut_, first)
    back = free / tot
    return np.maximum(n - cut_, 0) / np.repeat(tot, size) + np.repeat(back, size) * low, ctx[first], back


def train(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str,
          half_col: str) -> tuple[np.ndarray, int, int, DataFrame, list[int]]:
    """(code of each code point, bits of a code, number of shards, model shards, trigrams of each model).

    Shard rows: (shard, model) with the tables of all three models.
    """
    spark = docs.sparkSession
    raw = cut(trigram_counts(docs, ids, id_col, text_col, half_col))
    shards = max(SHARDS, -(-raw.count() // SHARD_GRAMS))
    m21 = F.lit((1 << 21) - 1)
    top = raw.groupBy(F.col("g").bitwiseAND(m21).alias("c")).agg(F.sum(F.col("n0") + F.col("n1")).alias("k")).orderBy(
        F.desc("k"), "c")
    alphabet = [r["c"] for r in top.collect()]  # the distinct characters: Unicode's at most
    bits = max(MIN_BITS, (len(alphabet) + 1).bit_length())
    low1, low2 = (1 << bits) - 1, (1 << 2 * bits) - 1
    code = np.ones(START + 1, np.int32)
    code[START] = 0
    code[alphabet] = np.arange(2, len(alphabet) + 2)
    def recode(s: pd.Series) -> pd.Series:
        c = [code[s.to_numpy() >> k & (1 << 21) - 1].astype(np.int64) for k in (42, 21, 0)]
        return pd.Series(c[0] << 2 * bits | c[1] << bits | c[2])
    recode = F.pandas_udf(recode, "long")
    coded = raw.select(recode("g").alias("g"), "n0", "n1")
    # An empty row makes every shard be there: any of them may be asked.
    none = spark.range(shards).select((F.col("id") * (1 << bits)).alias("g"), F.lit(0).cast("long").alias("n0"),
                                      F.lit(0).cast("long").alias("n1"))
    by_shard = coded.unionByName(none).withColumn(
        "shard", (F.shiftright("g", bits).bitwiseAND(F.lit(low1)) % shards).cast("int")).groupBy("shard")

    def each(p: pd.DataFrame):
        g, n0, n1 = (p[c].to_numpy(np.int64) for c in ("g", "n0", "n1"))
        order = np.argsort(g)
        g, n0, n1 = g[order], n0[order], n1[order]
        for k, counts in enumerate(MODELS):
            n = counts(n0, n1)
            yield k, g[n > 0], n[n > 0]

    def stats(p: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k, g, n in each(p):
            g2, n2 = np.unique(g & low2, return_counts=True)
            chars, n1 = np.unique(g2 & low1, return_counts=True)
            for order, c in ((3, n), (2, n2)):
                out += [(k, order, x, int((c == x).sum())) for x in (1, 2, 3, 4)] + [(k, -order, 0, len(c))]
            out += zip([k] * len(chars), [1] * len(chars), chars.tolist(), n1.tolist(), strict=True)
        return pd.DataFrame(out, columns=["k", "kind", "key", "n"])
    said = by_shard.applyInPandas(stats, "k int, kind int, key long, n long").groupBy("k", "kind", "key").agg(
        F.sum("n").alias("n")).collect()  # counts of counts, and a number for each character
    found: dict = {(k, kind): {} for k in range(len(MODELS)) for kind in (1, 2, 3, -2, -3)}
    for r in said:
        found[r["k"], r["kind"]][r["key"]] = r["n"]
    tables, d = [], []
    for k in range(len(MODELS)):
        chars = np.array(sorted(found[k, 1]), np.int64)
        n1 = np.array([found[k, 1][c] for c in chars.tolist()], np.int64)
        freq = dict(zip(*(x.tolist() for x in np.unique(n1, return_counts=True)), strict=True))
        d.append([discounts(freq), discounts(found[k, 2]), discounts(found[k, 3])])
        if len(n1):
            p1, _, back = _level(n1, np.zeros(len(n1), np.int64), d[k][0], 1.0 / (1 << bits))
            tables.append((np.append(-1, chars), np.append(back / (1 << bits), p1)))
        else:
            tables.append((np.array([-1]), np.array([1.0 / (1 << bits)])))
    shared = spark.sparkContext.broadcast(tables)  # a number for each character

    def pack(p: pd.DataFrame) -> pd.DataFrame:
        blob = []
        for k, g, n in each(p):
            t1 = shared.value[k]
            parts = [(np.zeros(0, np.int64), np.zeros(0))] * 4
            if len(g):
                g2, n2 = np.unique(g & low2, return_counts=True)
                p2, ctx2, back2 = _level(n2, g2 >> bits, d[k][1], t1[1][np.searchsorted(t1[0], g2 & low1)])
                p3, ctx3, back3 = _level(n, g >> bits, d[k][2], p2[np.searchsorted(g2, g & low2)])
                parts = [(g, p3), (ctx3, back3), (g2, p2), (ctx2, back2)]
            for key, v in [*parts, t1]:
                blob += [key.astype(np.int64).tobytes(), v.astype(np.float64).tobytes()]
        return pd.DataFrame({"shard": [int(p["shard"].iloc[0])], "model": [blob]})
    model = cut(by_shard.applyInPandas(pack, "shard int, model array<binary>"))
    return code, bits, shards, model, [found[k, -3].get(0, 0) for k in range(len(MODELS))]


def _find(tab: tuple[np.ndarray, np.ndarray], g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, vals = tab
    if not len(keys):
        return np.zeros(len(g), bool), np.zeros(len(g))
    at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
    return keys[at] == g, vals[at]


def log_prob(model: list[bytes], g: np.ndarray, bits: int) -> np.ndarray:
    """Natural log of p(c | a b) of trigrams whose tables lie in this shard."""
    t = [(np.frombuffer(k, np.int64), np.frombuffer(v, np.float64)) for k, v in zip(model[::2], model[1::2], strict=True)]
    low1, low2 = (1 << bits) - 1, (1 << 2 * bits) - 1
    ok1, v1 = _find(t[4], g & low1)
    p = np.where(ok1, v1, _find(t[4], np.full(1, -1))[1][0])
    ok, v = _find(t[2], g & low2)
    known, back = _find(t[3], g >> bits & low1)
    p = np.where(ok, v, np.where(known, back, 1.0) * p)
    ok, v = _find(t[0], g)
    known, back = _find(t[1], g >> bits)
    return np.log(np.where(ok, v, np.where(known, back, 1.0) * p))


def cross_entropy(docs: DataFrame, code: np.ndarray, bits: int, shards: int, model: DataFrame, id_col: str,
                  text_col: str, lang_col: str, half_col: str) -> DataFrame:
    """(doc, h, lang, half, lp, lp_half, n) per distinct row: log probability (natural) and characters of the text.

    ``lp_half``: by the model of the other half of the trusted texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(code)  # one entry a code point

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = TaskContext.get().partitionId(), 0
        for b in batches:
            texts = b.column(4).to_pylist()
            for s in _blocks(texts):
                cp, row, own = _code_points(texts[s])
                c = shared.value[cp].astype(np.int64)
                i = np.flatnonzero(own)
                # Distinct trigrams by shard, and their numbers in that order: a number and a row fit in 64 bits.
                g, at = np.unique((c[i - 2] << 2 * bits) | (c[i - 1] << bits) | c[i], return_inverse=True)
                shard = (g >> bits & (1 << bits) - 1) % shards
                order = np.argsort(shard, kind="stable")
                rank = np.empty(len(g), np.int64)
                rank[order] = np.arange(len(g))
                key, n = np.unique(rank[at] << 16 | row[i], return_counts=True)
                edge = np.searchsorted(key, np.searchsorted(shard[order], np.arange(shards + 1)) << 16)
                g = g[order]
                cols = [b.column(k)[s.start:s.stop] for k in range(4)]
                ids = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in cols]
                for k in range(shards):
                    a, z = edge[k], edge[k + 1]
                    if a == z and k:  # shard 0 lists every text
                        continue
                    blob = pack_counts(key[a:z] & 0xFFFF, g[key[a:z] >> 16], n[a:z])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([part * 1_000_003 + block], pa.int64()), *ids,
                         pa.array([blob], pa.binary())], names=["shard", "block", "doc", "h", "lang", "half", "body"])
                block += 1

    texts = docs.select(F.col(id_col).cast("long").alias("doc"), _hash(text_col).alias("h"),
                        F.col(lang_col).cast("string").alias("lang"), F.col(half_col).cast("byte").alias("half"),
                        F.col(text_col).cast("string").alias("t"))
    packed = texts.mapInArrow(pack, "shard int, block long, doc array<long>, h array<long>, lang array<string>, "
                                    "half array<byte>, body binary")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for b in batches:
            for r in range(b.num_rows):
                blob = b.column("model")[r]
                if blob.is_valid:
                    now = [x.as_buffer() for x in blob.values]
                    now = [now[k:k + 10] for k in range(0, len(now), 10)]
                    continue
                g, rows, row, n = unpack_counts(b.column("body")[r].as_py())
                gram, half, size = np.repeat(np.arange(len(g)), rows), b.column("half")[r].values, len(b.column("doc")[r])
                lp = np.bincount(row, log_prob(now[0], g, bits)[gram] * n, size)
                other, of = np.zeros(size), half.to_numpy()[row]
                for k in (0, 1):
                    mine = np.flatnonzero(of == k)
                    if len(mine):
                        used, at = np.unique(gram[mine], return_inverse=True)
                        other += np.bincount(row[mine], log_prob(now[k + 1], g[used], bits)[at] * n[mine], size)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc")[r].values, b.column("h")[r].values, b.column("lang")[r].values, half,
                     pa.array(lp.astype(np.float64)), pa.array(other),
                     pa.array(np.bincount(row, n, size).astype(np.int64))],
                    names=["doc", "h", "lang", "half", "lp", "lp_half", "n"])
    parts = deal(packed, model).mapInArrow(
        score, "doc long, h long, lang string, half byte, lp double, lp_half double, n long")
    # Rows with equal id and text add up alike in all sums; a text without characters has none.
    return parts.groupBy("doc", "h", "lang", "half").agg(
        F.sum("lp").alias("lp"), F.sum("lp_half").alias("lp_half"), F.sum("n").alias("n"))


def _hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", quantile: float = 0.99, slack: float = 2.0,
             prior_chars: int = 20, min_trusted: int = 30) -> DataFrame:
    """(doc, h, lang, n_chars, log_prob, perplexity, entropy, top, kept) per distinct (id, text, language).

    ``top``, the limit on the cross-entropy, is the language's trusted median
    plus ``slack`` times what its ``quantile`` lies above the median.
    """
    ids = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("tid")).distinct()
    ids = cut(ids)
    own = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_t"), F.col(lang_col).alias("_l"),
                      F.pmod(F.xxhash64(F.lit(1), F.col(id_col).cast("long")), F.lit(2)).alias("_half"))
    code, bits, shards, model, sizes = train(own, ids, "_id", "_t", "_half")
    if not sizes[0]:
        null = F.lit(None).cast("double")
        return docs.select(
            F.col(id_col).cast("long").alias("doc"), _hash(text_col).alias("h"),
            F.col(lang_col).cast("string").alias("lang"),
            F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)).cast("long").alias("n_chars"),
            null.alias("log_prob"), null.alias("perplexity"), null.alias("entropy"), null.alias("top"),
            F.lit(True).alias("kept")).distinct()
    s = cut(cross_entropy(own, code, bits, shards, model, "_id", "_t", "_l", "_half")).withColumn(
        "e", F.when(F.col("n") > 0, -F.col("lp") / F.col("n")))
    # Too few texts for two halves: the model's own.
    seen = F.col("lp_half") if sizes[1] and sizes[2] else F.col("lp")
    trusted = cut(s.filter("n > 0").join(ids, F.col("doc") == F.col("tid"), "left_semi").select(
        "lang", (-seen / F.col("n")).alias("e")))
    enough = trusted.filter("lang is not null").groupBy("lang").count().filter(F.col("count") >= min_trusted)
    by_lang = group_quantiles(trusted.join(F.broadcast(enough), "lang", "left_semi"), ["lang"], "e", [0.5, quantile], ["mid", "high"])
    by_lang = F.broadcast(by_lang.withColumnRenamed("lang", "tl"))  # a row a language, as ``enough``
    every = group_quantiles(trusted.withColumn("_all", F.lit(0)), ["_all"], "e", [0.5, quantile], ["mid0", "high0"])
    mid0, high0 = every.select("mid0", "high0").first() or (None, None)
    j = s.join(by_lang, F.col("lang") == F.col("tl"), "left").select(
        "doc", "h", "lang", "lp", "n", "e", F.coalesce("mid", F.lit(mid0).cast("double")).alias("mid"),
        F.coalesce("high", F.lit(high0).cast("double")).alias("high"))
    top = F.col("mid") + (F.col("high") - F.col("mid")) * slack
    entropy = (-F.col("lp") + prior_chars * F.col("mid")) / (F.col("n") + prior_chars)
    return j.select("doc", "h", "lang", F.col("n").alias("n_chars"), F.col("lp").alias("log_prob"),
                    F.exp("e").alias("perplexity"), entropy.alias("entropy"), top.alias("top"),
                    F.coalesce(entropy <= top, F.lit(True)).alias("kept"))


def filter_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang", **params) -> DataFrame:
    """``docs`` without the rows that the classifier rejects, same columns."""
    bad = classify(docs, labels, id_col, text_col, lang_col, **params).filter("not kept").select(
        F.col("doc").alias("__bd"), F.col("h").alias("__bh"), F.col("lang").alias("__bl"))
    own = docs.select(*[F.col(c) for c in docs.columns], _hash(text_col).alias("__h"))
    return own.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("__bd"))
                    & (F.col("__h") == F.col("__bh")) & F.col(lang_col).eqNullSafe(F.col("__bl")),
                    "left_anti").drop("__h")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = classify(docs, table(spark, sf_dir, "labels"))
    return out.select(F.col("doc").alias("doc_id"), "lang", "n_chars", "perplexity", "entropy",
                      F.col("top").alias("entropy_limit"), "kept")
