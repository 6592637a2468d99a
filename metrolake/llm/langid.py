"""Language identification (operator 7).

A text is the average of the embeddings of its hashed subwords (byte 2- to
4-grams of lower-cased letters, words parted by one space), followed by a
linear softmax. Embeddings and softmax are trained by stochastic gradient
descent in numpy on a bounded sample: ``max_train`` labelled documents, as
many of each language, of least hash. Only their hashed counts come to the
driver. A fifth of the sample is kept for calibration: it sets the softmax's
temperature and the score below which a prediction is rejected.

Predictions cover whole texts; very long ones are taken in overlapping pieces.

Cases: null text, or one without a letter: ``und`` with score 0, not accepted;
no training rows at all: ``und`` for every text; rows with a null language or
a null id teach nothing; ties go to the language first by name; repeated rows
each come back.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolake.llm.common import cut, table

BUCKETS = 1 << 14
SIZES = (2, 3, 4)
BLOCK = 1 << 20
_LETTER = re.compile(r"[^\W\d_]")
_NORM = bytes(c if c >= 128 or 97 <= c <= 122 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


def normal(text: str) -> bytes:
    """Lower-cased letters, all that parts words as one space, a space at both ends."""
    return b" " + b" ".join(text.lower().encode().translate(_NORM).split()) + b" "


def _hashes(raw: np.ndarray, row: np.ndarray, own: np.ndarray) -> Iterator[np.ndarray]:
    """Bucket of the subword at each byte, for each size; BUCKETS where it runs into the next row or isn't ``own``."""
    x = raw.astype(np.uint32)
    h = np.full(len(x), 2166136261, np.uint32)
    for n in range(1, SIZES[-1] + 1):
        tail = np.zeros(len(x), np.uint32)
        tail[:len(x) - n + 1] = x[n - 1:]
        h = (h ^ tail) * np.uint32(16777619)
        if n in SIZES:
            out = ((h ^ np.uint32(n)) * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)
            inside = np.zeros(len(x), bool)
            inside[:len(x) - n + 1] = own[:len(x) - n + 1] & (row[:len(x) - n + 1] == row[n - 1:])
            out[~inside] = BUCKETS
            yield out


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, row of each, whether a subword may start there) of about BLOCK bytes.

    A longer text comes in pieces that overlap, so that each subword starts in one of them.
    """
    out: list[tuple[bytes, int, int]] = []

    def joined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.array([len(p) for p, *_ in out])
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        return (np.frombuffer(b"".join(p for p, *_ in out), np.uint8), np.repeat([i for _, i, _ in out], size),
                at < np.repeat([n for *_, n in out], size))

    total = 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), BLOCK):
            out.append((t[a:a + BLOCK + SIZES[-1] - 1], i, BLOCK))
            total += len(out[-1][0])
            if total >= BLOCK:
                yield joined()
                out, total = [], 0
    if out:
        yield joined()


def subword_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.zeros(BUCKETS + 1, np.int64)
    for raw, row, own in _pieces([normal(text)]):
        for h in _hashes(raw, row, own):
            total += np.bincount(h, minlength=BUCKETS + 1)
    at = np.flatnonzero(total[:BUCKETS])
    return at, total[at]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, dim: int = 16, epochs: int = 8,
          rate: float = 0.5, seed: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(embeddings, softmax weights, bias) by plain SGD over (buckets, counts, class) rows."""
    rng = np.random.default_rng(seed)
    emb = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out, bias = np.zeros((dim, classes)), np.zeros(classes)
    steps, done = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            at, n, y = rows[k]
            w = n / n.sum()
            v = w @ emb[at]
            z = v @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            lr = rate * (1 - done / steps)
            back = out @ p
            out -= lr * np.outer(v, p)
            bias -= lr * 0.1 * p
            # The average spreads the gradient over all subwords; each gets its own share back in full.
            emb[at] -= lr * len(at) * 0.05 * w[:, None] * back
            done += 1
    return emb, out, bias


def _soft(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def calibrate(z: np.ndarray, y: np.ndarray, reject: float) -> tuple[float, float]:
    """(temperature of least log loss, score below which the share ``reject`` of right predictions lies)."""
    if not len(y):
        return 1.0, 0.0
    grid = np.geomspace(0.05, 20, 121)
    # Targets smoothed by a thousandth: a sample without errors must not ask for certainty.
    goal = np.full(z.shape, 0.001 / z.shape[1])
    goal[np.arange(len(y)), y] += 0.999
    loss = [-(goal * np.log(np.maximum(_soft(z / t), 1e-300))).sum(axis=1).mean() for t in grid]
    t = float(grid[int(np.argmin(loss))])
    p = _soft(z / t)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    return t, float(np.quantile(right, reject)) if len(right) else 0.0


def _least_hashed(own: DataFrame, k: int) -> DataFrame:
    """(si): ids of the ``k`` rows of least id hash in each language.

    A language's share of hashes that holds some 4 k of its rows is known from its row count, so what is ranked is
    bounded, however many rows or tasks a language has; should the share hold fewer than k, a larger one is taken.
    """
    sizes = cut(own.groupBy("y").agg(F.count(F.lit(1)).alias("all")))
    hashed = own.select("i", "y", F.xxhash64("i").alias("h"))
    place = F.col("h").cast("double") / F.lit(2.0 ** 64) + 0.5
    w = Window.partitionBy("y").orderBy("h", "i")
    for wide in (4, 64, None):
        some = hashed
        if wide:
            share = sizes.select(F.col("y").alias("ys"), (F.lit(float(wide * k)) / F.col("all")).alias("share"))
            # A row a language, max_train at most.
            some = hashed.join(F.broadcast(share), F.col("y") == F.col("ys")).filter(place < F.col("share"))
        got = cut(some.withColumn("k", F.row_number().over(w)).filter(F.col("k") <= k).select("i", "y"))
        short = sizes.join(got.groupBy("y").agg(F.count(F.lit(1)).alias("n")), "y", "left").filter(
            F.coalesce("n", F.lit(0)) < F.least(F.col("all"), F.lit(k)))
        if not wide or not short.take(1):
            return got.select(F.col("i").alias("si")).distinct()


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_train: int = 2000,
        reject: float = 0.005) -> dict:
    """Model from labelled ``docs``: per-bucket class scores, bias, temperature, limit, languages."""
    own = docs.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t"),
                      F.col(lang_col).cast("string").alias("y"))
    own = own.filter("i is not null and y is not null and t is not null")
    langs = sorted(r["y"] for r in own.select("y").distinct().limit(max_train + 1).collect())
    if not langs:
        return {"langs": []}
    if len(langs) > max_train:
        raise ValueError("more languages than max_train rows")
    ids = _least_hashed(own, max_train // len(langs))
    ids = F.broadcast(cut(ids))  # max_train longs at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not _LETTER.search(t):
                    continue
                at, n = subword_counts(t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i]), pa.array([y]), pa.array([at.astype("<u2").tobytes()]),
                     pa.array([n.astype("<u4").tobytes()])], names=["i", "y", "at", "n"])

    got = (own.join(ids, F.col("i") == F.col("si")).select("i", "t", "y")
           .mapInArrow(count, "i long, y string, at binary, n binary").collect())
    order = {y: k for k, y in enumerate(langs)}
    rows = [(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<u4").astype(np.float64),
             order[r["y"]]) for r in sorted(got, key=lambda r: (r["i"], r["y"], bytes(r["at"])))]
    if not rows:
        return {"langs": []}
    held = [r for k, r in enumerate(rows) if k % 5 == 4]
    emb, out, bias = train([r for k, r in enumerate(rows) if k % 5 != 4], len(langs))
    score = emb @ out  # the average of embeddings times the softmax is the average of these
    z = np.array([n / n.sum() @ score[at] + bias for at, n, _ in held]).reshape(-1, len(langs))
    t, limit = calibrate(z, np.array([y for *_, y in held], np.int64), reject)
    return {"langs": langs, "score": np.vstack([score, np.zeros(len(langs))]).astype(np.float32), "bias": bias,
            "temperature": t, "limit": limit}


def predict(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``docs`` plus lang_pred, score (0 to 1) and accepted."""
    own = docs.drop("lang_pred", "score", "accepted")
    names = own.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS rows of one float a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        langs = m["langs"]
        for b in batches:
            texts = b.column(text_col).to_pylist()
            known = [i for i, t in enumerate(texts) if langs and t and _LETTER.search(t)]
            total, n = np.zeros((len(known), len(langs))), np.zeros(len(known))
            for raw, row, own in _pieces([normal(texts[i]) for i in known]):
                first = np.flatnonzero(np.diff(row, prepend=-1))
                for h in _hashes(raw, row, own):
                    total[row[first]] += np.add.reduceat(m["score"][h], first, axis=0, dtype=np.float64)
                    n[row[first]] += np.add.reduceat((h < BUCKETS).astype(np.int64), first)
            lang, score, ok = ["und"] * len(texts), [0.0] * len(texts), [False] * len(texts)
            if known:
                p = _soft((total / n[:, None] + m["bias"]) / m["temperature"])
                for i, k, s in zip(known, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    lang[i], score[i], ok[i] = langs[k], s, s >= m["limit"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(ok, pa.bool_())], names=[*names, "lang_pred", "score", "accepted"])
    schema = own.withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "accepted": F.lit(True)}).schema
    for f in schema.fields[-3:]:
        f.nullable = True
    return own.mapInArrow(run, schema)


def fold(id_col: str, n: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(fold("doc_id", 3) != 1), "doc_id", "text", "lang")
    out = predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred",
                      "score", "accepted")
