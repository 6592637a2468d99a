"""Benchmark decontamination (operator 2).

The normalised words of all test items go into a generalised suffix
automaton. Training texts stream through it once, word by word; the state and
its length give the longest match that ends at each word. Where that is a
window (``window`` words, or a whole item of fewer) its words are hit.

Items are cut into segments of ``SEGMENT`` words that overlap by a window less
one word (so each window is in one), and segments are dealt by hash to blocks
of about ``block_bytes`` of words: a block has no more states than bytes,
whatever the size of an item or of the benchmark. Tasks build the blocks'
automata, as flat arrays of a few bytes a state; the driver holds one at a time
to broadcast it. The texts pass through ``GROUP`` automata in one narrow map;
if there are more, the found spans are written, the broadcasts destroyed and
the next group takes its turn.

Cases: null or empty text has no words; a very long text is read in pieces of
``PIECE`` bytes; an item without words or with a null id is no item; item ids
keep their type; rows with one item id are one item; repeated documents each
get their own row; columns of the input named like an output are replaced; an
empty benchmark hits nothing.
"""

from __future__ import annotations

import pickle
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from metrolake.llm.common import Scratch, cut, table, text_bytes

#: A-Z lower-cased; ASCII that is no letter or digit parts words; all else is a word's.
_NORM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
PIECE = 4 << 20
#: Words of a segment of an item; bytes of a block's segments; automata that a task holds at once.
SEGMENT = 100_000
BLOCK_BYTES = 8 << 20
GROUP = 4
SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORM).split()


def build_automaton(texts: list[tuple[int, bytes]], window: int) -> bytes:
    """Generalised suffix automaton of (item number, words joined by spaces), packed.

    A state's first transition is two numbers (``word1``, ``next1``); few states have more, in ``more``.
    ``windows`` lists for a state the items that hold the window-long suffix that it stands for; ``whole`` gives
    (length, item) of short items that are strings of it; ``short`` is the nearest state on the suffix path with such
    items, or -1; ``base`` the state whose ``windows`` list is meant.
    """
    vocab: dict[bytes, int] = {}
    seqs = [(i, [vocab.setdefault(w, len(vocab)) for w in t.split()]) for i, t in texts]
    word1, next1, link, length = array("i", [-1]), array("i", [0]), array("i", [-1]), array("i", [0])
    more: dict[int, dict[int, int]] = {0: {}}

    def go(s: int, w: int) -> int | None:
        return next1[s] if word1[s] == w else more[s].get(w) if s in more else None

    def put(s: int, w: int, t: int) -> None:
        if word1[s] in (w, -1):
            word1[s], next1[s] = w, t
        else:
            more.setdefault(s, {})[w] = t

    def new(n: int, up: int) -> int:
        word1.append(-1)
        next1.append(0)
        length.append(n)
        link.append(up)
        return len(length) - 1

    def split(p: int, w: int, q: int) -> int:
        """Clone q for the strings that p's path reaches by w."""
        c = new(length[p] + 1, link[q])
        word1[c], next1[c] = word1[q], next1[q]
        if q in more:
            more[c] = dict(more[q])
        link[q] = c
        while p >= 0 and go(p, w) == q:
            put(p, w, c)
            p = link[p]
        return c

    for _, ids in seqs:
        last = 0
        for w in ids:
            q = go(last, w)
            if q is not None:
                last = q if length[q] == length[last] + 1 else split(last, w, q)
                continue
            cur, p = new(length[last] + 1, 0), last
            while p >= 0 and go(p, w) is None:
                put(p, w, cur)
                p = link[p]
            if p >= 0:
                q = go(p, w)
                link[cur] = q if length[q] == length[p] + 1 else split(p, w, q)
            last = cur
    n = len(length)
    held: set[tuple[int, int]] = set()
    whole: set[tuple[int, int, int]] = set()
    for item, ids in seqs:
        s = 0
        for w in ids:
            s = p = go(s, w)
            while p > 0 and length[p] >= window and (p, item) not in held:
                held.add((p, item))
                p = link[p]
        if len(ids) < window:
            whole.add((s, len(ids), item))
    # By length, a state's suffix link comes first.
    short, base = np.full(n, -1, np.int32), np.arange(n, dtype=np.int32)
    ends, size = {s for s, _, _ in whole}, np.frombuffer(length, np.int32)
    for s in np.argsort(size, kind="stable")[1:].tolist():
        short[s] = s if s in ends else short[link[s]]
        if length[link[s]] >= window:
            base[s] = base[link[s]]
    pairs = np.array(sorted(held), np.int32).reshape(-1, 2)
    extra = [(s, w, t) for s, m in more.items() for w, t in m.items()]
    flat = {"word1": word1, "next1": next1, "link": link, "length": length, "short": short, "base": base,
            "extra": np.array(extra, np.int32).reshape(-1, 3), "pairs": pairs,
            "whole": np.array(sorted(whole), np.int32).reshape(-1, 3)}
    least = min([window, *(len(ids) for _, ids in seqs)])
    return pickle.dumps((window, least, b" ".join(vocab), {k: np.asarray(v, np.int32).tobytes() for k, v in flat.items()}))


class Automaton:
    """A packed automaton, ready for matching."""

    def __init__(self, packed: bytes, ids: list):
        self.window, self.least, vocab, flat = pickle.loads(packed)
        self.ids = ids
        self.get = {w: k for k, w in enumerate(vocab.split())}.get
        for name in ("word1", "next1", "link", "length", "short", "base"):
            a = array("i")
            a.frombytes(flat[name])
            setattr(self, name, a)
        extra = np.frombuffer(flat["extra"], np.int32).reshape(-1, 3).astype(np.int64)
        self.more = dict(zip((extra[:, 0] << 32 | extra[:, 1]).tolist(), extra[:, 2].tolist(), strict=True)).get
        self.pairs = np.frombuffer(flat["pairs"], np.int32).reshape(-1, 2)
        self.whole: dict[int, list[tuple[int, int]]] = {}
        for s, n, item in np.frombuffer(flat["whole"], np.int32).reshape(-1, 3).tolist():
            self.whole.setdefault(s, []).append((n, item))

    def match(self, text: bytes) -> tuple[int, list[list[int]], set]:
        """(number of words, hit spans as [first, past last) words, ids of items with occurring windows)."""
        norm, total, spans, items, bases = text.translate(_NORM), 0, [], set(), set()
        word1, next1, more, link, length = self.word1, self.next1, self.more, self.link, self.length
        short, base, whole, window, least, get = self.short, self.base, self.whole, self.window, self.least, self.get
        s = n = at = 0
        while at < len(norm):
            to = len(norm) if len(norm) - at <= PIECE else norm.find(b" ", at + PIECE)
            to = len(norm) if to < 0 else to
            ws = norm[at:to].split()
            at = to
            ids = np.fromiter((get(w, -1) for w in ws), np.int64, len(ws))
            known = np.flatnonzero(np.diff(np.r_[False, ids >= 0, False].astype(np.int8)))
            for a, b in zip(known[::2].tolist(), known[1::2].tolist(), strict=True):
                if a:
                    s = n = 0
                elif s == 0:
                    n = 0
                # Too short to hold a window, unless it may go on from or into another piece.
                if b - a < least and a and (b < len(ws) or at >= len(norm)):
                    continue
                for i, w in enumerate(ids[a:b].tolist(), total + a):
                    while True:
                        t = next1[s] if word1[s] == w else more(s << 32 | w)
                        if t is not None or not s:
                            break
                        s = link[s]
                        n = length[s]
                    if t is None:
                        n = 0
                        continue
                    s, n = t, n + 1
                    if n >= window:
                        _hit(spans, i + 1 - n, i + 1)
                        bases.add(base[s])
                    q = short[s]
                    while q > 0:
                        for m, item in whole[q]:
                            if m <= n:
                                _hit(spans, i + 1 - m, i + 1)
                                items.add(self.ids[item])
                        q = short[link[q]] if link[q] > 0 else -1
            if len(ws) and ids[-1] < 0:
                s = n = 0
            total += len(ws)
        for x in bases:
            lo, hi = np.searchsorted(self.pairs[:, 0], [x, x + 1])
            items.update(self.ids[k] for k in self.pairs[lo:hi, 1].tolist())
        return total, spans, items


def _hit(spans: list[list[int]], a: int, b: int) -> None:
    while spans and spans[-1][1] >= a:
        x, y = spans.pop()
        a, b = min(a, x), max(b, y)
    spans.append([a, b])


def _segments(items: DataFrame, window: int) -> DataFrame:
    """(id, seg, words) of ``items(id, t)``: normalised words of segments, each window in one of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, seg, out = [], [], []
            for k, text in enumerate(text_bytes(b.column("t"))):
                ws = words(text)
                for a in range(0, max(1, len(ws) - window + 1) if ws else 0, SEGMENT):
                    part = ws[a:a + SEGMENT + window - 1]
                    at.append(k)
                    seg.append(a)
                    out.append(b" ".join(part))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(at, pa.int64())), pa.array(seg, pa.int64()),
                 pa.array(out, pa.binary())], names=["id", "seg", "words"])
    kind = items.schema["id"].dataType.simpleString()
    return items.mapInArrow(run, f"id {kind}, seg long, words binary")


def annotate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
             item_text: str = "text", window: int = 10, block_bytes: int = BLOCK_BYTES,
             out_cols: tuple[str, str, str] = ("n_words", "spans", "items")) -> DataFrame:
    """``docs`` plus n_words, spans (hit words, [start, end)) and items (ids with occurring windows)."""
    spark = docs.sparkSession
    it = (items.select(F.col(item_id).alias("id"), F.col(item_text).cast("string").alias("t"))
          .filter("id is not null and t is not null"))
    kind = it.schema["id"].dataType
    segments = cut(_segments(it, window))
    blocks = max(1, -(-(segments.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // block_bytes))

    def build(t: pa.Table) -> pa.Table:
        ids = t.column("id").unique()
        number = {x: k for k, x in enumerate(ids.to_pylist())}
        rows = [(number[i], w) for i, w in zip(t.column("id").to_pylist(), t.column("words").to_pylist(), strict=True)]
        rows.sort()
        return pa.table({"block": t.column("block").slice(0, 1), "packed": pa.array([build_automaton(rows, window)], pa.binary()),
                         "ids": pa.array([ids.to_pylist()], pa.list_(ids.type))})
    scratch = Scratch(spark)
    dealt = segments.withColumn("block", F.pmod(F.xxhash64("id", "seg"), F.lit(blocks)))
    built, _ = scratch.save(dealt.groupBy("block").applyInArrow(
        build, f"block long, packed binary, ids array<{kind.simpleString()}>"), "automata")
    out = docs.drop(*out_cols).withColumns(dict(zip(out_cols, (
        F.lit(0).cast("long"), F.lit(None).cast(SPAN), F.lit(None).cast(T.ArrayType(kind))), strict=True)))
    for k in range(0, blocks, GROUP):
        autos = []
        for j in range(k, min(k + GROUP, blocks)):
            got = built.filter(F.col("block") == j).collect()  # one block's automaton: bounded by block_bytes
            autos += [spark.sparkContext.broadcast((bytes(r["packed"]), list(r["ids"]))) for r in got]
        out = _pass(out, text_col, autos)
        if k + GROUP < blocks:
            out, _ = scratch.save(out, "annotated")
            for b in autos:
                b.destroy()
    return out


def _pass(docs: DataFrame, text_col: str, autos: list) -> DataFrame:
    ids_type = docs.schema.fields[-1].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready = [Automaton(*b.value) for b in autos]
        for b in batches:
            n, spans, ids = [], [], []
            for text, old, found in zip(text_bytes(b.column(text_col)), b.column(-2).to_pylist(),
                                        b.column(-1).to_pylist(), strict=True):
                total, merged, hit = 0, [[s["start"], s["end"]] for s in old or []], set(found or ())
                for auto in ready:
                    total, got, more = auto.match(text)
                    hit |= more
                    if got and merged:
                        merged, both = [], sorted([*merged, *got])
                        for x, y in both:
                            _hit(merged, x, y)
                    elif got:
                        merged = got
                if not ready:
                    total = len(words(text))
                n.append(total)
                spans.append([{"start": x, "end": y} for x, y in merged])
                ids.append(sorted(hit))
            keep = b.columns[:-3]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(n, pa.int64()), pa.array(spans, _SPAN), pa.array(ids, to_arrow_type(ids_type))],
                names=b.schema.names)
    return docs.mapInArrow(run, docs.schema)


def cut_spans(text: str, spans: list) -> str:
    """``text`` without the words of ``spans`` and what stands between them."""
    raw = text.encode()
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(_NORM))]
    out, pos = [], 0
    for s in spans:
        out.append(raw[pos:at[s["start"]][0]])
        pos = at[s["end"] - 1][1]
    return b"".join([*out, raw[pos:]]).decode()


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = 10,
                  max_coverage: float = 0.2, **names) -> DataFrame:
    """``docs`` without benchmark text, same columns.

    Spans of ``window`` words or more (or whole shorter items) are cut out of
    the text; a document of which they cover more than ``max_coverage`` goes.
    """
    a = annotate(docs, items, text_col, window=window, out_cols=("__words", "__spans", "__items"), **names)
    covered = F.aggregate("__spans", F.lit(0), lambda x, s: x + s["end"] - s["start"])
    clean = F.udf(lambda t, s: cut_spans(t, s) if s else t, "string")
    text = F.when(F.size("__spans") > 0, clean(F.col(text_col), F.col("__spans"))).otherwise(F.col(text_col))
    return a.filter(covered <= F.col("__words") * max_coverage).select(
        *[text.alias(c) if c == text_col else F.col(c) for c in docs.columns])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda x, s: x + s["end"] - s["start"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return a.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                    F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
lens AS (SELECT DISTINCT m FROM win),
gram AS (
  SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM norm, lens WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, m, item_id FROM gram JOIN win USING (m, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS s FROM occ) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM norm LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
