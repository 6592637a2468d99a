"""Line dedup (operator 9).

Every line's key (stripped, A-Z lower-cased) is hashed to 128 bits. The hashes
are range-partitioned and sorted by (hash, document descending, position), so
that one pass over a partition meets each key's kept document first and can
drop the rest as a stream. A key that runs over a partition's edge can't be
settled there; its rows go out undecided and are settled by one small
aggregate (at most two keys a partition). What comes back per document is a
compressed bitmap of kept lines, not text.

Rules: keys of at least ``min_chars`` code points found in at least
``min_docs`` documents lose all their lines except in the largest id holding
them. Cases:

* null or empty text: one empty line, kept;
* null id: the document keeps all lines and is counted for no key;
* repeated rows: equal ids are one document, each row gets its own bitmap by
  (id, hash of the text), and all copies of the kept id keep their lines;
* very long texts: lines are hashed one by one, one batch of texts is in memory;
* input columns of any name are kept;
* empty table: no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, table, text_bytes

SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc", pa.int64()), ("rk", pa.int64()),
                    ("pos", pa.int32())])
_OUT = pa.schema([*_LINES, ("kind", pa.int8())])
#: What a streamed row says: drop the line; undecided line; a document that holds an undecided key.
DROP, OPEN, MARK = 0, 1, 2


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, rk, pos) of every line whose key is long enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h1, h2, doc, rk, pos = [], [], [], [], []
            for d, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), strict=True):
                if d is None:
                    continue
                r = None
                for i, line in enumerate(text.split(b"\n")):
                    key = line.strip(SPACE)
                    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
                        continue
                    if r is None:
                        r = _signed(xxhash.xxh64_intdigest(text, 42))
                    x = xxhash.xxh3_128_intdigest(key.translate(_LOWER))
                    h1.append(_signed(x >> 64))
                    h2.append(_signed(x & 0xFFFFFFFFFFFFFFFF))
                    doc.append(d)
                    rk.append(r)
                    pos.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip((h1, h2, doc, rk, pos), _LINES.types, strict=True)], schema=_LINES)
    return docs.mapInArrow(run, "h1 long, h2 long, doc long, rk long, pos int")


def _stream(min_docs: int):
    """Decide sorted rows of one partition; state is a key's first ``min_docs`` documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows: list[tuple]) -> pa.RecordBatch:
            cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _OUT.types, strict=True)],
                                              schema=_OUT)

        key, first_run, docs, wait = None, True, [], []
        for b in batches:
            done: list[tuple] = []
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (r[0], r[1]) != key:
                    if key is not None:
                        first_run = False
                    key, docs, wait = (r[0], r[1]), [], []
                if first_run:  # may go on from the partition before
                    done.append((*r, OPEN))
                    continue
                if not docs or (r[2] != docs[-1] and len(docs) < min_docs):
                    docs.append(r[2])
                if r[2] == docs[0]:
                    continue
                if len(docs) < min_docs:
                    wait.append((*r, DROP))
                else:
                    done += wait
                    wait = []
                    done.append((*r, DROP))
            yield out(done)
        if key is not None and not first_run:  # the last key may go on in the next partition
            yield out([(*key, d, 0, 0, MARK) for d in docs] + [(*r[:5], OPEN) for r in wait])
    return run


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int, scratch: Scratch) -> DataFrame:
    """(doc, rk, pos) of every line to drop."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("h1"), F.col("h2"), F.col("doc").desc(), F.col("rk"), F.col("pos")]
    sorted_ = line_hashes(docs, min_chars).repartitionByRange(n, *order).sortWithinPartitions(*order)
    # Read twice below, and another run may cut the ranges elsewhere: write it once.
    said, _ = scratch.save(sorted_.mapInArrow(
        _stream(min_docs), "h1 long, h2 long, doc long, rk long, pos int, kind byte"), "lines")
    open_ = said.filter(F.col("kind") != DROP)
    keys = (open_.select("h1", "h2", "doc").distinct().groupBy("h1", "h2")
            .agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("top"))
            .filter(F.col("n") >= min_docs).drop("n"))
    # Two keys a partition at most.
    late = (said.filter(F.col("kind") == OPEN).join(F.broadcast(keys), ["h1", "h2"]).filter("doc < top")
            .select("doc", "rk", "pos"))
    return said.filter(F.col("kind") == DROP).select("doc", "rk", "pos").unionByName(late)


def pack_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    keep = np.ones(n_lines, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep).tobytes())


def unpack_bitmap(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                 min_docs: int = 3) -> DataFrame:
    """(doc, rk, n_bits, bitmap): a zlib-packed keep bitmap for every document that loses a line.

    A document without a row keeps all its lines. ``rk`` is the XXH64 of the
    text with Spark's seed 42; bits past ``n_bits`` (the last dropped line) are kept lines.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    lost = dropped_lines(rows, min_chars, min_docs, Scratch(docs.sparkSession))
    # A document's positions are no more than its own lines.
    per_doc = lost.groupBy("doc", "rk").agg(F.collect_set("pos").alias("pos"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            n = [int(max(x)) + 1 for x in p["pos"]]
            yield pd.DataFrame({"doc": p["doc"], "rk": p["rk"], "n_bits": n,
                                "bitmap": [pack_bitmap(m, np.asarray(x)) for m, x in zip(n, p["pos"], strict=True)]})
    return per_doc.mapInPandas(pack, "doc long, rk long, n_bits int, bitmap binary")


def _cut(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, cut): the columns of ``docs`` by position, and the text without dropped lines with both counts."""
    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def cut_lines(text: pd.Series, bits: pd.Series, bitmap: pd.Series) -> pd.DataFrame:
        out = []
        for t, n, m in zip(text, bits, bitmap, strict=True):
            t = t if isinstance(t, str) else ""
            if m is None:
                out.append((t, t.count("\n") + 1, 0))
                continue
            lines = t.split("\n")
            keep = unpack_bitmap(m, int(n))
            kept = [x for x, k in zip(lines, keep, strict=False) if k] + lines[len(keep):]
            out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
        return pd.DataFrame(out, columns=["kept", "n_lines", "n_dropped"])

    # The input's columns travel in a struct, so none of them can clash with these.
    d = docs.select(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("row"),
                    F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"),
                    F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
    j = d.join(bitmaps, (F.col("id") == F.col("doc")) & (F.col("h") == F.col("rk")), "left")
    return j.select("row", cut_lines("text", "n_bits", "bitmap").alias("cut"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` plus ``_kept`` (text without dropped lines), ``_n_lines`` and ``_n_dropped``.

    Columns of the input with one of these three names are replaced.
    """
    new = {"_kept": "kept", "_n_lines": "n_lines", "_n_dropped": "n_dropped"}
    return _cut(docs, bitmaps, id_col, text_col).select(
        *[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns) if c not in new],
        *[F.col("cut")[f].alias(c) for c, f in new.items()])


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, same rows and columns; a null text stays null."""
    out = _cut(docs, keep_bitmaps(docs, id_col, text_col, **params), id_col, text_col)
    own = [F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)]
    at = docs.columns.index(text_col)
    own[at] = F.when(F.col("row")[f"c{at}"].isNotNull(), F.col("cut")["kept"]).alias(text_col)
    return out.select(*own)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = apply_bitmaps(docs, keep_bitmaps(docs))
    return out.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"),
                      F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, ls[i] AS line, i FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, (s.key IS NOT NULL AND k.doc_id < s.top) AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, sum(gone::BIGINT)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
