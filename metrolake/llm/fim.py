"""Fill-in-middle transformation (operator 11).

A text is cut into units (a word with the white space before it, or white
space at the end) and at two unit ranks into prefix, middle and suffix. The
cuts are found in an indexable skip list: its bottom lane holds every unit
with its width in code points; a lane above holds about a quarter of the nodes
below, chosen by a hash of the node's number, and every node carries how many
units and how many code points it leads over. A search goes down from the head
of the top lane, forward while the units passed do not exceed the rank, and
the code points passed are the place of the cut. The texts of a batch share
one list and are searched together, a vector of cursors a lane.

Output forms: ``plain``, the text as it is; ``psm``, ``<P>prefix<S>suffix<M>middle``;
``spm``, ``<S>suffix<P>prefix<M>middle``. A text that holds a marker stays
plain, so ``restore`` finds the markers without doubt (no marker can overlap
another). Forms and ranks come from a hash of seed and id: any order of rows
and any number of partitions gives the same.

Cases: null or empty text has no units, is plain and restores to empty text; a
null id hashes as an empty string; repeated rows each come back, alike; very
long texts are one entry of the same list (a batch is cut into runs of about
``PART`` characters or one longer text); empty table: no rows; columns of the
input with the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metrolake.llm.common import short_batches, table

MARKS = ("<P>", "<S>", "<M>")
PART = 1 << 22
#: White space between units: space and U+0009 to U+000D.
_GAP = np.zeros(256, bool)
_GAP[[32, *range(9, 14)]] = True


def unit_widths(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(units of each text, code points of every unit in order), from UTF-8."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    raw = np.frombuffer(b"".join(texts), np.uint8)
    gap = _GAP[raw]
    start = np.zeros(len(raw) + 1, bool)  # a text begins here, or all end
    start[np.cumsum(size)] = True
    # A unit ends with a word, or with a text that ends in white space.
    last = start[1:] | (~gap & np.append(gap[1:], False)) if len(raw) else np.zeros(0, bool)
    at = np.flatnonzero(last)
    points = np.cumsum((raw & 0xC0) != 0x80)
    n = np.searchsorted(at, np.cumsum(size)) - np.searchsorted(at, np.cumsum(size) - size)
    return n, np.diff(points[at], prepend=0)


class SkipList:
    """An indexable skip list over units: lanes of (units, code points, node below)."""

    def __init__(self, widths: np.ndarray, up: int = 4, head: int = 8):
        units, points = np.ones(len(widths), np.int64), np.asarray(widths, np.int64)
        below = np.arange(len(widths))
        # Lane arrays: what a node leads over, and the node under it; the last entry is the lane's end.
        self.lanes = [(units, points, below)]
        coin = (np.arange(len(widths), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        coin ^= coin >> np.uint64(29)
        coin *= np.uint64(0xBF58476D1CE4E5B9)
        coin ^= coin >> np.uint64(32)
        node = below  # each node's number on the bottom lane
        for _ in range(30):  # the coin's bits
            if len(node) <= head:
                break
            heads = coin[node] % np.uint64(up) == 0
            coin = coin // np.uint64(up)
            heads[0] = True  # a lane begins where the list begins
            at = np.flatnonzero(heads)
            if len(at) == len(node):
                continue
            units, points = np.add.reduceat(units, at), np.add.reduceat(points, at)
            node = node[at]
            self.lanes.append((units, points, at))

    def points_before(self, rank: np.ndarray) -> np.ndarray:
        """Code points of the first ``rank`` units, for every rank."""
        at = np.zeros(len(rank), np.int64)
        left, got = np.array(rank, np.int64), np.zeros(len(rank), np.int64)
        for lane in range(len(self.lanes) - 1, -1, -1):
            units, points, below = self.lanes[lane]
            go = np.arange(len(left))
            while True:
                go = go[at[go] < len(units)]
                go = go[units[at[go]] <= left[go]]
                if not len(go):
                    break
                left[go] -= units[at[go]]
                got[go] += points[at[go]]
                at[go] += 1
            if lane:  # past the lane's last node is past the last node below it
                under = len(self.lanes[lane - 1][0])
                at = np.append(below, under)[at]
        return got


def _draw(seed: int, ident) -> tuple[int, int, int, int]:
    d = hashlib.sha256(f"{seed}:{'' if ident is None else ident}".encode()).hexdigest()
    return int(d[:8], 16), int(d[8:16], 16), int(d[16:24], 16), int(d[24:32], 16)


def _runs(texts: list[str]) -> Iterator[slice]:
    a = size = 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > PART:
            yield slice(a, i)
            a, size = i, 0
        size += len(t)
    if a < len(texts):
        yield slice(a, len(texts))


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                   percent: int = 50, spm_percent: int = 80) -> DataFrame:
    """``docs`` plus ``n_units``, ``form``, ``prefix_chars``, ``middle_chars`` (null if plain) and ``output``.

    ``percent`` of the texts are transformed, ``spm_percent`` of those with the suffix first.
    """
    new = ["n_units", "form", "prefix_chars", "middle_chars", "output"]
    short_batches(docs.sparkSession)
    own = docs.drop(*new)
    names = own.columns
    # The key columns go beside the input's under names that it can't have twice.
    inp = own.select(F.struct(*own.columns).alias("row") if names else F.lit(None).alias("row"),
                     F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("id").to_pylist(), [t or "" for t in b.column("t").to_pylist()]
            for s in _runs(texts):
                part = texts[s]
                n, widths = unit_widths([t.encode() for t in part])
                h = [_draw(seed, i) for i in ids[s]]
                base = np.cumsum(n) - n
                c1 = np.fromiter((x[0] % (k + 1) for x, k in zip(h, n.tolist(), strict=True)), np.int64, len(h))
                c2 = np.fromiter((x[1] % (k + 1) for x, k in zip(h, n.tolist(), strict=True)), np.int64, len(h))
                lanes = SkipList(widths)
                start, one, two = np.split(lanes.points_before(np.concatenate(
                    [base, base + np.minimum(c1, c2), base + np.maximum(c1, c2)])), 3)
                one, two = (one - start).tolist(), (two - start).tolist()
                form, pre, mid, out = [], [], [], []
                for t, x, a, z in zip(part, h, one, two, strict=True):
                    if not t or x[2] % 100 >= percent or any(m in t for m in MARKS):
                        form.append("plain")
                        pre.append(None)
                        mid.append(None)
                        out.append(t)
                        continue
                    p, m, u = t[:a], t[a:z], t[z:]
                    spm = x[3] % 100 < spm_percent
                    form.append("spm" if spm else "psm")
                    pre.append(a)
                    mid.append(z - a)
                    out.append(f"<S>{u}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{u}<M>{m}")
                yield pa.RecordBatch.from_arrays(
                    [b.column("row").slice(s.start, s.stop - s.start), pa.array(n), pa.array(form, pa.string()),
                     pa.array(pre, pa.int64()), pa.array(mid, pa.int64()), pa.array(out, pa.string())],
                    names=["row", *new])
    schema = (f"row {inp.schema['row'].dataType.simpleString()}, n_units long, form string, prefix_chars long, "
              "middle_chars long, output string")
    out = inp.mapInArrow(run, schema)
    return out.select(*[F.col("row")[c].alias(c) for c in names], *new)


def restored(output: str | None, form: str | None) -> str | None:
    """The text that an output was made of."""
    if output is None or form is None or form == "plain":
        return output
    if form == "psm":
        p, rest = output[len("<P>"):].split("<S>", 1)
        s, m = rest.split("<M>", 1)
    else:
        s, rest = output[len("<S>"):].split("<P>", 1)
        p, m = rest.split("<M>", 1)
    return p + m + s


def restore(output: Column | str, form: Column | str) -> Column:
    """``restored`` as a column."""
    @F.pandas_udf("string")
    def run(o: pd.Series, f: pd.Series) -> pd.Series:
        return pd.Series([restored(x, y) for x, y in zip(o, f, strict=True)], dtype=object)
    return run(output, form)


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    return out.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restore("output", "form").cast("binary"), 256).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS x FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS us,
             ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3,
             ('0x' || x[25:32])::BIGINT AS h4 FROM d),
c AS (SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a,
             greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS z,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50
                  THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:z], '') AS mid,
             array_to_string(us[z + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
