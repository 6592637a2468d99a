"""Exact dedup by content sort (operator 13).

Texts are bytes. Sampled splitters cut them into ranges, Spark's external
sort puts equal texts next to each other, and one pass over a partition
compares every text with its neighbour in full. Of equal texts one row stays,
the one with the largest (or, by ``keep``, the smallest) id.

The order is (first ``HEAD`` bytes, XXH64, all bytes, id): splitters, which
pass through the driver, hold a bounded head of a text, and texts that share a
long head are still cut apart. The id in the splitters cuts a group of copies
too, so a group of any size is dealt over many partitions. A run of equal
texts that may go on in another partition (its head and hash are those of the
partition's first or last row), or that is longer than ``HOLD`` rows, can't be
closed in its task: its rows go out at once with the run's number, and the
runs' texts (a few a partition) are grouped by their full bytes afterwards.

Cases: null text is empty text, and all empty texts are equal; a null id is
after all others and stays only where no other row of the group has one (the
group's keep_id is then null); of rows with equal id and text exactly one
stays; very long texts are compared and hashed whole, one batch of rows is in
memory; empty table: no rows; input columns of any name are carried through in
a struct, and come back where the three result columns don't have their name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metrolake.llm.common import Scratch, cut, short_batches, table

HEAD = 64
HOLD = 10_000
#: Settled runs (three numbers each) up to this many are broadcast; more are joined by AQE's choice.
MAX_BROADCAST = 200_000
_OUT = [("id", pa.int64()), ("keep", pa.int64()), ("size", pa.int64()), ("first", pa.bool_()), ("sha", pa.string()),
        ("run", pa.int64()), ("text", pa.binary())]
_OUT_DDL = "id long, keep long, size long, first boolean, sha string, run long, text binary"


class _Run:
    """Equal texts met in a row: its rows are held until its size is known, or sent as an open run."""

    def __init__(self, text: bytes, key: tuple, top: int | None):
        self.text, self.key, self.top = text, key, top
        self.sha = hashlib.sha256(text).hexdigest()
        self.n, self.open, self.held = 0, None, []  # held: (ids, slice of carried rows)


def _stream(hold: int):
    """Sorted rows of one partition -> rows of closed runs, rows of open runs, and a row with text for each open run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = TaskContext.get().partitionId(), 0
        first_key, cur, waiting = None, None, []
        cols: list[list] = [[] for _ in _OUT]
        carried: list[pa.Array] = []
        row_type = None

        def rows(r: _Run, ids: list, carry, first: bool) -> None:
            n = len(ids)
            if r.open is None:
                values = ([r.top] * n, [r.n] * n, [first] + [False] * (n - 1), [r.sha] * n, [None] * n, [None] * n)
            else:
                values = ([None] * n, [None] * n, [first] + [False] * (n - 1), [r.sha] * n, [r.open] * n, [None] * n)
            for c, v in zip(cols, (ids, *values), strict=True):
                c += v
            if carry is not None:
                carried.append(carry)

        def release(r: _Run) -> None:
            sent = r.n - sum(len(i) for i, _ in r.held)
            for k, (ids, carry) in enumerate(r.held):
                rows(r, ids, carry, not sent and not k)
            r.held = []

        def open_run(r: _Run) -> None:
            nonlocal runs
            if r.open is None:
                r.open = part << 33 | runs
                runs += 1
            release(r)

        def close(r: _Run) -> None:  # all its rows are known
            if r.open is None:
                return release(r)
            release(r)
            for c, v in zip(cols, (r.top, None, r.n, None, None, r.open, r.text), strict=True):
                c.append(v)
            if row_type is not None:
                carried.append(pa.nulls(1, row_type))

        def flush() -> Iterator[pa.RecordBatch]:
            if cols[0]:
                arrays = [pa.array(c, t) for c, (_, t) in zip(cols, _OUT, strict=True)]
                names = [n for n, _ in _OUT]
                if row_type is not None:
                    arrays.append(pa.concat_arrays(carried))
                    names.append("row")
                yield pa.RecordBatch.from_arrays(arrays, names=names)
                for c in cols:
                    c.clear()
                carried.clear()

        for b in batches:
            if not b.num_rows:
                continue
            ids, texts, h = b.column("id").to_pylist(), b.column("t").to_pylist(), b.column("h").to_pylist()
            carry = b.column("row") if "row" in b.schema.names else None
            row_type = None if carry is None else carry.type
            a = 0
            while a < len(ids):
                text, z = texts[a], a + 1
                while z < len(ids) and texts[z] == text:
                    z += 1
                if cur is None or text != cur.text:
                    key = (text[:HEAD], h[a])
                    if first_key is None:
                        first_key = key
                    if cur is not None:
                        waiting.append(cur)
                        if key != cur.key:  # a new key: the runs before it end here
                            for r in waiting:
                                if r.key == first_key:
                                    open_run(r)
                                close(r)
                            waiting = []
                    cur = _Run(text, key, ids[a])
                cur.n += z - a
                cur.held.append((ids[a:z], None if carry is None else carry.slice(a, z - a)))
                if cur.open is not None or sum(len(i) for i, _ in cur.held) > hold:
                    open_run(cur)
                a = z
            yield from flush()
        for r in [*waiting, cur] if cur is not None else []:
            open_run(r)
            close(r)
        yield from flush()
    return run


def mark_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest",
                normalise: Callable[[Column], Column] | None = None, carry: list[str] | None = None,
                partitions: int | None = None, hold: int = HOLD) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``sha256`` of the text compared.

    ``row`` is a struct of the columns named in ``carry`` (none: no such column). ``normalise`` maps the text
    column to the text that is compared; texts are compared as they are without it.
    """
    if keep not in ("largest", "smallest"):
        raise ValueError("keep is largest or smallest")
    spark = docs.sparkSession
    short_batches(spark)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text = F.coalesce(normalise(text), F.lit("")) if normalise else text
    own = [F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("t")]
    if carry:
        own.append(F.struct(*[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)]).alias("row"))
    d = docs.select(*own).withColumn("h", F.xxhash64("t"))
    head = F.substring("t", 1, HEAD)
    by_id = F.col("id").desc_nulls_last() if keep == "largest" else F.col("id").asc_nulls_last()
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = d.repartitionByRange(n, head, "h", by_id).sortWithinPartitions(head, "h", "t", by_id)
    schema = _OUT_DDL + (f", row {d.schema['row'].dataType.simpleString()}" if carry else "")
    # Read twice below, and another run may cut the ranges elsewhere: write it once.
    said, _ = Scratch(spark).save(sorted_.mapInArrow(_stream(hold), schema), "runs")
    same = Window.partitionBy("text")  # grouped by full bytes; at most a few runs a partition of the sort
    best = (F.max if keep == "largest" else F.min)("id").over(same)
    runs = cut(said.filter("text is not null").select(
        F.col("run").alias("_run"), best.alias("_keep"), F.sum("size").over(same).alias("_size"),
        (F.min("run").over(same) == F.col("run")).alias("_lead")))
    rows = said.filter("text is null")
    runs = F.broadcast(runs) if runs.count() <= MAX_BROADCAST else runs
    j = rows.filter("run is not null").join(runs, F.col("run") == F.col("_run"))
    last = [F.col("row")] if carry else []
    closed = rows.filter("run is null").select("id", F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
                                               F.col("first").alias("kept"), F.col("sha").alias("sha256"), *last)
    return closed.unionByName(j.select("id", F.col("_keep").alias("keep_id"), F.col("_size").alias("group_size"),
                                       (F.col("first") & F.col("_lead")).alias("kept"), F.col("sha").alias("sha256"),
                                       *last))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that stay, same columns."""
    out = mark_copies(docs, id_col, text_col, carry=docs.columns, **params).filter("kept")
    return out.select(*[F.col("row")[f"c{k}"].alias(c) for k, c in enumerate(docs.columns)])


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mark_copies(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


ORACLE_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""
