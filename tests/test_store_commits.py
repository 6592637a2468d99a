"""Versioned commits of the store, the hour index, and files that can't be transformed."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from metrolake.operators.validation import hour_index, store_overlap
from metrolake.plans import ingest
from metrolake.plans.ingest import ingest_folder
from metrolake.plans.store import Conflict, Store
from metrolake.sources.files import streamed_hashes

from .conftest import write_csv

AS_OF = "2024-03-10 00:00:00"


def test_one_of_two_commits_wins(spark, tmp_path):
    root = str(tmp_path / "store")
    a, b = Store(spark, root).pinned(), Store(spark, root).pinned()
    for s, n in ((a, 3), (b, 5)):
        s.append("runs", spark.range(n).selectExpr(
            "id AS run_id", "timestamp_ntz'2024-03-01 00:00:00' AS timestamp", "'o' AS operator", "'t' AS equipment_id",
            "'f' AS source_file", "'' AS notes", "timestamp_ntz'2024-03-01 00:00:00' AS created_at", "'h' AS file_hash"))
    reader = Store(spark, root)
    assert reader.latest() == 0 and reader.committed_runs().count() == 0
    assert b.commit() == 1
    with pytest.raises(Conflict):
        a.commit()
    assert reader.committed_runs().count() == 5 and reader.table("runs").count() == 8
    old = reader.pinned()
    c = Store(spark, root).pinned()
    c.append("runs", a.table("runs").filter(F.col("load_id") == a.load_id))
    assert c.commit() == 2
    assert old.committed_runs().count() == 5 and reader.committed_runs().count() == 8


def test_two_loads_at_once_both_end_up_in_the_store(spark, tmp_path, monkeypatch):
    one, two, root = tmp_path / "one", tmp_path / "two", str(tmp_path / "store")
    for d, day in ((one, "2024-03-01"), (two, "2024-03-02")):
        d.mkdir()
        write_csv(d / "a.csv", devs=[1, 2, 3, 4, 5, 6], day=day)
    write_csv(two / "same.csv", devs=[1, 2, 3, 4, 5, 6], day="2024-03-01")  # equal to the other folder's file
    real, inner, seen = Store.commit, [], []

    def commit(self):
        # While the first load is about to commit, a whole second one runs and takes its version.
        if not inner:
            inner.append(1)
            seen.extend((r.file, r.status) for r in ingest_folder(spark, str(two), root, as_of=AS_OF).collect())
        return real(self)
    monkeypatch.setattr(Store, "commit", commit)
    got = [(r.file, r.status) for r in ingest_folder(spark, str(one), root, as_of=AS_OF).collect()]
    assert sorted(seen) == [("a.csv", "success"), ("same.csv", "success")]
    assert got == [("a.csv", "skipped_duplicate")]  # it started again and saw the other's content
    s = Store(spark, root)
    assert s.latest() == 2 and s.committed_runs().count() == 2
    m = s.measurements()
    assert m.count() == 12 and m.select("measurement_id").distinct().count() == 12
    assert s.table("measurements").count() == 18  # the lost attempt's rows stay unseen


def test_a_load_that_always_loses_gives_up(spark, tmp_path, monkeypatch):
    src = tmp_path / "in"
    src.mkdir()
    write_csv(src / "a.csv", devs=[1, 2, 3, 4, 5, 6])

    def commit(self):
        raise Conflict("taken")
    monkeypatch.setattr(Store, "commit", commit)
    with pytest.raises(Conflict):
        ingest_folder(spark, str(src), str(tmp_path / "store"), as_of=AS_OF, attempts=2)


def test_hour_index_follows_the_loads(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    for k in range(3):
        write_csv(src / f"{k}.csv", devs=list(range(1, 8 + k)), day=f"2024-0{k + 1}-05", hour=7 + k)
        ingest_folder(spark, str(src), root, as_of=AS_OF)
        s = Store(spark, root)
        got = sorted(map(tuple, s.hour_index().collect()))
        want = {}
        for r in s.measurements().collect():
            h = int(r.timestamp.replace(tzinfo=dt.timezone.utc).timestamp()) // 3600
            want[h] = want.get(h, 0) + 1
        total, rows = 0, []
        for h in sorted(want):
            total += want[h]
            rows.append((h, want[h], total))
        assert got == rows and total == sum(range(7, 8 + k))


def test_store_overlap_by_index_equals_brute_force(spark):
    rng = random.Random(3)
    base = dt.datetime(2024, 1, 1)
    # Gaps of months, hours with many equal times, a few hours far away.
    times = [base + dt.timedelta(hours=rng.choice([0, 1, 2, 30, 2000, 2001, 9000]), seconds=rng.randrange(7200) // 600 * 600)
             for _ in range(400)] + [dt.datetime(1971, 1, 1), None]
    stored = spark.createDataFrame([(t,) for t in times], "timestamp timestamp_ntz").withColumn(
        "ts_date", F.to_date("timestamp"))
    ranges = []
    for k in range(60):
        lo = base + dt.timedelta(hours=rng.randrange(-50, 9100), seconds=rng.randrange(12) * 600)
        ranges.append((f"f{k}", lo, lo + dt.timedelta(seconds=rng.choice([0, 600, 3600, 7200, 10 ** 6, 10 ** 7]))))
    df = spark.createDataFrame(ranges, "source_file string, ts_min timestamp_ntz, ts_max timestamp_ntz")
    w = dt.timedelta(hours=0.5)
    want = {f: sum(t is not None and lo - w <= t <= hi + w for t in times) for f, lo, hi in ranges}
    for index in (None, hour_index(stored)):
        out = store_overlap(None, stored, 0.5, ranges=df, index=index)
        assert {r.source_file: r.n_stored_in_range for r in out.collect()} == want


def test_transform_error_leaves_its_neighbours_alone(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "good.csv", devs=[1, 2, 3, 4, 5, 6])
    (src / "bad.csv").write_text("Position,position ,actual,expected\n" + "P,P,1,1\n" * 6)
    (src / "open.csv").write_text('position,actual,expected\n"P,1,1\n')
    for dry in (True, False):
        got = {r.file: (r.status, r.rows, r.message) for r in
               ingest_folder(spark, str(src), root, as_of=AS_OF, dry_run=dry).collect()}
        assert got["bad.csv"] == ("transform_error", 0, "Columns that occur more than once: position")
        assert got["open.csv"][0] == "extract_error" and got["good.csv"][:2] == ("dry_run" if dry else "success", 6)
    counts = {r.status: r.files for r in ingest.outcome_counts(ingest_folder(spark, str(src), root, as_of=AS_OF)).collect()}
    assert counts == {"transform_error": 1, "extract_error": 1, "skipped_duplicate": 1}
    assert Store(spark, root).committed_runs().count() == 1


def test_large_files_are_hashed_in_chunks_and_documents_refused(spark, tmp_path, monkeypatch):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "large.csv", devs=list(range(1, 400)))
    write_csv(src / "small file.csv", devs=[1, 2, 3, 4, 5, 6], day="2024-03-02")
    (src / "large.json").write_text("[" + ",".join(['{"position": "P"}'] * 400) + "]")
    monkeypatch.setattr(ingest, "MAX_BYTES", 2000)
    got = {r.file: (r.status, r.rows) for r in ingest_folder(spark, str(src), root, as_of=AS_OF, force=True).collect()}
    assert got == {"large.csv": ("success", 399), "small file.csv": ("success", 6), "large.json": ("extract_error", 0)}
    ledger = {r.filename: (r.file_hash, r.error_message) for r in Store(spark, root).ledger().collect()}
    for name in ("large.csv", "small file.csv"):
        assert ledger[name][0] == hashlib.sha256((src / name).read_bytes()).hexdigest()
    assert "too large for a document" in ledger["large.json"][1]
    paths = spark.createDataFrame([(f"file:{src}/large.csv",), (f"{src}/small file.csv",)], "path string")
    assert {r.path: r.file_hash for r in streamed_hashes(paths, chunk=7).collect()} == {
        f"file:{src}/large.csv": ledger["large.csv"][0], f"{src}/small file.csv": ledger["small file.csv"][0]}
