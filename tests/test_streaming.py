import os
import tempfile

from metrolake.plans.store import Store
from metrolake.streaming.dropfolder import processed_files, run_drop_folder_once

from .conftest import write_csv


def test_drop_folder_processes_only_new_files(spark, fixture_dir, store_dir):
    ckpt = tempfile.mkdtemp(prefix="metrolake-stream-")
    run_drop_folder_once(spark, fixture_dir, store_dir, ckpt, as_of="2024-03-10 00:00:00")
    st = Store(spark, store_dir)
    assert st.committed_runs().count() == 3
    write_csv(os.path.join(fixture_dir, "later.csv"), day="2024-03-05")
    run_drop_folder_once(spark, fixture_dir, store_dir, ckpt, as_of="2024-03-10 00:00:00")
    assert st.committed_runs().count() == 4
    assert st.ledger().count() == 4                       # the second batch saw only the new file
    assert processed_files(spark, store_dir).first()["filename"] == "later.csv"
    # A fresh checkpoint replays all files; the hash skip keeps the store unchanged.
    run_drop_folder_once(spark, fixture_dir, store_dir, tempfile.mkdtemp(), as_of="2024-03-10 00:00:00")
    assert st.committed_runs().count() == 4
    assert st.measurement_frame().count() == 32
