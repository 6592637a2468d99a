"""CSV quoting against pandas, with splits inside records."""

import io
import os
import random
import tempfile

import pandas as pd
import pytest

from metrolake.sources import parsers
from metrolake.sources.csv_records import whole_records


def _frame(spark, files, split):
    """Lines of several files, dealt over splits of ``split`` lines."""
    rows = [(p, k // split, k, line) for p, text in files.items() for k, line in enumerate(text.split("\n"))]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "path string, row_block long, row_idx long, line string").repartition(3)


def _got(batch):
    rows, out = batch.rows.orderBy("path", "row_block", "row_idx").collect(), {}
    for r in rows:
        out.setdefault(r["path"], []).append(r["fields"])
    return out, {r["path"]: r["message"] for r in batch.errors.collect()}


def _pandas(text):
    try:
        df = pd.read_csv(io.StringIO(text), dtype=str, index_col=False)
    except pd.errors.ParserError:
        return None
    return [{c: None if pd.isna(v) else v for c, v in r.items()} for r in df.to_dict("records")]


def _random_file(rng, rows):
    """Records of three fields with quotes of every kind; sometimes one that is never closed."""
    plain = ["a", "1.5", "", 'P"50', 'x"', 'say "hi" now', " sp ", '"']
    quoted = ['"q"', '"a,b"', '"two ""quotes"""', '"line\none"', '"\n\n"', '"tail"end', '"t"a"il', '""', '"a\n"",\nb"']
    lines = ["one,two,three"]
    for _ in range(rows):
        n = rng.choice([3, 3, 3, 2])
        f = [rng.choice(quoted if rng.random() < 0.3 else plain[:-1] if rng.random() < 0.9 else plain) for _ in range(n)]
        if not any(f):
            f[0] = "k"
        lines.append(",".join(f))
    return "\n".join(lines)


@pytest.mark.parametrize("split", [1, 3, 1000])
def test_quotes_equal_pandas(spark, split):
    rng = random.Random(split)
    files = {f"f{k}": _random_file(rng, rng.choice([1, 5, 40])) for k in range(40)}
    want = {p: _pandas(t) for p, t in files.items()}
    got, errors = _got(parsers.parse_csv(_frame(spark, files, split)))
    assert set(errors) == {p for p, w in want.items() if w is None}
    assert 0 < len(errors) < 30
    for p, w in want.items():
        if w is not None:
            assert got.get(p, []) == w, (p, files[p])


def test_stray_quote_costs_no_rows(spark):
    d = tempfile.mkdtemp()
    path = os.path.join(d, "a.csv")
    with open(path, "w") as f:
        f.write("position,actual,expected\n" + "".join(
            f'P"{i},1.0,1.0\n' if i == 50 else f"P{i},1.0,1.0\n" for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        b = parsers.parse_csv(parsers.read_lines(spark, [path]))
        rows = [r["fields"]["position"] for r in b.rows.orderBy("row_block", "row_idx").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert rows == [f'P"{i}' if i == 50 else f"P{i}" for i in range(1000)] and b.errors.count() == 0


def test_wide_rows_and_unclosed_files_are_errors(spark):
    files = {"wide": "a,b\n1,2\n1,2,3\n\"x,y\",2\n1,2,\n9,9,9,9", "open": 'a,b\n1,"2\n3,4\n5,6', "good": 'a,b\n"1\n2",3',
             "lines": "a\n" + '"' + "\n".join(map(str, range(500))) + '"'}
    got, errors = _got(parsers.parse_csv(_frame(spark, files, 7)))
    assert set(got) == {"good", "lines"} and got["good"] == [{"a": "1\n2", "b": "3"}]
    assert got["lines"] == [{"a": "\n".join(map(str, range(500)))}]
    assert errors == {"wide": "Error tokenizing data: 2 row(s) with more fields than the header",
                      "open": "Error tokenizing data: end of file inside quotes"}


def test_windows_over_lines_are_cut_by_split(spark):
    lines = _frame(spark, {"f": "a\n" + "\n".join(['"x\ny"'] * 50)}, 5)
    records = whole_records(lines)[0]
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    over_lines = [w for w in plan.split("windowspecdefinition(")[1:] if "row_idx" in w.split("specifiedwindowframe")[0]]
    assert over_lines and all("path" in w[:12] and "row_block" in w.split("row_idx")[0] for w in over_lines)
    assert sorted(r["line"] for r in records.collect()) == sorted(["a", *['"x\ny"'] * 50])


def test_long_lines_need_no_stack(spark):
    line = ",".join(['"' + '""' * 3000 + 'a"'] * 20 + ["x"] * 5000)
    files = {"f": ",".join(f"c{k}" for k in range(5020)) + "\n" + line}
    got, errors = _got(parsers.parse_csv(_frame(spark, files, 9)))
    assert not errors and got["f"][0]["c0"] == '"' * 3000 + "a" and got["f"][0]["c5019"] == "x"
