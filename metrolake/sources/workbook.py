"""Workbook source (S2): ``.xlsx`` files, first sheet that has data rows.

Spark's ``binaryFile`` source hands each workbook's bytes to a task;
``mapInPandas`` decodes them with the standard library (a workbook is a zip
of XML parts) into one output row per sheet row: the header cells and the
row's cells as text. Header cleaning and the field map are then built with
Spark expressions, as for the other formats. ``.xls`` (binary) is not read;
such files come back as errors.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..functions.columns import null_if_token, strip
from .files import literal_path
from ..functions.maps import fit_to, last_wins_policy, map_last_wins
from .parsers import RawBatch

_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main",
       "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships",
       "pr": "http://schemas.openxmlformats.org/package/2006/relationships"}
# Built-in number formats that show dates / times.
_DATE_FMT_IDS = set(range(14, 23)) | {45, 46, 47}
_EXCEL_EPOCH = _dt.datetime(1899, 12, 30)

OUT_SCHEMA = "path string, row_idx long, header array<string>, cells array<string>, error string"


def _col_index(ref: str) -> int:
    letters = re.match(r"[A-Z]+", ref).group(0)
    n = 0
    for ch in letters:
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _text(el) -> str:
    return "".join(t.text or "" for t in el.iter(f"{{{_NS['m']}}}t"))


def _date_styles(z: zipfile.ZipFile) -> set[int]:
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    custom = {int(f.get("numFmtId")) for f in root.iter(f"{{{_NS['m']}}}numFmt")
              if re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", f.get("formatCode", "")), re.I)}
    xfs = root.find("m:cellXfs", _NS)
    out = set()
    for i, xf in enumerate(xfs if xfs is not None else []):
        fid = int(xf.get("numFmtId", "0"))
        if fid in _DATE_FMT_IDS or fid in custom:
            out.add(i)
    return out


def _sheet_rows(z: zipfile.ZipFile, target: str, shared: list[str], dates: set[int],
                date1904: bool = False) -> list[list]:
    root = ET.fromstring(z.read(target))
    rows = []
    for r in root.iter(f"{{{_NS['m']}}}row"):
        cells = {}
        for c in r.findall("m:c", _NS):
            t, s = c.get("t", "n"), int(c.get("s", "0"))
            v = c.find("m:v", _NS)
            if t == "inlineStr":
                val = _text(c.find("m:is", _NS))
            elif v is None:
                continue
            elif t == "s":
                val = shared[int(v.text)]
            elif t == "b":
                val = "True" if v.text == "1" else "False"
            elif t in ("str", "e"):
                val = v.text
            elif s in dates:
                ms = round(float(v.text) * 86_400_000)  # a day fraction is exact to about a microsecond
                at = (_EXCEL_EPOCH if not date1904 else _dt.datetime(1904, 1, 1)) + _dt.timedelta(milliseconds=ms)
                val = at.strftime("%Y-%m-%d %H:%M:%S") + (f".{ms % 1000:03d}" if ms % 1000 else "")
            else:
                val = v.text
            cells[_col_index(c.get("r"))] = val
        if cells:
            width = max(cells) + 1
            rows.append([cells.get(i) for i in range(width)])
    return rows


def decode_workbook(data: bytes) -> list[list]:
    """Rows (header first) of the first sheet that has a data row."""
    z = zipfile.ZipFile(io.BytesIO(data))
    shared = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = [_text(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    dates = _date_styles(z)
    book = ET.fromstring(z.read("xl/workbook.xml"))
    props = book.find("m:workbookPr", _NS)
    date1904 = props is not None and props.get("date1904") in ("1", "true")
    for sh in book.iter(f"{{{_NS['m']}}}sheet"):
        target = rels[sh.get(f"{{{_NS['r']}}}id")].lstrip("/")
        target = target if target.startswith("xl/") else "xl/" + target
        rows = _sheet_rows(z, target, shared, dates, date1904)
        if len(rows) > 1:
            return rows
    raise ValueError("No non-empty sheet found")


def _decode_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            out = []  # one workbook at a time
            try:
                if str(path).lower().endswith(".xls"):
                    raise ValueError("binary .xls workbooks are not supported")
                rows = decode_workbook(bytes(content))
                header = ["" if h is None else str(h) for h in rows[0]]
                for i, r in enumerate(rows[1:]):
                    out.append((path, i, header, [None if v is None else str(v) for v in r], None))
            except Exception as exc:  # noqa: BLE001 - any decode problem is the file's extract error
                out.append((path, -1, None, None, f"{type(exc).__name__}: {exc} in {path}"))
            yield pd.DataFrame(out, columns=["path", "row_idx", "header", "cells", "error"])


def parse_workbooks(spark: SparkSession, paths: list[str]) -> RawBatch:
    decoded = (spark.read.format("binaryFile").load([literal_path(p) for p in paths]).select("path", "content")
               .mapInPandas(_decode_batches, OUT_SCHEMA))
    ok = decoded.filter(F.col("error").isNull())
    cols = F.transform("header", lambda c: F.regexp_replace(F.lower(strip(c)), r"\s+", "_"))
    staged = ok.select("path", "row_idx", cols.alias("_cols"), "cells")
    staged = staged.select("path", "row_idx", "_cols",
                           F.transform(fit_to(F.col("cells"), F.size("_cols")), lambda v: null_if_token(v)).alias("_v"))
    rows = staged.select("path", F.lit(0).cast("long").alias("row_block"), "row_idx",
                         map_last_wins(F.col("_cols"), F.col("_v"), last_wins_policy(spark)).alias("fields"))
    files = staged.groupBy("path").agg(F.first("_cols").alias("raw_cols"))
    errors = decoded.filter(F.col("error").isNotNull()).select("path", F.col("error").alias("message"))
    return RawBatch(rows, files, errors)
