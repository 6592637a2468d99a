from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from metrolake.session import get_spark  # noqa: E402

POSITIONS = ["POS_A1", "POS_A2", "POS_A3", "POS_B1", "POS_B2", "POS_B3",
             "POS_C1", "POS_C2", "POS_C3", "POS_D1"]
AXIS = {"A": "X", "D": "X", "B": "Y", "C": "Z"}
# Deviation of each row in units of 0.001 (expected value 10.000 everywhere).
F1_DEV = [2, -2, 5, 1, -3, 3, 0, -1, 4, 550]
F2_DEV = [1, -1, 3, 2, -2, 1]
F3_DEV = [2, -3, 4, 1, -1, 3]


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", shuffle_partitions=4)
    yield s


def write_csv(path, devs=F1_DEV, day="2024-03-01", hour=8, operator="OP001", equipment="TOOL_X1",
              header="timestamp,position,actual_value,expected_value,operator,equipment_id,axis,unit"):
    with open(path, "w") as f:
        f.write(header + "\n")
        for i, d in enumerate(devs):
            p = POSITIONS[i % 10]
            f.write(f"{day} {hour:02d}:{i:02d}:00,{p},{10 + d / 1000:.3f},10.000,{operator},{equipment},"
                    f"{AXIS[p[4]]},mm\n")


def write_json(path, devs=F2_DEV, day="2024-03-02", hour=9, operator="OP002", equipment="TOOL_X1"):
    recs = [{"timestamp": f"{day} {hour:02d}:{i:02d}:00", "position": POSITIONS[i], "actual_value":
             round(10 + d / 1000, 3), "expected_value": 10.0, "operator": operator, "equipment_id": equipment,
             "axis": AXIS[POSITIONS[i][4]], "unit": "mm"} for i, d in enumerate(devs)]
    with open(path, "w") as f:
        json.dump({"data": recs}, f, indent=1)


def write_log(path, devs=F3_DEV, day="2024-03-03", hour=10, operator="OP003", equipment="TOOL_X2"):
    with open(path, "w") as f:
        f.write("# Sample calibration log file\n# Format: [TIMESTAMP] POSITION=<pos> ACTUAL=<val>\n")
        for i, d in enumerate(devs):
            f.write(f"[{day} {hour:02d}:{i:02d}:00] POSITION={POSITIONS[i]} ACTUAL={10 + d / 1000:.3f} "
                    f"EXPECTED=10.000 EQUIPMENT={equipment} OPERATOR={operator}\n")


@pytest.fixture()
def fixture_dir():
    d = tempfile.mkdtemp(prefix="metrolake-fx-")
    write_csv(os.path.join(d, "sample_calibration.csv"))
    write_json(os.path.join(d, "sample_calibration.json"))
    write_log(os.path.join(d, "sample_calibration.log"))
    os.utime(os.path.join(d, "sample_calibration.csv"), (1_700_000_000, 1_700_000_000))
    os.utime(os.path.join(d, "sample_calibration.json"), (1_700_000_100, 1_700_000_100))
    os.utime(os.path.join(d, "sample_calibration.log"), (1_700_000_200, 1_700_000_200))
    return d


@pytest.fixture()
def store_dir():
    return tempfile.mkdtemp(prefix="metrolake-store-")


def write_xlsx(path, header, rows, sheets_before_empty=0, date_cols=()):
    """Minimal workbook writer for tests (shared strings, numbers, date style)."""
    import zipfile
    from xml.sax.saxutils import escape
    strings: list[str] = []

    def sidx(s):
        if s not in strings:
            strings.append(s)
        return strings.index(s)

    def col(i):
        out = ""
        i += 1
        while i:
            i, r = divmod(i - 1, 26)
            out = chr(65 + r) + out
        return out

    def cell(ci, ri, v):
        ref = f"{col(ci)}{ri}"
        if v is None:
            return ""
        if ci in date_cols and isinstance(v, float):
            return f'<c r="{ref}" s="1"><v>{v}</v></c>'
        if isinstance(v, (int, float)):
            return f'<c r="{ref}"><v>{v}</v></c>'
        return f'<c r="{ref}" t="s"><v>{sidx(str(v))}</v></c>'

    def sheet(all_rows):
        body = "".join(f'<row r="{ri + 1}">' + "".join(cell(ci, ri + 1, v) for ci, v in enumerate(r)) + "</row>"
                       for ri, r in enumerate(all_rows))
        return ('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
                f"<sheetData>{body}</sheetData></worksheet>")

    sheets = [sheet([]) for _ in range(sheets_before_empty)] + [sheet([header] + rows)]
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" ' \
         'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    wb = f"<workbook {ns}><sheets>" + "".join(
        f'<sheet name="S{i}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i in range(len(sheets))) + "</sheets></workbook>"
    rels = '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(
        f'<Relationship Id="rId{i + 1}" Type="worksheet" Target="worksheets/sheet{i + 1}.xml"/>'
        for i in range(len(sheets))) + "</Relationships>"
    sheet_xml = [s for s in sheets]
    sst = '<sst xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">' + "".join(
        f"<si><t>{escape(s)}</t></si>" for s in strings) + "</sst>"
    styles = ('<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><cellXfs>'
              '<xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>')
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", wb)
        z.writestr("xl/_rels/workbook.xml.rels", rels)
        for i, s in enumerate(sheet_xml):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", s)
        z.writestr("xl/sharedStrings.xml", sst)
        z.writestr("xl/styles.xml", styles)
