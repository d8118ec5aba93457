import io
import struct
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tractloom import publish
from tractloom.operators import checks
from tractloom.plans import catalog
from tractloom.sources import household_file, shapes, worksheet

FIELDS = [("STATEFP", 2), ("COUNTYFP", 3), ("TRACTCE", 6), ("GEOID", 11), ("INTPTLAT", 11), ("INTPTLON", 12)]
RECORDS = [("55", "079", "000100", "55079000100", "+43.0000000", "-087.9000000"), ("55", "089", "000100", "55089000100", "", "x")]


def dbf(records=RECORDS, deleted=False):
    width = 1 + sum(n for _, n in FIELDS)
    head = 32 + 32 * len(FIELDS) + 1
    out = struct.pack("<B3BIHH20x", 3, 24, 1, 1, len(records), head, width)
    for name, n in FIELDS:
        out += name.encode().ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([n]) + b"\0" * 15
    out += b"\r"
    for r in records:
        out += (b"*" if deleted else b" ") + b"".join(v.encode().ljust(n) for v, (_, n) in zip(r, FIELDS, strict=True))
    return out


def shp(shapes_, kind=5):
    body = b""
    for k, rings in enumerate(shapes_, 1):
        pts = [p for r in rings for p in r]
        starts = np.cumsum([0] + [len(r) for r in rings[:-1]])
        content = struct.pack("<I4d2I", kind, 0, 0, 1, 1, len(rings), len(pts)) + b"".join(struct.pack("<I", s) for s in starts) + b"".join(struct.pack("<2d", *p) for p in pts)
        body += struct.pack(">II", k, len(content) // 2) + content
    return struct.pack(">I20xI", 9994, (100 + len(body)) // 2) + struct.pack("<II8d", 1000, kind, *[0.0] * 8) + body


OUTER = [(0.0, 0.0), (0.0, 4.0), (4.0, 4.0), (4.0, 0.0), (0.0, 0.0)]
HOLE = [(1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (1.0, 2.0), (1.0, 1.0)]


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name.replace("_", "."), data)


def test_tract_files(spark, tmp_path):
    zipped(tmp_path / "t.zip", t_dbf=dbf(), t_shp=shp([[OUTER, HOLE], [OUTER]]))
    rows = shapes.read_tracts(spark, str(tmp_path / "t.zip")).orderBy("record_no").collect()
    assert [(r.record_no, r.GEOID, r.INTPTLAT) for r in rows] == [(1, "55079000100", "+43.0000000"), (2, "55089000100", "")]
    assert len(rows[0].polygons) == 1 and len(rows[0].polygons[0].outer) == 5 and len(rows[0].polygons[0].holes) == 1 and not rows[1].polygons[0].holes


@pytest.mark.parametrize(
    ("data", "code"),
    [(b"x", "GEO04_DBF_INVALID"), (dbf()[:-3], "GEO04_DBF_TRUNCATED"), (dbf(deleted=True), "GEO04_DBF_DELETED_ROW"), (dbf()[:8] + b"\x21\x00" + dbf()[10:], "GEO04_DBF_INVALID")],
)
def test_bad_attribute_files(data, code):
    with pytest.raises(checks.ConformanceError, match=code):
        list(shapes.attribute_records(data))


@pytest.mark.parametrize(
    ("data", "code"),
    [
        (b"x" * 100, "TIGER_SHP_INVALID"), (shp([[OUTER]]) + b"\0\0", "TIGER_SHP_LENGTH_MISMATCH"), (shp([[OUTER]], 3), "TIGER_SHP_TYPE_INVALID"), (shp([[OUTER[:-1]]]), "TIGER_SHP_RING_INVALID"), (shp([[OUTER[::-1]]]), "TIGER_SHP_RING_ORIENTATION_INVALID"),
        (shp([[OUTER, [(x + 50, y) for x, y in HOLE]]]), "TIGER_SHP_HOLE_UNASSIGNED"), (shp([[[(float("nan"), 0.0), *OUTER[1:]]]]), "TIGER_SHP_COORDINATE_INVALID"),
    ],
)
def test_bad_shape_files(data, code):
    with pytest.raises(checks.ConformanceError, match=code):
        list(shapes.shape_records(data))


def test_household_file(spark, tmp_path):
    head = ["GEO_ID", "B11001_E001", "B11001_M001"]
    lines = ["﻿" + "|".join(head), "1400000US55079000100|123|9", "1400000US55089000100|-999999999|1", "1400000US17031000100|5|5", "0400000US55|9|9", "1400000US55025000100"]
    (tmp_path / "a.dat").write_text("\r\n".join(lines) + "\r\n", encoding="utf-8")
    rows, bad = household_file.read_household_file(spark, str(tmp_path / "a.dat"), head)
    checks.require_none(bad)
    assert sorted((r.tract_geoid, r.estimate, r.status) for r in rows.collect()) == [("55025000100", None, "missing"), ("55079000100", 123, "valid"), ("55089000100", None, "suppressed")]
    for extra, code in (("1400000US55079000100|1|2|3", "ACS_SOURCE_ROW_MALFORMED"), ("1400000US5507|1|2", "ACS_TRACT_IDENTITY_INVALID"), ("1400000US55079000100|1|2", "ACS_DUPLICATE_TRACT_GEOID")):
        (tmp_path / "b.dat").write_text("\n".join([*lines, extra]), encoding="utf-8")
        with pytest.raises(checks.ConformanceError, match=code):
            checks.require_none(household_file.read_household_file(spark, str(tmp_path / "b.dat"), head)[1])


NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(path, rows, strings):
    cells = "".join(f'<row r="{n}">' + "".join(c for c in r) + "</row>" for n, r in rows)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {NS}><sheetData>{cells}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {NS}>" + "".join(f"<si><t>{s}</t></si>" for s in strings) + "</sst>")


def s(at, k):
    return f'<c r="{at}" t="s"><v>{k}</v></c>'


def n(at, v, formula=""):
    return f'<c r="{at}">{formula}<v>{v}</v></c>'


HEAD = ["Year", "Seedpoint_ID", "Address", "City", "State", "Zip", "Lat", "Long", "MSA", "Isolated Sales"]


def test_worksheet(spark, tmp_path):
    strings = [*HEAD, "A-1", "12 Main", "SECRET"]
    head = (1, [s(f"{c}1", k) for k, c in enumerate("ABCDEFGHIJ")])
    body = (2, [n("A2", "2024.0"), s("B2", 10), s("C2", 11), n("G2", "43.1200"), n("H2", "-87.5"), n("J2", "SENTINEL", "<f>1+1</f>")])
    workbook(tmp_path / "w.xlsx", [head, body, (3, [n("A3", "")])], strings)
    cells = worksheet.read_cells(spark, str(tmp_path / "w.xlsx"), address_columns=("J",))
    assert {r.value for r in cells.where("kind = 'address' and row_no = 2").collect()} == {None}
    assert not {"SECRET", "SENTINEL"} & {r.value for r in cells.collect()}
    rows = worksheet.locations(cells).collect()
    assert len(rows) == 1 and (rows[0].vintage, rows[0].seed_point_id, rows[0].latitude, rows[0].zip) == ("2024", "A-1", "43.12", None)
    t = worksheet.target_addresses(cells, 2, 1, 10).collect()
    assert [(r.lineage_key, r.vintage_year, r.target_address) for r in t] == [("A-1", 2024, "J2")]


def titled(sheets, relations):
    b = io.BytesIO()
    kinds = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {NS} {kinds}><sheets>" + "".join(f'<sheet name="{t}" r:id="{i}"/>' for t, i in sheets) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="x">' + "".join(f'<Relationship Id="{i}" Target="{t}"/>' for i, t in relations) + "</Relationships>")
    return zipfile.ZipFile(b)


def test_sheet_by_title():
    for lead in ("worksheets/s2.xml", "/xl/worksheets/s2.xml", "xl/worksheets/s2.xml", "./worksheets/s2.xml"):
        assert worksheet.sheet_member(titled([("A", "r1"), ("B", "r2")], [("r1", "worksheets/s1.xml"), ("r2", lead)]), "B") == "xl/worksheets/s2.xml"
    for sheets, relations, code in [
        ([("A", "r1")], [("r1", "x.xml")], "TARGET_SHEET_AUTHORITY_MISMATCH"),
        ([("B", "r1"), ("B", "r2")], [("r1", "x.xml")], "TARGET_SHEET_AUTHORITY_MISMATCH"),
        ([("B", "r1")], [], "XLSX_STRUCTURE_INVALID"),
        ([("B", "r1")], [("r1", "../secret.xml")], "CONTAINMENT"),
        ([("B", "r1")], [("r1", "/etc/x.xml")], "CONTAINMENT"),
    ]:
        with pytest.raises(checks.ConformanceError, match=code):
            worksheet.sheet_member(titled(sheets, relations), "B")


@pytest.mark.parametrize("cell", [n("G2", "1", "<f>A1</f>"), s("C2", 99)])
def test_worksheet_fails_closed(tmp_path, cell):
    workbook(tmp_path / "w.xlsx", [(1, [s("A1", 0)]), (2, [cell])], ["Year"])
    with pytest.raises(checks.ConformanceError, match="TARGET_BLIND"):
        list(worksheet.sheet_cells((tmp_path / "w.xlsx").read_bytes(), "sheet1", 9, frozenset()))
    with pytest.raises(checks.ConformanceError, match="no such worksheet"):
        b = io.BytesIO()
        zipfile.ZipFile(b, "w").close()
        list(worksheet.sheet_cells(b.getvalue(), "sheet1", 9, frozenset()))
    assert worksheet.position("AA10") == (10, 27)


def test_publish(spark, tmp_path):
    df = spark.range(20).withColumn("v", F.col("id") * 2)
    out = str(tmp_path / "run-1")
    m = publish.publish(spark, out, {"t": df}, [checks.where_not(df, F.col("v") >= 0, 1, "X", F.col("id"))], dependencies={"a": "1"}, required=("a",), nonce=b"n" * 32)
    assert publish.is_frozen(spark, out) and publish.reconcile(spark, out, b"n" * 32) == m and m["artifacts"]["t"]["rows"] == 20
    with pytest.raises(checks.ConformanceError, match="RUN_ALREADY_EXISTS"):
        publish.publish(spark, out, {"t": df}, [], dependencies={})
    with pytest.raises(checks.ConformanceError, match="COMMITMENT_MISMATCH"):
        publish.reconcile(spark, out, b"m" * 32)
    df.limit(3).write.mode("append").parquet(f"{out}/tables/t")
    with pytest.raises(checks.ConformanceError, match="ARTIFACT_HASH_MISMATCH"):
        publish.reconcile(spark, out)
    other = str(tmp_path / "run-2")
    for how, code in ((dict(violations=[checks.where_not(df, F.col("v") > 5, 1, "BROKEN", F.col("id"))], dependencies={}), "BROKEN"), (dict(violations=[], dependencies={}, required=("z",)), "MANDATORY_DEPENDENCY_MISSING"), (dict(violations=[], dependencies={}, forbidden=frozenset({"v"})), "TARGET_INPUT_REJECTED")):
        with pytest.raises(checks.ConformanceError, match=code):
            publish.publish(spark, other, {"t": df}, **how)
    assert not publish.exists(spark, other)
    doc = str(tmp_path / "doc")
    assert publish.write_once(spark, doc, {"a": 1}) and not publish.write_once(spark, doc, {"a": 1})
    with pytest.raises(checks.ConformanceError, match="IMMUTABLE_DOCUMENT_DIFFERS"):
        publish.write_once(spark, doc, {"a": 2})


def test_small_files_share_batches_and_are_read_once(spark):
    """Rows of many files fill a batch; attributes and polygons come from one reading; headers are not broadcast."""
    rows = ((f"f{k // 2}", k % 2 + 1, k) for k in range(2 * shapes.BATCH + 1))
    assert [b.num_rows for b in shapes.batches(rows, v=pa.int64())] == [shapes.BATCH, shapes.BATCH, 1]
    files = catalog.files_of(spark, "/root/testdata/sf0.001", catalog.a_tract_file)
    plan = shapes.tracts_of(files, ("GEOID",))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
    cells = worksheet.cells_of(catalog.files_of(spark, "/root/testdata/sf0.001", catalog.a_workbook), title="Rows", address_columns=("J",))
    assert "broadcast" not in worksheet.locations(cells)._jdf.queryExecution().analyzed().toString()
    full, short = (catalog.a_tract_file(k, 0.0) for k in (1, 2))
    with zipfile.ZipFile(io.BytesIO(full)) as z:
        dbf, shp_ = z.read("t.dbf"), z.read("t.shp")
    one = struct.unpack_from(">I", shp_, 104)[0] * 2 + 8
    cut = shp_[:24] + struct.pack(">I", (100 + one) // 2) + shp_[28 : 100 + one]
    df = spark.createDataFrame([("ok", bytearray(short)), ("bad", bytearray(catalog.archive({"t.dbf": dbf, "t.shp": cut})))], "path string, content binary")
    with pytest.raises(Exception, match="TIGER_RECORD_COUNT_MISMATCH: bad record 2"):
        shapes.tracts_of(df, ("GEOID",)).collect()
