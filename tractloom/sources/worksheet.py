"""Least-privilege worksheet reading: a task decodes only the columns it was allowed to, addresses of others at most.

Each workbook is one file and one task; its sheet is read as a stream of XML events. Cells outside the allowed columns
are never decoded: of the target column only the address and whether a cell is there come out.
"""

from __future__ import annotations

import io
import re
import zipfile
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tractloom.operators.checks import ConformanceError

CELLS = "path string, row_no int, column_no int, address string, kind string, value string"
BATCH = 4096  # cells
ADDRESS = re.compile(r"([A-Z]{1,3})([1-9][0-9]*)")
# Header names of the nine projected fields, as normalised.
HEADERS = {
    "vintage": ("year", "vintage", "yearvintage", "forecastyear"),
    "seed_point_id": ("seedpointid", "seedpoint_id", "seedid", "source_seed_point_id", "sourceid", "id"),
    "address": ("address", "streetaddress", "siteaddress"),
    "city": ("city",),
    "state": ("state", "st"),
    "zip": ("zip", "zipcode", "postalcode", "zippostalcode"),
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lon", "lng", "long"),
    "market": ("msa", "market", "msamarket", "marketmsa"),
}


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = 26 * n + ord(c) - 64
    return n


def position(address: str) -> tuple[int, int]:
    """(row, column) of an address like B12."""
    m = ADDRESS.fullmatch(address.upper())
    if m is None:
        raise ConformanceError("XLSX_CELL_REFERENCE_INVALID", address)
    return int(m[2]), column_number(m[1])


def shared_strings(z: zipfile.ZipFile, wanted: set[int]) -> dict[int, str]:
    """The wanted entries of the shared strings; no other is kept."""
    found: dict[int, str] = {}
    if wanted and "xl/sharedStrings.xml" in z.namelist():
        with z.open("xl/sharedStrings.xml") as f:
            n = 0
            for _, e in ElementTree.iterparse(f):
                if e.tag.endswith("}si"):
                    if n in wanted:
                        found[n] = "".join(t.text or "" for t in e.iter() if t.tag.endswith("}t"))
                    n += 1
                    e.clear()
    if wanted - set(found):
        raise ConformanceError("TARGET_BLIND_MATERIALIZATION_NOT_ENFORCEABLE", "shared string")
    return found


def sheet_member(z: zipfile.ZipFile, title: str) -> str:
    """The member that holds the sheet of this title, by the workbook's list of sheets and its relationships.

    One sheet must have exactly this title, and its relationship must lead to one member inside xl/.
    """
    try:
        book, relations = (ElementTree.fromstring(z.read(f"xl/{n}")) for n in ("workbook.xml", "_rels/workbook.xml.rels"))
    except (KeyError, ElementTree.ParseError) as unreadable:
        raise ConformanceError("XLSX_STRUCTURE_INVALID", "workbook or relationships") from unreadable
    ids = [[v for k, v in e.items() if k.endswith("}id")] for e in book.iter() if e.tag.endswith("}sheet") and e.get("name") == title]
    if len(ids) != 1:
        raise ConformanceError("TARGET_SHEET_AUTHORITY_MISMATCH", title)
    leads = [e.get("Target") for e in relations.iter() if e.tag.endswith("}Relationship") and [e.get("Id")] == ids[0]]
    if len(leads) != 1 or not leads[0]:
        raise ConformanceError("XLSX_STRUCTURE_INVALID", f"relationship of {title}")
    steps = [x for x in leads[0].replace("\\", "/").split("/") if x not in ("", ".")]
    if not leads[0].startswith(("/", "\\")) and steps[:1] != ["xl"]:
        steps = ["xl", *steps]  # targets are relative to the workbook's folder
    if ".." in steps or steps[:1] != ["xl"]:
        raise ConformanceError("XLSX_RELATIONSHIP_CONTAINMENT_FAILED", leads[0])
    return "/".join(steps)


def sheet_cells(data: bytes, sheet: str, last_column: int, address_columns: frozenset[int], title: str | None = None):
    """(row, column, address, kind, value): header cells and allowed columns decoded, address columns without a value.

    The sheet is the one of the title where that is given, else the member `sheet`.
    """
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        name = f"xl/worksheets/{sheet}.xml" if title is None else sheet_member(z, title)
        if name not in z.namelist():
            raise ConformanceError("TARGET_BLIND_MATERIALIZATION_NOT_ENFORCEABLE", "no such worksheet")
        cells, wanted, seen = [], set(), set()
        with z.open(name) as f:
            for _, e in ElementTree.iterparse(f):
                if not e.tag.endswith("}c"):
                    if e.tag.endswith("}row"):
                        e.clear()
                    continue
                address = e.get("r", "").upper()
                row, column = position(address)
                if row > 1 and column > last_column:
                    if column in address_columns:
                        if address in seen:
                            raise ConformanceError("XLSX_CELL_DUPLICATE", address)
                        seen.add(address)
                        if e.get("t") in ("s", "inlineStr", "str"):
                            raise ConformanceError("XLSX_TARGET_CELL_TYPE_INVALID", address)
                        cells.append((row, column, address, "address", None))
                    e.clear()
                    continue
                if any(x.tag.endswith("}f") for x in e):
                    raise ConformanceError("TARGET_BLIND_MATERIALIZATION_NOT_ENFORCEABLE", "formula in the projection")
                kind = e.get("t", "n")
                parts = [t.text or "" for t in e.iter() if t.tag.endswith(("}v", "}t"))]
                value = "".join(parts) if parts else None
                if kind == "s" and value is not None:
                    wanted.add(int(value))
                cells.append((row, column, address, kind, value))
                e.clear()
        strings = shared_strings(z, wanted)
    for row, column, address, kind, value in cells:
        yield row, column, address, kind, shown(strings[int(value)] if kind == "s" and value is not None else value, kind)


def shown(value: str | None, kind: str) -> str | None:
    """A number cell as its value is shown: whole numbers without a point."""
    if value is None or kind != "n":
        return value
    try:
        x = float(value)
    except ValueError:
        return value
    return str(int(x)) if x.is_integer() else repr(x)


def read_cells(spark: SparkSession, path: str, sheet: str = "sheet1", last_column: str = "I", address_columns: tuple[str, ...] = (), title: str | None = None) -> DataFrame:
    """Cells of the workbooks under path, columns A to last_column decoded, address_columns by address only."""
    return cells_of(spark.read.format("binaryFile").load(path), sheet, last_column, address_columns, title)


def cells_of(files: DataFrame, sheet: str = "sheet1", last_column: str = "I", address_columns: tuple[str, ...] = (), title: str | None = None) -> DataFrame:
    """`read_cells` of files at hand: path and content."""
    last, others = column_number(last_column), frozenset(map(column_number, address_columns))

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["path", "row_no", "column_no", "address", "kind", "value"])

    def parse(files):
        rows: list[tuple] = []  # of many small files, or a part of a large one
        for f in files:
            for p, data in zip(f.column(0).to_pylist(), f.column(1).to_pylist(), strict=True):
                for c in sheet_cells(data, sheet, last, others, title):
                    rows.append((p, *c))
                    if len(rows) == BATCH:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    return files.select("path", "content").mapInArrow(parse, CELLS)


def header_field(value: Column) -> Column:
    """The projected field that a header cell names, null for others."""
    plain = F.regexp_replace(F.lower(F.trim(value)), "[^a-z0-9_]", "")
    field = None
    for name, aliases in HEADERS.items():
        field = F.when(plain.isin(*aliases), name) if field is None else field.when(plain.isin(*aliases), name)
    return field


def locations(cells: DataFrame) -> DataFrame:
    """One row per non-blank body row: path, source_row and the nine fields as text."""
    names = cells.where("row_no = 1").select("path", "column_no", header_field(F.col("value")).alias("field")).where("field is not null")
    names = names.groupBy("path").agg(F.collect_list(F.struct("column_no", "field")).alias("names"))  # nine header cells at most, but as many files as there are
    body = cells.where("row_no > 1 and kind <> 'address' and value is not null and trim(value) <> ''")
    j = body.join(names, "path").withColumn("field", F.filter("names", lambda n: n["column_no"] == F.col("column_no"))[0]["field"]).where("field is not null")
    return j.groupBy("path", F.col("row_no").alias("source_row")).pivot("field", list(HEADERS)).agg(F.first("value"))


def target_addresses(cells: DataFrame, lineage_column: int, vintage_column: int, target_column: int) -> DataFrame:
    """lineage_key, vintage_year and target_address of the rows that have all three."""
    from tractloom.functions.text import only_year

    def one(column: int, what: str, name: str) -> Column:
        return F.first(F.when(F.col("column_no") == column, F.col(what)), ignorenulls=True).alias(name)

    by = cells.where("row_no > 1").groupBy("path", "row_no").agg(one(lineage_column, "value", "lineage_key"), one(vintage_column, "value", "vintage"), one(target_column, "address", "target_address"))
    return by.select("path", "row_no", "lineage_key", only_year(F.col("vintage")).alias("vintage_year"), "target_address").where("lineage_key is not null and target_address is not null")
