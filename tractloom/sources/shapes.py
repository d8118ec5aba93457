"""Attribute tables and polygon files: fixed-width records and rings, one task for each file.

A file is a part of a source, of bounded size, as the formats themselves count bytes in 32 bits; many files spread over
tasks. Rows come out in batches, of many small files or of a part of a large one, so a task holds one file's bytes and one batch of rows.
"""

from __future__ import annotations

import io
import struct
import zipfile
from itertools import islice, zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tractloom.functions.geometry import ARROW_POLYGONS, POLYGONS, area, locate
from tractloom.operators import checks
from tractloom.operators.checks import ConformanceError

POLYGON_TYPES = (5, 15, 25)  # plain, with heights, with measures
ATTRIBUTES = "path string, record_no bigint, attributes map<string,string>"
SHAPES = f"path string, record_no bigint, polygons {POLYGONS}"
BATCH = 1000


def need(condition: bool, code: str, detail: str = "") -> None:
    if not condition:
        raise ConformanceError(code, detail)


def attribute_records(data: bytes):
    """Each record of a DBF file as a dict of stripped text."""
    need(len(data) >= 33, "GEO04_DBF_INVALID", "short header")
    (count,), (head, width) = struct.unpack_from("<I", data, 4), struct.unpack_from("<HH", data, 8)
    need(head >= 33 and width >= 2, "GEO04_DBF_INVALID", "header lengths")
    need(len(data) >= head + count * width, "GEO04_DBF_TRUNCATED")
    fields, at = [], 32
    while at < head and data[at] != 0x0D:
        need(at + 32 <= len(data), "GEO04_DBF_INVALID", "field descriptor")
        name, size = data[at : at + 11].split(b"\0", 1)[0].decode("ascii").strip(), data[at + 16]
        need(bool(name) and size > 0, "GEO04_DBF_INVALID", "field descriptor")
        fields.append((name, size))
        at += 32
    need(at < head and data[at] == 0x0D, "GEO04_DBF_INVALID", "no terminator")
    need(sum(size for _, size in fields) + 1 == width, "GEO04_DBF_INVALID", "record width")
    for start in range(head, head + count * width, width):
        need(data[start : start + 1] != b"*", "GEO04_DBF_DELETED_ROW")
        row, at = {}, start + 1
        for name, size in fields:
            row[name] = data[at : at + size].decode("latin-1").strip()
            at += size
        yield row


def assembled(rings: list[np.ndarray]) -> list[dict]:
    """Clockwise rings are outer; every other one is a hole of the smallest outer ring that covers its first point."""
    signed = [area(r[:-1] if (r[0] == r[-1]).all() else r) for r in rings]
    outers = [(r, abs(s)) for r, s in zip(rings, signed, strict=True) if s < 0]
    need(bool(outers), "TIGER_SHP_RING_ORIENTATION_INVALID")
    polygons = [{"outer": points(r), "holes": []} for r, _ in outers]
    for r, s in zip(rings, signed, strict=True):
        if s >= 0:
            around = [i for i, (o, _) in enumerate(outers) if locate(o[:-1], *r[0]) >= 0]
            need(bool(around), "TIGER_SHP_HOLE_UNASSIGNED")
            polygons[min(around, key=lambda i: outers[i][1])]["holes"].append(points(r))
    return polygons


def points(ring: np.ndarray) -> list[dict]:
    return [{"x": x, "y": y} for x, y in ring.tolist()]


def shape_records(data: bytes):
    """Each record of a polygon file as a list of polygons."""
    need(len(data) >= 100, "TIGER_SHP_INVALID", "short header")
    need(struct.unpack_from(">I", data, 0)[0] == 9994, "TIGER_SHP_INVALID", "file code")
    need(struct.unpack_from(">I", data, 24)[0] * 2 == len(data), "TIGER_SHP_LENGTH_MISMATCH")
    version, kind = struct.unpack_from("<II", data, 28)
    need(version == 1000, "TIGER_SHP_INVALID", "version")
    need(kind in POLYGON_TYPES, "TIGER_SHP_TYPE_INVALID")
    at, expected = 100, 1
    need(len(data) > 100, "TIGER_SHP_INVALID", "no record")
    while at < len(data):
        need(at + 8 <= len(data), "TIGER_SHP_RECORD_TRUNCATED")
        number, words = struct.unpack_from(">II", data, at)
        need(number == expected and words > 0, "TIGER_SHP_RECORD_INVALID")
        start, end = at + 8, at + 8 + 2 * words
        need(end <= len(data) and start + 44 <= end, "TIGER_SHP_RECORD_TRUNCATED")
        need(struct.unpack_from("<I", data, start)[0] in POLYGON_TYPES, "TIGER_SHP_RECORD_TYPE_INVALID")
        n_parts, n_points = struct.unpack_from("<II", data, start + 36)
        need(n_parts > 0 and n_points >= 4, "TIGER_SHP_RECORD_INVALID")
        need(start + 44 + 4 * n_parts + 16 * n_points <= end, "TIGER_SHP_RECORD_TRUNCATED")
        parts = [*struct.unpack_from(f"<{n_parts}I", data, start + 44), n_points]
        need(parts[0] == 0 and all(a < b for a, b in zip(parts, parts[1:], strict=False)), "TIGER_SHP_PART_INDEX_INVALID")
        xy = np.frombuffer(data, dtype="<f8", count=2 * n_points, offset=start + 44 + 4 * n_parts).reshape(-1, 2)
        need(bool(np.isfinite(xy).all()), "TIGER_SHP_COORDINATE_INVALID")
        rings = [xy[a:b] for a, b in zip(parts, parts[1:], strict=False)]
        need(all(len(r) >= 4 and (r[0] == r[-1]).all() and area(r[:-1]) != 0 for r in rings), "TIGER_SHP_RING_INVALID")
        yield assembled(rings)
        at, expected = end, expected + 1


def member(data: bytes, ending: str) -> bytes:
    """The one member of a zip with this ending; other bytes are the member themselves."""
    if data[:4] != b"PK\x03\x04":
        return data
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(ending)]
        need(len(names) == 1, "GEO04_TIGER_ZIP_INCOMPLETE", ending)
        return z.read(names[0])


def batches(rows, **kinds: pa.DataType):
    """Rows (path, record_no, ...) of any number of files as batches; kinds: the types of the columns after these two."""
    types = {"path": pa.string(), "record_no": pa.int64(), **kinds}
    for part in iter(lambda: list(islice(rows, BATCH)), []):
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types.values(), strict=True)], names=list(types))


def each_file(files):
    for f in files:
        yield from zip(f.column(0).to_pylist(), f.column(1).to_pylist(), strict=True)


def read_attributes(spark: SparkSession, path: str) -> DataFrame:
    """path, record_no (from 1) and attributes of DBF files, or of the DBF members of zips."""
    return attributes_of(spark.read.format("binaryFile").load(path))


def attributes_of(files: DataFrame) -> DataFrame:
    """`read_attributes` of files at hand: path and content."""

    def parse(files):
        rows = ((p, n, list(r.items())) for p, data in each_file(files) for n, r in enumerate(attribute_records(member(data, ".dbf")), 1))
        yield from batches(rows, attributes=pa.map_(pa.string(), pa.string()))

    return files.select("path", "content").mapInArrow(parse, ATTRIBUTES)


def read_shapes(spark: SparkSession, path: str) -> DataFrame:
    """path, record_no (from 1) and polygons of polygon files, or of the .shp members of zips."""
    return shapes_of(spark.read.format("binaryFile").load(path))


def shapes_of(files: DataFrame) -> DataFrame:
    """`read_shapes` of files at hand: path and content."""

    def parse(files):
        yield from batches(((p, n, r) for p, data in each_file(files) for n, r in enumerate(shape_records(member(data, ".shp")), 1)), polygons=ARROW_POLYGONS)

    return files.select("path", "content").mapInArrow(parse, SHAPES)


def read_tracts(spark: SparkSession, path: str, fields: tuple[str, ...] = ("STATEFP", "COUNTYFP", "TRACTCE", "GEOID", "INTPTLAT", "INTPTLON")) -> DataFrame:
    """Attributes and polygons of zipped tract files, joined by file and record number.

    A record that one of the two lacks fails the job; `record_violations` lists such records.
    """
    return tracts_of(spark.read.format("binaryFile").load(path), fields)


def tracts_of(files: DataFrame, fields: tuple[str, ...] = ("STATEFP", "COUNTYFP", "TRACTCE", "GEOID", "INTPTLAT", "INTPTLON")) -> DataFrame:
    """`read_tracts` of files at hand: path and content. A file has both members, so its records are paired as it is read."""

    def both(path: str, data: bytes):
        for n, (a, g) in enumerate(zip_longest(attribute_records(member(data, ".dbf")), shape_records(member(data, ".shp"))), 1):
            need(a is not None and g is not None, "TIGER_RECORD_COUNT_MISMATCH", f"{path} record {n}")
            yield path, n, [a.get(f) for f in fields], g

    def parse(files):
        rows = ((p, n, *values, g) for path, data in each_file(files) for p, n, values, g in both(path, data))
        yield from batches(rows, **{f: pa.string() for f in fields}, polygons=ARROW_POLYGONS)

    made = files.select("path", "content").mapInArrow(parse, ", ".join(["path string, record_no bigint", *[f"`{f}` string" for f in fields], f"polygons {POLYGONS}"]))
    return made.select("record_no", *fields, "polygons")


def record_violations(spark: SparkSession, path: str) -> list[DataFrame]:
    """Records that the attributes or the polygons of a file lack."""
    a, s = read_attributes(spark, path).select("path", "record_no"), read_shapes(spark, path).select("path", "record_no")
    keys = ["path", "record_no"]
    return [checks.not_covered(a, s, keys, 10, "TIGER_RECORD_COUNT_MISMATCH"), checks.not_covered(s, a, keys, 10, "TIGER_RECORD_COUNT_MISMATCH")]
