"""Boundary shapefiles: polygon records and attribute records, joined by Spark.

The published layout is decoded per file by two small helpers; geometry (.shp) and attributes
(.dbf) meet in a join on file stem and record number.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmosaic.functions.sortkeys import natural_sort
from fieldmosaic.functions.text import file_stem
from fieldmosaic.operators.boundaries import sort_column

# Fixed values of the file layout.
SHAPE_MAGIC = 9994
POLYGON_KINDS = (5, 15, 25)
DELETED = b"*"
RECORD_BATCH = 500


def _signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return float(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2


def _holds(ring: np.ndarray, point: np.ndarray) -> bool:
    x1, y1 = ring[:, 0], ring[:, 1]
    x2, y2 = np.roll(x1, -1), np.roll(y1, -1)
    cut = (y1 <= point[1]) != (y2 <= point[1])
    at = x1[cut] + (point[1] - y1[cut]) * (x2[cut] - x1[cut]) / (y2[cut] - y1[cut])
    return bool(np.count_nonzero(at > point[0]) % 2)


def _wkt(rings: list[np.ndarray]) -> str:
    """Clockwise rings are outer ones; every other ring is a hole of the outer ring around it."""
    outer = [r for r in rings if _signed_area(r) <= 0] or rings[:1]
    parts = [[r] for r in outer]
    for hole in (r for r in rings if not any(r is o for o in outer)):
        home = next((p for p in parts if _holds(p[0], hole[0])), parts[0])
        home.append(hole)
    text = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r.tolist()) + ")"
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(text, p)) + ")" for p in parts) + ")"


def decode_shapes(data: bytes) -> Iterator[tuple[int, str | None]]:
    """(record number from 0, WKT) of a .shp file; null shapes give None, damage a ValueError or struct.error."""
    if struct.unpack(">i", data[:4]) != (SHAPE_MAGIC,):
        raise ValueError("not a shape file")
    at, number = 100, 0
    while at < len(data):
        (words,) = struct.unpack(">i", data[at + 4:at + 8])
        if words < 2 or at + 8 + words * 2 > len(data):
            raise ValueError(f"record {number} is cut off")
        body = data[at + 8:at + 8 + words * 2]
        (kind,) = struct.unpack("<i", body[:4])
        wkt = None
        if kind in POLYGON_KINDS:
            n_parts, n_points = struct.unpack("<ii", body[36:44])
            starts = list(struct.unpack(f"<{n_parts}i", body[44:44 + 4 * n_parts])) + [n_points]
            points = np.frombuffer(body, "<f8", 2 * n_points, 44 + 4 * n_parts).reshape(-1, 2)
            rings = [points[a:b] for a, b in zip(starts, starts[1:]) if b > a]
            wkt = _wkt(rings) if rings else None
        yield number, wkt
        at, number = at + 8 + words * 2, number + 1


def decode_attributes(data: bytes, encoding: str = "utf-8") -> Iterator[tuple[int, dict[str, str | None] | None]]:
    """(record number from 0, field -> text) of a .dbf file; empty fields are None, deleted records have no fields.

    Bytes the encoding does not know, and a file that ends early, raise an error.
    """
    n_records, header, width = struct.unpack("<IHH", data[4:12])
    fields, at, offset = [], 32, 1
    while data[at] != 0x0D:
        name = data[at:at + 11].split(b"\0")[0].decode(encoding)
        size = data[at + 16]
        fields.append((name, offset, size))
        offset, at = offset + size, at + 32
    for number in range(n_records):
        record = data[header + number * width:header + (number + 1) * width]
        if len(record) < width:
            raise ValueError(f"record {number} is cut off")
        if record[:1] == DELETED:
            yield number, None
            continue
        yield number, {n: record[o:o + s].decode(encoding).strip(" \0") or None for n, o, s in fields}


def _records(decode, files: pd.DataFrame) -> Iterator[tuple[str, Iterator]]:
    """Path and fresh record iterator of each file, with its encoding where the files have one."""
    names = files["encoding"] if "encoding" in files else [None] * len(files)
    for path, content, encoding in zip(files["path"], files["content"], names):
        data = bytes(content)
        yield path, (lambda d=data, e=encoding: decode(d, e) if e else decode(d))


def _fault(records) -> str | None:
    """Why a file cannot be read to its end; reading first without keeping bounds memory by a record."""
    try:
        for _ in records():
            pass
    except (ValueError, IndexError, LookupError, struct.error) as error:
        return str(error) or type(error).__name__
    return None


def _in_batches(decode, column: str):
    """Records of the files that can be read to their end; the others are for `_faults`."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for path, records in _records(decode, files):
                numbers, values = [], []
                for number, value in records() if _fault(records) is None else ():
                    numbers.append(number)
                    values.append(value)
                    if len(numbers) == RECORD_BATCH:
                        yield pd.DataFrame({"path": path, "record": numbers, column: values})
                        numbers, values = [], []
                if numbers:
                    yield pd.DataFrame({"path": path, "record": numbers, column: values})
    return run


def _faults(decode):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            yield pd.DataFrame([(path, reason) for path, records in _records(decode, files) if (reason := _fault(records))], columns=["path", "reason"], dtype=str)
    return run


def _read(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "content")


def shape_records(files: DataFrame) -> DataFrame:
    """(path, record, geometry) of .shp contents (path, content); a damaged file has no rows, see `boundary_rejects`.

    A file is one binary value read by one task, so it has to stay below 2 GB.
    """
    return files.select("path", "content").mapInPandas(_in_batches(decode_shapes, "geometry"), "path string, record int, geometry string")


def attribute_records(files: DataFrame) -> DataFrame:
    """(path, record, attributes) of .dbf contents (path, content and, if known, encoding).

    Deleted records have null attributes; a file that cannot be read has no rows.
    """
    schema = "path string, record int, attributes map<string,string>"
    return files.select(*_contents(files)).mapInPandas(_in_batches(decode_attributes, "attributes"), schema)


def boundary_rejects(shapes: DataFrame, attributes: DataFrame) -> DataFrame:
    """(path, reason, status error) of the .shp and .dbf contents that cannot be read."""
    bad = shapes.select("path", "content").mapInPandas(_faults(decode_shapes), "path string, reason string")
    more = attributes.select(*_contents(attributes)).mapInPandas(_faults(decode_attributes), "path string, reason string")
    return bad.unionByName(more).withColumn("status", F.lit("error"))


def _contents(files: DataFrame) -> list[str]:
    return [c for c in ("path", "content", "encoding") if c in files.columns]


def with_encoding(attributes: DataFrame, notes: DataFrame) -> DataFrame:
    """.dbf contents with the encoding named by the .cpg content (path, content) beside them; null: UTF-8.

    A bare code page number, as in `950` or `ANSI 1252`, is written out for Python.
    """
    text = F.nullif(F.regexp_replace(F.btrim(F.col("content").cast("string"), F.lit(" \r\n\t")), r"^(?:ANSI )?(\d+)$", "cp$1"), F.lit(""))
    named = notes.select(home(F.col("path")).alias("_home"), text.alias("encoding"))
    return attributes.withColumn("_home", home(F.col("path"))).join(named, "_home", "left").drop("_home")


def home(path: Column) -> Column:
    """Folder and stem: what the files of one boundary layer share."""
    return F.regexp_replace(path, r"\.[^./]*$", "")


def wanted(path: Column) -> Column:
    """Only county and town files are boundaries."""
    name = F.lower(F.substring_index(path, "/", -1))
    return name.contains("county") | name.contains("town")


def join_records(shapes: DataFrame, attributes: DataFrame) -> DataFrame:
    """Boundary records: file_name, shp_version, record, geometry, attributes.

    Shapes and attributes meet on folder, stem and record number; records deleted in the .dbf
    are left out with their shape.
    """
    left = shapes.where(wanted(F.col("path"))).select(
        home(F.col("path")).alias("_home"), F.substring_index("path", "/", -1).alias("file_name"),
        file_stem(F.col("path")).alias("shp_version"), "record", "geometry"
    )
    right = attributes.select(home(F.col("path")).alias("_home"), "record", "attributes", F.col("attributes").isNull().alias("_deleted"))
    joined = left.join(right, ["_home", "record"], "left").where(~F.coalesce("_deleted", F.lit(False)))
    return joined.select("file_name", "shp_version", "record", "geometry", "attributes")


def _folder(spark: SparkSession, folder: str, name: str = "*") -> tuple[DataFrame, DataFrame]:
    """Contents of the boundary files of a folder, names chosen before anything is read or decoded."""
    shapes, attributes = (_read(spark, folder, f"{name}.{kind}").where(wanted(F.col("path"))) for kind in ("shp", "dbf"))
    return shapes, with_encoding(attributes, _read(spark, folder, f"{name}.cpg"))


def layer_parts(spark: SparkSession, shapes: list[str]) -> tuple[DataFrame, DataFrame]:
    """Contents of the named .shp files and of the .dbf files beside them, with their encoding."""
    stems = [_literal(path[:-4]) for path in shapes]
    read = lambda kind: spark.read.format("binaryFile").load([f"{s}.{kind}" for s in stems]).select("path", "content")
    folders = sorted({path.rsplit("/", 1)[0] for path in shapes})
    notes = spark.read.format("binaryFile").option("pathGlobFilter", "*.cpg").load(folders).select("path", "content")
    return read("shp"), with_encoding(read("dbf"), notes)


def read_boundary_files(spark: SparkSession, folder: str) -> DataFrame:
    """All boundary records of a folder of .shp and .dbf files."""
    shapes, attributes = _folder(spark, folder)
    return join_records(shape_records(shapes), attribute_records(attributes))


def read_boundary_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """The boundary files of a folder that cannot be read, with the reason."""
    return boundary_rejects(*_folder(spark, folder))


def read_boundary_file(spark: SparkSession, path: str) -> DataFrame:
    """One boundary file as a table with a column per attribute, in natural order of its area id.

    The attribute names come from the header of the .dbf file next to it.
    """
    name = path.rsplit("/", 1)[-1]
    shapes, attributes = _folder(spark, path.rsplit("/", 1)[0], _literal(name[:-4]))
    records = join_records(shape_records(shapes), attribute_records(attributes))
    names = [row.k for row in attributes.mapInPandas(_header_names, "k string").collect()]
    table = records.select(*[F.try_element_at("attributes", F.lit(n)).alias(n) for n in names], "geometry", "shp_version")
    order = sort_column(table.columns, name)
    return natural_sort(table, order) if order else table


def _literal(name: str) -> str:
    """A file name as a pattern that matches only itself."""
    return "".join(f"\\{c}" if c in "*?{}[]\\" else c for c in name)


def _header_names(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        for content, encoding in zip(files["content"], files["encoding"]):
            data, code, at, names = bytes(content), encoding or "utf-8", 32, []
            readable = _fault(lambda d=data, c=code: decode_attributes(d, c)) is None
            while readable and data[at] != 0x0D:
                names.append(data[at:at + 11].split(b"\0")[0].decode(code))
                at += 32
            yield pd.DataFrame({"k": names})
