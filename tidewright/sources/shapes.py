"""Polygons of shapefiles: rings of the .shp with the attributes of the .dbf beside it."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.functions.scalars import tidy_name

#: Shape types with parts of x and y first: polylines and polygons, flat, with z and with m (fixed values of the format).
WITH_PARTS = {3, 5, 13, 15, 23, 25}
RINGS = "file string, record int, part int, hole boolean, ring array<struct<x:double,y:double>>"


def rings_of(data: bytes) -> Iterator[tuple[int, int, bool, list[tuple[float, float]]]]:
    """Record, part, whether it is a hole, and points of each ring of a .shp file; null shapes have none."""
    if len(data) < 100 or struct.unpack_from(">i", data)[0] != 9994:
        raise ValueError("no shapefile")
    at, record = 100, 0
    while at + 8 <= len(data):
        words = struct.unpack_from(">2i", data, at)[1]
        body, at = at + 8, at + 8 + 2 * words
        kind = struct.unpack_from("<i", data, body)[0]
        if kind in WITH_PARTS:
            n_parts, n_points = struct.unpack_from("<2i", data, body + 36)
            begins = [*struct.unpack_from(f"<{n_parts}i", data, body + 44), n_points]
            flat = struct.unpack_from(f"<{2 * n_points}d", data, body + 44 + 4 * n_parts)
            for part, (a, b) in enumerate(zip(begins, begins[1:], strict=False)):
                ring = list(zip(flat[2 * a : 2 * b : 2], flat[2 * a + 1 : 2 * b : 2], strict=True))
                area = sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False))
                yield record, part, area > 0, ring  # outer rings run clockwise
        elif kind:
            raise ValueError(f"shapes of type {kind} are no polygons")
        record += 1


def attributes_of(data: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    """The rows of a .dbf file, deleted ones included, for they count as records; values as text without blanks around."""
    n, head, size = struct.unpack_from("<IHH", data, 4)
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode(), data[at + 16]))
        at += 32
    rows = []
    for k in range(n):
        at, row = head + k * size + 1, {}
        for name, width in fields:
            row[name] = data[at : at + width].decode(encoding, "replace").strip(" \0")
            at += width
        rows.append(row)
    return rows


def _mapped(files: DataFrame, work, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                rows = work(path, content.as_py())
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema(
        [("file", pa.string()), ("record", pa.int32())]
        + ([("part", pa.int32()), ("hole", pa.bool_()), ("ring", pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))] if schema == RINGS else [("attributes", pa.map_(pa.string(), pa.string()))])
    )
    return files.select("path", "content").mapInArrow(run, schema)


def shapefile(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """file, record, part, hole, ring and attributes (a map) of the shapefiles at a path; a file without a .dbf has no attributes.

    A file is read by one task; shapefiles hold 2 GB at most, by their format.
    """
    stem = lambda p: p.rsplit(".", 1)[0]
    read = lambda glob: spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)

    def rings(p: str, data: bytes) -> list[dict]:
        return [{"file": stem(p), "record": r, "part": k, "hole": h, "ring": [{"x": x, "y": y} for x, y in ring]} for r, k, h, ring in rings_of(data)]

    def rows(p: str, data: bytes) -> list[dict]:
        return [{"file": stem(p), "record": k, "attributes": list(row.items())} for k, row in enumerate(attributes_of(data, encoding))]

    found = _mapped(read("*.shp"), rings, RINGS)
    return found.join(_mapped(read("*.dbf"), rows, "file string, record int, attributes map<string,string>"), ["file", "record"], "left")


def basins(shapes: DataFrame, feature: str = "feature_id", name: str = "name") -> DataFrame:
    """shape, feature_id, name and ring of all rings, holes too, as the polygon look-up wants them: a row for each ring, and a
    shape for each record of a file."""
    value = lambda key: F.try_element_at("attributes", F.lit(key))
    return shapes.select(F.struct("file", "record").alias("shape"), value(feature).cast("double").cast("int").alias("feature_id"), value(name).alias("name"), "ring")


def basin_names(polygons: DataFrame) -> DataFrame:
    """The table of basins as lines 'id,name' with land first, and each basin's name as a flag meaning."""
    plain = F.replace(F.replace("name", F.lit("'"), F.lit(" ")), F.lit(","), F.lit(" -"))
    rows = polygons.select("feature_id", plain.alias("name")).distinct()
    land = polygons.sparkSession.createDataFrame([(0, "Land")], "feature_id int, name string")
    meaning = tidy_name(F.col("name"), ((": ", ":"), (" ", "_"), (":", "_")))
    return land.unionByName(rows).select("feature_id", F.concat_ws(",", "feature_id", "name").alias("line"), F.when(F.col("feature_id") != 0, meaning).alias("meaning"))
