"""OpenStreetMap extracts (PBF) as a Spark data source: tagged nodes and ways, each block of the file a unit of work.

``spark.dataSource.register(OsmPbf)``, then ``spark.read.format("osm_pbf").load(path)`` gives id, kind, lat, lon and the six tag columns of elements that
match ``FILTER``. The format is public: a sequence of blobs with protobuf messages. Partitions are byte ranges of blobs, found by
reading blob headers only. Nodes come with their place; a way's place is the mean of its nodes, resolved by a join (``with_way_places``).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.spatial import poi_type, sequential_ids

TAGS = ("amenity", "highway", "railway", "tourism", "building", "landuse")
#: Fixed tag values of points that drive demand.
FILTER = {
    "amenity": ("school", "university", "college", "hospital", "clinic", "bus_station", "marketplace", "place_of_worship"), "highway": ("bus_stop",), "railway": ("station", "halt"),
    "tourism": ("attraction", "museum", "hotel", "guest_house"), "building": ("apartments",), "landuse": ("industrial",),
}
SCHEMA = "id long, kind string, lat double, lon double, " + ", ".join(f"{t} string" for t in TAGS) + ", refs array<long>"


def varint(data: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        b = data[at]
        at += 1
        out |= (b & 0x7F) << shift
        if b < 0x80:
            return out, at
        shift += 7


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message."""
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            n, at = varint(data, at)
            value, at = data[at : at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = data[at : at + n], at + n
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def packed(data: bytes, signed: bool = False) -> list[int]:
    out, at = [], 0
    while at < len(data):
        v, at = varint(data, at)
        out.append((v >> 1) ^ -(v & 1) if signed else v)
    return out


def _running(values: list[int]) -> list[int]:
    out, total = [], 0
    for v in values:
        total += v
        out.append(total)
    return out


def _signed(v: int) -> int:
    return (v >> 1) ^ -(v & 1)


def matches(tags: dict[str, str]) -> bool:
    return any(tags.get(k) in v for k, v in FILTER.items())


def block_rows(block: bytes, all_nodes: bool = False) -> Iterator[tuple]:
    """Rows of a primitive block: matching nodes and ways, or every node's place if asked."""
    parts: dict[int, list] = {}
    for k, v in fields(block):
        parts.setdefault(k, []).append(v)
    strings = [s.decode("utf-8", "replace") for _, s in fields(parts[1][0])] if 1 in parts else []
    scale, lat0, lon0 = parts.get(17, [100])[0], parts.get(19, [0])[0], parts.get(20, [0])[0]
    place = lambda lat, lon: ((lat0 + scale * lat) * 1e-9, (lon0 + scale * lon) * 1e-9)

    def row(i, kind, lat, lon, tags, refs):
        return (i, kind, lat, lon, *[tags.get(t) for t in TAGS], refs)

    for group in parts.get(2, []):
        for k, v in fields(group):
            if k == 2:  # dense nodes
                m = dict(fields(v))
                ids, lats, lons = (_running(packed(m.get(n, b""), True)) for n in (1, 8, 9))
                kv, at = packed(m.get(10, b"")), 0
                for i, la, lo in zip(ids, lats, lons, strict=True):
                    tags = {}
                    while at < len(kv) and kv[at]:
                        tags[strings[kv[at]]] = strings[kv[at + 1]]
                        at += 2
                    at += 1
                    if all_nodes or matches(tags):
                        yield row(i, "node", *place(la, lo), tags, None)
            elif k in (1, 3):
                m = dict(fields(v))
                tags = {strings[a]: strings[b] for a, b in zip(packed(m.get(2, b"")), packed(m.get(3, b"")), strict=True)}
                if k == 1 and (all_nodes or matches(tags)):
                    yield row(_signed(m[1]), "node", *place(_signed(m[8]), _signed(m[9])), tags, None)
                if k == 3 and matches(tags) and not all_nodes:
                    yield row(m[1], "way", None, None, tags, _running(packed(m.get(8, b""), True)))


def blobs(f) -> Iterator[tuple[str, int, int]]:
    """(type, start, size) of the blobs of an open file."""
    while head := f.read(4):
        m = dict(fields(f.read(struct.unpack(">I", head)[0])))
        size = m[3]
        yield m[1].decode(), f.tell(), size
        f.seek(size, 1)


def unpack(blob: bytes) -> bytes:
    m = dict(fields(blob))
    return m[1] if 1 in m else zlib.decompress(m[3])


def opened(path: str):
    """The file at a URI or plain path, readable at any place: local, HDFS and object stores."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return store.open_input_file(name)


class BlobPartition(InputPartition):
    def __init__(self, path: str, ranges: list[tuple[int, int]]):
        self.path, self.ranges = path, ranges


class OsmReader(DataSourceReader):
    def __init__(self, path: str, all_nodes: bool, blobs_per_task: int):
        self.path, self.all_nodes, self.per_task = path, all_nodes, blobs_per_task

    def partitions(self):
        with opened(self.path) as f:
            found = [(a, n) for kind, a, n in blobs(f) if kind == "OSMData"]
        return [BlobPartition(self.path, found[i : i + self.per_task]) for i in range(0, len(found), self.per_task)] or [BlobPartition(self.path, [])]

    def read(self, partition):
        with opened(partition.path) as f:
            for start, size in partition.ranges:
                f.seek(start)
                yield from block_rows(unpack(f.read(size)), self.all_nodes)


class OsmPbf(DataSource):
    """Options: path (a URI or a plain path), all_nodes (every node's place, for ways), blobs_per_task."""

    @classmethod
    def name(cls):
        return "osm_pbf"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return OsmReader(self.options["path"], self.options.get("all_nodes", "false") == "true", int(self.options.get("blobs_per_task", 8)))


def with_way_places(elements: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ways get the mean place of their nodes; those without any stay without a place."""
    refs = elements.where("kind = 'way'").select("id", F.explode("refs").alias("node"))
    mean = refs.join(nodes.select(F.col("id").alias("node"), "lat", "lon"), "node").groupBy("id").agg(F.avg("lat").alias("wlat"), F.avg("lon").alias("wlon")).withColumn("kind", F.lit("way"))
    return elements.join(mean, ["id", "kind"], "left").withColumns({"lat": F.coalesce("lat", "wlat"), "lon": F.coalesce("lon", "wlon")}).drop("wlat", "wlon")


def points(elements: DataFrame) -> DataFrame:
    """POI_ID, POI_Type, Latitude, Longitude: running numbers over all elements by kind and number, so that reruns agree; then elements without a place are left out."""
    found = elements.select("kind", "id", poi_type(*TAGS).alias("POI_Type"), F.col("lat").alias("Latitude"), F.col("lon").alias("Longitude"))
    named = sequential_ids(found, ["kind", "id"], [F.col("kind"), F.floor(F.col("id") / 1_000_000)]).drop("kind", "id")
    return named.dropna(subset=["Latitude", "Longitude"])
