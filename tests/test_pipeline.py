"""Sources and sinks, the extract reader, and every step of the pipeline on made-up raw files."""

import json
import math
import random
import struct
import zlib

import pytest
from demandscope.__main__ import main
from demandscope.plans.pipeline import Pipeline
from demandscope.sources import files, osm, sinks
from demandscope.streaming.increments import apply_to_increments
from pyspark.sql import functions as F


def _varint(v):
    out = b""
    while v > 0x7F:
        out, v = out + bytes([v & 0x7F | 0x80]), v >> 7
    return out + bytes([v])


def _field(n, v):
    return _varint(n << 3) + _varint(v) if isinstance(v, int) else _varint(n << 3 | 2) + _varint(len(v)) + v


def _zig(values):
    return b"".join(_varint(v * 2 if v >= 0 else -v * 2 - 1) for v in values)


def _deltas(values):
    return [b - a for a, b in zip([0, *values], values, strict=False)]


def _blob(kind, data, packed=True):
    body = (_field(2, len(data)) + _field(3, zlib.compress(data))) if packed else _field(1, data)
    head = _field(1, kind.encode()) + _field(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def pbf(nodes, ways):
    """A small extract: nodes (id, lat, lon, tags) as dense nodes, ways (id, refs, tags)."""
    strings = [""]

    def code(s):
        if s not in strings:
            strings.append(s)
        return strings.index(s)

    kv = []
    for *_, tags in nodes:
        kv += [x for k, v in tags.items() for x in (code(k), code(v))] + [0]
    unit = lambda x: round(x * 1e7)
    dense = _field(1, _zig(_deltas([n[0] for n in nodes]))) + _field(8, _zig(_deltas([unit(n[1]) for n in nodes]))) + _field(9, _zig(_deltas([unit(n[2]) for n in nodes]))) + _field(10, b"".join(map(_varint, kv)))
    groups = _field(2, _field(2, dense))
    for i, refs, tags in ways:
        w = _field(1, i) + _field(2, b"".join(_varint(code(k)) for k in tags)) + _field(3, b"".join(_varint(code(v)) for v in tags.values())) + _field(8, _zig(_deltas(refs)))
        groups += _field(2, _field(3, w))
    table = _field(1, b"".join(_field(1, s.encode()) for s in strings))
    return _blob("OSMHeader", b"") + _blob("OSMData", table + groups) + _blob("OSMData", table + groups[:0], False)


def test_extract(spark, tmp_path):
    nodes = [(1, 6.9, 79.9, {"amenity": "school"}), (2, 6.91, 79.91, {"shop": "x"}), (3, 6.93, 79.93, {}), (4, -6.5, 79.95, {"tourism": "hotel", "amenity": "restaurant"})]
    ways = [(9, [2, 3], {"building": "apartments"}), (10, [2], {"building": "yes"}), (11, [77], {"landuse": "industrial"})]
    (tmp_path / "x.pbf").write_bytes(pbf(nodes, ways))
    spark.dataSource.register(osm.OsmPbf)
    read = lambda every: spark.read.format("osm_pbf").option("all_nodes", every).load(str(tmp_path / "x.pbf"))
    got = {r.POI_ID: (r.POI_Type, round(r.Latitude, 5), round(r.Longitude, 5)) for r in osm.points(osm.with_way_places(read("false"), read("true"))).collect()}
    assert got == {"POI_000000": ("school", 6.9, 79.9), "POI_000001": ("restaurant", -6.5, 79.95), "POI_000002": ("apartments", 6.92, 79.92)}


def test_csv_missing_values_and_order(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Longitude,Outlet_ID,Latitude\nNA,A, 6.5\n80.1,B,\n,NULL,nan\n")
    got = sorted((tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv"), files.SCHEMAS["outlet_coordinates"]).collect()), key=str)
    assert got == [("A", 6.5, None), ("B", None, 80.1), (None, None, None)]
    assert files.read_csv(spark, str(tmp_path / "a.csv"), files.SCHEMAS["outlet_coordinates"], ["Latitude"]).columns == ["Latitude"]


def test_paths(spark, tmp_path):
    (tmp_path / "b").write_text("")
    assert files.first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).endswith("b")
    with pytest.raises(FileNotFoundError, match="/a"):
        files.require(spark, [str(tmp_path / "b"), str(tmp_path / "a")])
    with pytest.raises(FileNotFoundError):
        files.reuse_or(spark, str(tmp_path / "none"), str(tmp_path / "a"), lambda: None)


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    assert not sinks.write_rejects(df.limit(0), str(tmp_path / "r")) and not (tmp_path / "r").exists()
    assert sinks.write_rejects(df, str(tmp_path / "r"))
    sinks.write_csv(df, str(tmp_path / "c"), single=True)
    assert len(list((tmp_path / "c").glob("part-*"))) == 1
    sinks.write_parquet(df.where("id > 9"), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).dtypes == df.dtypes
    sinks.write_json(spark, str(tmp_path / "j.json"), {"a": "é"})
    assert json.loads((tmp_path / "j.json").read_text()) == {"a": "é"}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    rnd, top = random.Random(3), tmp_path_factory.mktemp("data")
    raw = top / "raw"
    raw.mkdir()
    outlets = [f"OUT_{i:05d}" for i in range(60)]
    write = lambda name, head, rows: (raw / f"{name}.csv").write_text(head + "\n" + "\n".join(",".join(map(str, r)) for r in rows) + "\n")
    write("outlet_master", "Outlet_ID,Outlet_Size,Cooler_Count,Outlet_Type", [(o, rnd.choice(["small", "Large", "NA"]), rnd.randrange(4), rnd.choice(["Grocry", "Hotel", " Kiosk"])) for o in outlets])
    write("outlet_coordinates", "Outlet_ID,Latitude,Longitude", [(o, "" if k == 7 else 0 if k == 8 else round(6.9 + rnd.random() / 50, 5), round(79.9 + rnd.random() / 50, 5)) for k, o in enumerate(outlets)])
    dists = [f"DIST_{c}_{n:02d}" for n, c in enumerate(("W", "W", "S"))]
    rows = [(o, y, m, dists[k % 3], "SKU1", max(1, round(math.exp(3.5 + 0.05 * m - abs(rnd.gauss(0, 0.6)) + rnd.gauss(0, 0.2)))), rnd.randint(100, 9000) / 10) for k, o in enumerate(outlets) for y in (2023, 2024) for m in range(1, 13) if rnd.random() < 0.8]
    write("transactions_history_final", "Outlet_ID,Year,Month,Distributor_ID,SKU_ID,Volume_Liters,Total_Bill_Value", [*rows, rows[0], ("OUT_X", *rows[0][1:])])
    write("distributor_seasonality_details", "Distributor_ID,Year,Month,Seasonality_Index", [(d, y, m, ["Favorable", "Moderate", "Un-Favorable"][(m + k) % 3]) for k, d in enumerate(dists) for y in (2023, 2024) for m in range(1, 13)])
    write("holiday_list", "Date", [(f"2024-{m:02d}-15",) for m in (1, 4, 12)] + [("2024-04-14",)])
    (raw / "extract.osm.pbf").write_bytes(pbf([(k + 1, 6.9 + rnd.random() / 50, 79.9 + rnd.random() / 50, {"amenity": rnd.choice(["school", "hospital"])}) for k in range(40)], []))
    return top


def test_all_steps(spark, root):
    pipe = Pipeline(spark, str(root), budget=30_000.0)
    assert set(pipe.ingest().values()) == {"copied"} and set(pipe.ingest().values()) == {"skipped"}
    assert (root / "raw/holiday_list.csv").read_bytes() == (root / "bronze/holiday_list.csv").read_bytes()
    pipe.clean()
    rejected = spark.read.option("header", True).csv(str(root / "rejected/rejected_transactions"))
    assert {"Duplicate Transaction", "Invalid Outlet_ID"} == {r[0] for r in rejected.select("failure_reason").distinct().collect()}
    assert all(r.status == "OK" for r in pipe.validate().collect())
    pipe.poi()
    assert pipe.table("poi_edges").count() > 0
    pipe.features()
    assert pipe.gold().where("Holiday_Count > 0").count() > 0
    model = pipe.model()
    assert pipe.fitted() == model and model.sigma_u > 0
    pipe.predict()
    check = pipe.verify().first()
    assert check.evaluated == pipe.predictions().count() and check.null_predictions == 0 and check.non_positive == 0
    peaks = pipe.predictions().where(F.col("Maximum_Monthly_Liters") < F.col("Jan_Max")).count()
    assert peaks == 0
    report = pipe.optimize()
    spent = spark.read.parquet(str(root / "outputs/allocations")).agg(F.sum("Trade_Spend_Allocation_LKR")).first()[0]
    assert abs(spent - 30_000) < 1 and "DIST_W_00" in report and (root / "reports/spend_summary.md").exists()
    told = pipe.explain(pipe.gold().first().Outlet_ID)
    assert told["narrative"] and told["payload"]["operational_constraints"]


def test_command_line(root, capsys, spark):
    with pytest.raises(SystemExit):
        main(["--root", str(root), "--step", "xai"])
    main(["--root", str(root), "--step", "ingest"])


def test_increments(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    apply_to_increments(stream, lambda b: b.where("id > 4"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
