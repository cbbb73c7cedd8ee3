"""Totals without edges against the totals of the edges."""

import random

import pytest
from demandscope.operators import features, nearby, spatial
from demandscope.plans import catalog
from pyspark.sql import functions as F


def _places(rnd, n, wide):
    return [(6.9 + rnd.uniform(0, wide), 80.0 + rnd.uniform(0, wide)) for _ in range(n)]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("wide,pairs", [(0.03, 200_000_000), (0.15, 3_000)])
def test_totals_are_those_of_the_edges(spark, monkeypatch, wide, pairs):
    monkeypatch.setattr(nearby, "TASK_PAIRS", pairs)
    rnd = random.Random(3)
    o = [(f"O{i}", *p) for i, p in enumerate(_places(rnd, 150, wide))] + [("twice", 6.95, 80.01), ("twice", 6.951, 80.01), ("alone", 9.0, 81.0), ("lost", None, 80.0)]
    kinds = ["station", "school", "odd", None, "hotel", "clinic"]
    p = [(f"P{i}", kinds[i % 6], *at) for i, at in enumerate(_places(rnd, 200, wide))]
    outlets = spark.createDataFrame(o, "Outlet_ID string, Latitude double, Longitude double")
    points = spark.createDataFrame(p, "POI_ID string, POI_Type string, Latitude double, Longitude double")
    want = features.competitor_features(spatial.competitor_graph(outlets))
    got = nearby.competitor_totals(outlets)
    assert got.dtypes == want.dtypes and len(_rows(want)) > 100 and _rows(got) == _rows(want)
    once = outlets.where("Outlet_ID <> 'twice'")
    for scale in (1.0, 10.0, 100.0):
        want = features.poi_features(spatial.poi_edges(once, points, density_scale=scale))
        got = nearby.poi_totals(once, points, density_scale=scale)
        assert got.dtypes == want.dtypes and len(_rows(want)) > 50 and _rows(got) == _rows(want)


def test_proxies_at_once_and_repeated_seasons(spark):
    rnd = random.Random(4)
    panel = [(f"O{i % 9}", 2024, 1 + i % 12, f"D{i % 5}", rnd.choice([None, 0.0, 50.0, 33.0, 7.0]), rnd.uniform(1, 9)) for i in range(200)] + [("one", 2024, 1, "D", 5.0, 1.0)]
    df = spark.createDataFrame(panel, "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Liters double, Total_Bill_Value double")
    close = lambda rows: [(r[0], *(round(v, 9) for v in r[1:])) for r in sorted(rows)]
    assert close(features.proxies_at_once(df).collect()) == close(features.constraint_proxies(df).collect())
    season = spark.createDataFrame([("D", 2024, 1, "Moderate"), ("D", 2024, 1, None), ("E", 2024, 1, "Favorable")], "Distributor_ID string, Year int, Month int, Seasonality_Index string")
    assert {r.Distributor_ID: sorted(map(str, r["__seasons"])) for r in features.season_lists(season).collect()} == {"D": ["Moderate", "None"], "E": ["Favorable"]}


@pytest.mark.parametrize("wide,pairs,sorted_pairs", [(0.03, 200_000_000, 1 << 22), (0.15, 3_000, 500)])
def test_edges_by_tile_are_those_of_the_graph(spark, monkeypatch, wide, pairs, sorted_pairs):
    monkeypatch.setattr(nearby, "TASK_PAIRS", pairs)
    monkeypatch.setattr(nearby, "SORTED_PAIRS", sorted_pairs)
    rnd = random.Random(5)
    same = [("twice", 6.95, 80.01), ("twice", 6.951, 80.01), ("OUT_9", 6.95, 80.01), ("OUT_10", 6.95, 80.01), ("\u00fc", 6.95, 80.02)]
    o = [(f"O{i}", *p) for i, p in enumerate(_places(rnd, 200, wide))] + same + [("alone", 9.0, 81.0), ("lost", None, 80.0), (None, 6.95, 80.01), ("far", 6.95, float("inf"))]
    outlets = spark.createDataFrame(o, "Outlet_ID string, Latitude double, Longitude double")
    want, got = spatial.competitor_graph(outlets), nearby.competitor_edges(outlets)
    assert got.dtypes == want.dtypes and got.count() > 1000 and _rows(got) == _rows(want)
    assert nearby.competitor_edges(outlets.limit(0)).count() == 0


def test_the_query_stores_its_edges_in_few_bytes(spark, tmp_path, monkeypatch):
    places = spark.range(1500).select(F.concat(F.lit("OUT_"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("Outlet_ID"), (6.9 + F.rand(1) / 25).alias("Latitude"), (80.0 + F.rand(2) / 25).alias("Longitude"))
    places.write.parquet(str(tmp_path / "outlets"))
    monkeypatch.setattr(catalog, "_dims", lambda s, d: s.read.parquet(d))
    catalog.competitor_edges(spark, str(tmp_path / "outlets")).write.parquet(str(tmp_path / "edges"))
    rows = spark.read.parquet(str(tmp_path / "edges")).count()
    assert rows > 1_000_000 and sum(f.stat().st_size for f in (tmp_path / "edges").glob("*.parquet")) < 6 * rows
