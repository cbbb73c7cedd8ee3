"""Rules of the domain on made-up rows: sums of doubles, missing numbers, distributors' ceilings, the data's own categories, coordinates, quantiles, pairs, the fit."""

import math
import os
import random

import numpy as np
import pytest
from demandscope.operators import anomalies, cleaning, features, frontier, projection, quality, spatial
from demandscope.plans import catalog
from demandscope.sources import files

T = "Outlet_ID string, Year int, Month int, Distributor_ID string, SKU_ID string, Volume_Liters double, Total_Bill_Value double"
NAN = float("nan")


def trans(spark, rows):
    return spark.createDataFrame([(o, y, m, d, "S", v, b) for o, y, m, d, v, b in rows], T)


def test_sums_round_once_at_the_end(spark):
    t = trans(spark, [("A", 2024, 1, "D", 0.125, 0.004), ("A", 2024, 1, "D", 0.125, 0.004), ("B", 2024, 1, "D", 1e16, NAN), ("B", 2024, 1, "D", NAN, 2.5)])
    got = {r.Outlet_ID: (r.Volume_Liters, r.Total_Bill_Value) for r in features.monthly_panel(t).collect()}
    assert got == {"A": (0.25, 0.008), "B": (1e16, 2.5)}
    assert {r.Outlet_ID: r.Overall_Max for r in projection.historical_peaks(t).collect()} == {"A": 0.25, "B": 1e16}


def test_equal_sums_are_equal_in_any_order(spark):
    parts = [0.1, 0.2, 0.3, 0.7, 1e-3, 123456.789]
    rows = [("A", 2024, m, "D", v, 1.0) for m in range(1, 7) for v in random.Random(m).sample(parts, len(parts))]
    assert anomalies.delivery_caps(trans(spark, rows).repartition(5)).count() == 6
    flat = features.constraint_proxies(features.monthly_panel(trans(spark, rows).repartition(5))).first()
    assert flat.Flatline_Score == 1.0


def test_ceilings_are_distributors(spark):
    rows = [("A", 2024, 1, "D", 2.0, 1.0), ("B", 2024, 1, "D", 3.0, 1.0), ("A", 2024, 2, "D", 5.0, 1.0), ("B", 2024, 3, "D", 1.0, 1.0), ("A", 2024, 1, "E", 9.0, 1.0), ("A", 2024, 2, "E", 1.0, 1.0), ("A", 2024, 3, "E", 1.0, 1.0)]
    got = sorted(tuple(r) for r in anomalies.monthly_ceilings(trans(spark, rows), "Volume_Liters").collect())
    assert got == [("D", 2024, 1, 5.0), ("D", 2024, 2, 5.0), ("D", 2024, 3, 1.0)]


def test_nan_is_missing_in_filters(spark):
    t = trans(spark, [("A", 2024, 1, "D", NAN, 1.0), ("A", 2024, 2, "D", 1.0, 2.0), ("A", 2024, 3, "D", 2.0, NAN), ("B", 2024, 1, "D", -1.0, 1.0)])
    assert quality.check_ranges(t, "Volume_Liters", 0.0, 5.0).count() == 1
    assert {r.column_name: r.null_count for r in quality.check_nulls(t, t.columns).collect()} == {"Volume_Liters": 1, "Total_Bill_Value": 1}
    assert anomalies.impossible_spikes(t, "Volume_Liters", 0.5).count() == 1
    assert projection.historical_peaks(t).count() == 1
    c = spark.createDataFrame([("A", NAN, 80.0), ("B", 6.9, 80.0)], "Outlet_ID string, Latitude double, Longitude double")
    m = spark.createDataFrame([("A", "Small", 1, "Hotel"), ("B", "Small", 1, "Hotel")], "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string")
    kept, rejected = cleaning.clean_outlets(m, c)
    assert [r.Outlet_ID for r in kept.collect()] == ["B"] and [r.failure_reason for r in rejected.collect()] == [cleaning.NO_GPS]
    assert anomalies.outlets_in_ocean(c).count() == 1 and spatial.projected(c, "Outlet_ID").count() == 1


def test_report_counts_every_column(spark):
    t = trans(spark, [("A", 2024, 1, "D", 1.0, 1.0), ("A", 2024, 1, "D", 1.0, 1.0), ("Z", None, None, None, NAN, 1.0)])
    o = spark.createDataFrame([("A", None, None, "Hotel", 6.9, 80.0), ("B", "Small", 1, "Hotel", 20.0, NAN)], "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string, Latitude double, Longitude double")
    got = {r.check_name: r.issues for r in quality.silver_report(t, o, cleaning.KEYS).collect()}
    wrong = {"transactions null Year": 1, "transactions null Month": 1, "transactions null Distributor_ID": 1, "transactions null Volume_Liters": 1, "outlets null Outlet_Size": 1, "outlets null Cooler_Count": 1, "outlets null Longitude": 1}
    wrong |= {"transactions duplicates": 1, "transactions orphan outlets": 1, "outlets latitude range": 1}
    assert {k: v for k, v in got.items() if v} == wrong and len(got) == 7 + 6 + 5


@pytest.fixture(scope="module")
def parts(spark):
    t = trans(spark, [(f"O{k}", 2024, m, f"DIST_{'WCN'[k % 3]}_1", 5.0 + k + m, 50.0) for k in range(6) for m in (1, 2)])
    o = spark.createDataFrame([(f"O{k}", ["Small", "Large"][k % 2], k, ["Hotel", "Kiosk", "Castle"][k % 3], 6.9 + k / 1000, 80.0) for k in range(6)], "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string, Latitude double, Longitude double")
    p = spark.createDataFrame([("P1", "school", 6.9, 80.0)], "POI_ID string, POI_Type string, Latitude double, Longitude double")
    season = spark.createDataFrame([("DIST_W_1", 2024, 1, "Moderate"), ("DIST_C_1", 2024, 1, "Favorable")], "Distributor_ID string, Year int, Month int, Seasonality_Index string")
    return t, o, p, season, spark.createDataFrame([("2024-01-15",)], "Date string")


def test_the_data_s_own_categories(parts):
    t, o, p, season, days = parts
    made = lambda **more: features.gold_features(t, o, spatial.competitor_graph(o), spatial.poi_edges(o, p), season, days, **more)
    gold = made(vocabularies=None)
    hot = [c for c in features.drivers(gold) if c.startswith(("Outlet_", "Province_", "Seasonality_"))]
    assert hot == ["Outlet_Type_Hotel", "Outlet_Type_Kiosk", "Outlet_Size_Small", "Province_Northern", "Province_Western", "Seasonality_Index_Moderate"]
    fixed = made()
    assert "Outlet_Type_Bakery" not in fixed.columns and "Outlet_Type_Eatery" in fixed.columns and "Outlet_Type_Castle" not in fixed.columns
    with pytest.raises(ValueError, match="Outlet_Type"):
        made(strict=True)


def test_the_older_table_has_no_competition(parts):
    t, o, p, season, days = parts
    old = features.gold_features_legacy(t, o, spatial.poi_counts(o, p), season, days)
    assert not [c for c in old.columns if "Compet" in c or c.startswith("POI_Impact")] and "POI_Count_1km" in old.columns
    assert old.where("POI_Count_1km IS NULL").count() == 0 or old.count() == 12


def test_coordinates_as_they_came_or_corrected(spark):
    right = spark.createDataFrame([("A", 6.9, 80.0)], "Outlet_ID string, Latitude double, Longitude double")
    raw = spark.createDataFrame([("A", 80.0, 6.9), ("B", 1.0, 1.0)], "Outlet_ID string, Latitude double, Longitude double")
    assert [tuple(r) for r in files.coordinates(right, raw).collect()] == [("A", 80.0, 6.9)]
    assert [tuple(r) for r in files.coordinates(right, raw, use_legacy=False).collect()] == [("A", 6.9, 80.0)]


def test_older_point_counts_are_read(spark, tmp_path):
    (tmp_path / "poi_counts.csv").write_text("Outlet_ID,POI_Count_500m,POI_Count_1km,other\nA,1,2,x\nB,,3,y\n")
    got = files.read_raw(spark, str(tmp_path), "poi_counts")
    assert got.dtypes[1:] == [("POI_Count_500m", "bigint"), ("POI_Count_1km", "bigint")] and sorted(tuple(r) for r in got.collect()) == [("A", 1, 2), ("B", None, 3)]


def test_nan_of_parquet_is_missing(spark, tmp_path):
    spark.createDataFrame([(1, NAN), (2, 3.0)], "k int, v double").write.parquet(str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).where("v > 1").count() == 1


@pytest.mark.parametrize("cells", [2, 4096])
def test_quantiles(spark, monkeypatch, cells):
    monkeypatch.setattr(projection, "CELLS", cells)
    rng = np.random.default_rng(4)
    a, b = np.exp(rng.normal(size=501) * 3), np.repeat([1.0, 2.0, 2.0], 167)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b, strict=True)] + [(None, NAN, None)], "a double, b double, c double")
    got = {r.measure: r for r in projection.describe(df, ["a", "b", "c"], (0.0, 0.05, 0.5, 0.95, 1.0)).collect()}
    assert sorted(got) == ["a", "b"]
    for name, v in (("a", a), ("b", b)):
        for q in (0.0, 0.05, 0.5, 0.95, 1.0):
            assert math.isclose(got[name][f"p{round(q * 100):02d}"], np.quantile(v, q), rel_tol=1e-12)
        assert got[name].n == 501 and got[name].min == v.min() and got[name].max == v.max()


def test_self_join_meets_each_pair_once(spark):
    rnd = random.Random(6)
    p = [(f"a{i}", rnd.uniform(-4000, 4000), rnd.uniform(-4000, 4000)) for i in range(200)] + [("edge", 0.0, 0.0), ("at", 1000.0, 0.0)]
    got = sorted((r.low, r.high) for r in spatial.radius_self_join(spark.createDataFrame(p, "k string, x double, y double"), "k", 1000.0).collect())
    assert got == sorted((a, b) for a, x, y in p for b, u, v in p if a < b and math.sqrt((x - u) * (x - u) + (y - v) * (y - v)) <= 1000.0)


def test_running_numbers(spark):
    df = spark.createDataFrame([("b", 7), ("a", 12), ("a", 3), ("b", 1)], "kind string, id long")
    from pyspark.sql import functions as F

    got = spatial.sequential_ids(df, ["kind", "id"], [F.col("kind"), F.floor(F.col("id") / 10)])
    assert sorted(tuple(r) for r in got.collect()) == [("POI_000000", "a", 3), ("POI_000001", "a", 12), ("POI_000002", "b", 1), ("POI_000003", "b", 7)]


def test_the_fit_of_the_test_tables_is_a_maximum(spark):
    """Gradient next to nothing, and no nearby parameters with a larger likelihood."""
    sf = "/root/testdata/sf0.001"
    if not os.path.isdir(sf):
        pytest.skip("the driver's tables aren't here")
    gold = catalog._gold(spark, sf).cache()
    names = features.drivers(gold)
    model = frontier.fit(gold, names)
    rows = gold.select(*names, "ln_volume").toPandas().astype(float)
    x, y = np.column_stack([rows[n] if n != frontier.INTERCEPT else np.ones(len(rows)) for n in names] + [np.ones(len(rows))]), rows["ln_volume"].to_numpy()
    beta, lu, lv = np.array(model.beta), math.log(model.sigma_u), math.log(model.sigma_v)
    at = frontier.value_and_gradient(x, y, beta, lu, lv)
    scale = np.sqrt((x * x).sum(axis=0) * len(y)) + 1
    assert np.abs(at[1:-3] / scale).max() < 1e-3 and np.abs(at[-3:-1]).max() < 1e-3 * len(y)
    rng = np.random.default_rng(1)
    for _ in range(30):
        step = rng.normal(size=len(beta)) * 0.02 / np.sqrt((x * x).mean(axis=0) + 1e-9)
        assert frontier.value_and_gradient(x, y, beta + step, lu + rng.normal() * 0.02, lv + rng.normal() * 0.02)[0] <= at[0] + 1e-6 * len(y)
    summary = {r.parameter: r.value for r in catalog.sfa_fit(spark, sf).collect()}
    assert summary["sigma_u"] == pytest.approx(model.sigma_u, rel=1e-6) and summary["lambda"] == pytest.approx(model.sigma_u / model.sigma_v, rel=1e-6)
