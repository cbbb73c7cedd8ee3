import math
import random

from demandscope.functions.geo import utm44n
from demandscope.operators import features, spatial
from pyspark.sql import functions as F


def test_projection_regression(spark):
    df = spark.createDataFrame([(6.9271, 79.8612), (0.0, 81.0)], "a double, b double")
    x, y = utm44n(F.col("a"), F.col("b"))
    got = [(r[0], r[1]) for r in df.select(F.round(x, 3), F.round(y, 3)).collect()]
    assert got == [(374190.854, 765840.843), (500000.0, 0.0)]


def test_radius_join_meets_each_pair_once(spark):
    rnd = random.Random(2)
    a = [(f"a{i}", rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(150)] + [("edge", 0.0, 0.0)]
    b = [(f"b{i}", rnd.uniform(-3000, 3000), rnd.uniform(-3000, 3000)) for i in range(150)] + [("at", 1000.0, 0.0), ("past", 1000.0001, 0.0)]
    left, right = spark.createDataFrame(a, "i string, x double, y double"), spark.createDataFrame(b, "j string, rx double, ry double")
    got = sorted((r.i, r.j) for r in spatial.radius_join(left, right, 1000.0).collect())
    want = sorted((i, j) for i, x, y in a for j, u, v in b if math.sqrt((x - u) * (x - u) + (y - v) * (y - v)) <= 1000.0)
    assert got == want and ("edge", "at") in got and ("edge", "past") not in got


def test_graph_orders_ids_as_text(spark):
    o = spark.createDataFrame([("OUT_9", 6.9, 80.0), ("OUT_10", 6.9, 80.001), ("OUT_1", 8.9, 80.0), ("OUT_2", None, 80.0)], "Outlet_ID string, Latitude double, Longitude double")
    g = spatial.competitor_graph(o)
    assert [(r.Source_Outlet_ID, r.Target_Competitor_ID) for r in g.collect()] == [("OUT_10", "OUT_9")]
    f = {r.Outlet_ID: r for r in features.competitor_features(g).collect()}
    assert sorted(f) == ["OUT_10", "OUT_9"] and f["OUT_9"].Competitor_Count_5km == 1


def test_empty_graph_has_a_schema(spark):
    o = spark.createDataFrame([], "Outlet_ID string, Latitude double, Longitude double")
    g = spatial.competitor_graph(o)
    assert g.count() == 0 and g.columns == ["Source_Outlet_ID", "Target_Competitor_ID", "Distance_Meters", "Competitive_Friction"]


def test_poi_multiplier_is_bounded(spark):
    o = spark.createDataFrame([("A", 6.9, 80.0)], "Outlet_ID string, Latitude double, Longitude double")
    p = spark.createDataFrame([("P1", "station", 6.9, 80.0), ("P2", "odd", 6.91, 80.0), ("P3", None, 6.92, 80.0)], "POI_ID string, POI_Type string, Latitude double, Longitude double")
    e = {r.POI_ID: r for r in spatial.poi_edges(o, p).collect()}
    assert sorted(e) == ["P1"] and e["P1"].Regional_Multiplier == 0.2 and e["P1"].Footfall_Impact_Score == 5000.0
    assert {r.POI_ID: r.Regional_Multiplier for r in spatial.poi_edges(o, p, density_scale=1.0).collect()} == {"P1": 2.0}
    assert spatial.poi_edges(o, p, multiplier=False).first().Footfall_Impact_Score == 25000.0


def test_proxies(spark):
    rows = [("one", 1, 50.0, 10.0), *(("same", m, 33.0, 66.0) for m in (1, 2, 3)), ("mix", 1, 50.0, 100.0), ("mix", 2, 100.0, 100.0), ("mix", 3, 0.0, 5.0), ("mix", 4, None, 5.0)]
    panel = spark.createDataFrame([(o, 2024, m, "D", v, b) for o, m, v, b in rows], "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Liters double, Total_Bill_Value double")
    got = {r.Outlet_ID: r for r in features.constraint_proxies(panel).collect()}
    assert (got["one"].CV_Volume, got["one"].Flatline_Score, got["one"].Round_Number_Bias, got["one"].Price_Rigidity) == (0.0, 0.0, 1.0, 0.0)
    assert (got["same"].CV_Volume, got["same"].Flatline_Score, got["same"].Round_Number_Bias) == (0.0, 1.0, 0.0)
    assert got["mix"].Flatline_Score == 0.25 and got["mix"].Round_Number_Bias == 0.75 and got["mix"].Price_Rigidity == 0.5


def test_panel_drops_missing_keys_and_sums_missing_values_to_zero(spark):
    t = spark.createDataFrame([("A", 2024, 1, "D", None, 1.0), ("A", 2024, 1, "D", None, 0.1), (None, 2024, 1, "D", 5.0, 5.0)], "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Liters double, Total_Bill_Value double")
    assert [tuple(r) for r in features.monthly_panel(t).collect()] == [("A", 2024, 1, "D", 0.0, 1.1)]


def test_vocabulary_check(spark):
    df = spark.createDataFrame([("Bakery", "Small"), ("Castle", "Small")], "Outlet_Type string, Outlet_Size string")
    try:
        features.check_vocabulary(df)
    except ValueError as e:
        assert "Outlet_Type" in str(e)
    else:
        raise AssertionError("an unknown type must be told")
