"""Queries after the fit make only the gold rows that they read, and read the transactions once; results are those of the whole way."""

import random

import pytest
from demandscope.operators import allocation, features, nearby, projection
from demandscope.plans import catalog
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
NAN = float("nan")


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def _transactions(spark, n=400):
    rnd = random.Random(5)
    pick = lambda: (
        f"O{rnd.randrange(25)}", rnd.choice([2023, 2024]), rnd.randrange(1, 5), rnd.choice([None, "DIST_W_01", "DIST_W_02", "DIST_C_03"]), rnd.choice([None, NAN, -9.0, 0.0, 9.0, 12.25, 100.5]), rnd.choice([None, 5.0, 80.75])
    )
    rows = [pick() for _ in range(n)] + [("unsold", 2024, 1, "DIST_W_01", -3.0, 1.0), ("nobody", 2024, 1, None, 4.0, 1.0), ("even", 2024, 1, "DIST_W_01", 4.0, 1.0), ("even", 2024, 1, "DIST_W_01", -4.0, 1.0)]
    return spark.createDataFrame(rows, "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Liters double, Total_Bill_Value double")


def _places(rnd, n, wide):
    return [(6.9 + rnd.uniform(0, wide), 80.0 + rnd.uniform(0, wide)) for _ in range(n)]


@pytest.mark.parametrize("wide,pairs", [(0.03, 200_000_000), (0.15, 3_000)])
def test_counted_competitors_are_those_of_the_totals(spark, monkeypatch, wide, pairs):
    monkeypatch.setattr(nearby, "TASK_PAIRS", pairs)
    monkeypatch.setattr(nearby, "BLOCK_PAIRS", 50)
    o = [(f"O{i}", *p) for i, p in enumerate(_places(random.Random(3), 150, wide))] + [("twice", 6.95, 80.01), ("twice", 6.951, 80.01), ("alone", 9.0, 81.0), ("lost", None, 80.0)]
    outlets = spark.createDataFrame(o, "Outlet_ID string, Latitude double, Longitude double")
    got, want = nearby.competitor_counts(outlets), nearby.competitor_totals(outlets).select("Outlet_ID", "Competitor_Count_5km")
    assert got.dtypes == want.dtypes and len(_rows(want)) > 100 and _rows(got) == _rows(want)


def test_histories_tell_what_the_transactions_tell(spark):
    t = _transactions(spark)
    h = projection.histories(t).cache()
    peaks = h.where("Overall_Max IS NOT NULL").select("Outlet_ID", "Overall_Max", "Jan_Max")
    assert _rows(peaks) == _rows(projection.historical_peaks(t))
    assert _rows(h.select("Outlet_ID", "Distributor_ID")) == _rows(projection.first_per_group(t, "Outlet_ID", ["Distributor_ID"], ["Year", "Month", "Distributor_ID"]))
    panel = features.monthly_panel(t).where("Volume_Liters > 0")
    first = panel.groupBy("Outlet_ID").agg(F.min(F.struct("Year", "Month", "Distributor_ID")).alias("k")).select("Outlet_ID", "k.*")
    assert _rows(projection.first_sales(h)) == _rows(first) and len(_rows(first)) == 25
    predictions = h.select("Outlet_ID", F.lit(100.0).alias("Maximum_Monthly_Liters"))
    assert _rows(projection.ceiling_verification(predictions, h)) == _rows(projection.ceiling_verification(predictions, t))
    own = allocation.in_province(t)
    want = allocation.baselines(own).join(allocation.prices(own), "Outlet_ID").join(projection.first_per_group(own, "Outlet_ID", ["Distributor_ID"], ["Year", "Month", "Distributor_ID"]), "Outlet_ID")
    assert _rows(allocation.histories(own)) == _rows(want)


def test_gold_rows_of_newest_months_are_those_of_the_gold_table(spark):
    t = _transactions(spark)
    rnd = random.Random(6)
    outlets = spark.createDataFrame([(f"O{i}", "Large", i % 4, "Grocery", *p) for i, p in enumerate(_places(rnd, 20, 0.05))], "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string, Latitude double, Longitude double")
    points = spark.createDataFrame([(f"P{i}", "school", *p) for i, p in enumerate(_places(rnd, 40, 0.05))], "POI_ID string, POI_Type string, Latitude double, Longitude double")
    season = spark.createDataFrame([("DIST_W_01", 2024, m, "Moderate") for m in range(1, 4)], "Distributor_ID string, Year int, Month int, Seasonality_Index string")
    days = spark.createDataFrame([("2024-01-05",), ("2024-02-04",)], "Date string")
    wanted = [*catalog.MODEL.features, "CV_Volume"]
    whole = features.gold_features(t, outlets, nearby.competitor_totals(outlets), nearby.poi_totals(outlets, points), season, days)
    near = (outlets, nearby.competitor_counts(outlets), nearby.poi_totals(outlets, points))
    some = features.gold_features(t, *near, season, days, wanted=wanted)
    assert {*some.columns} < {*whole.columns} and _rows(some) == _rows(whole.select(*some.columns))
    got = features.gold_rows(features.newest_months(t), *near, season, days, features.VOCABULARIES, catalog.MODEL.features)
    newest = whole.groupBy("Outlet_ID").agg(F.min_by(F.struct(*[c for c in got.columns if c != "Outlet_ID"]), F.struct(-F.col("Year"), -F.col("Month"), "Distributor_ID")).alias("r")).select("Outlet_ID", "r.*")
    assert len(_rows(newest)) == 20 and _rows(got) == _rows(newest)


@pytest.mark.parametrize(
    "name,readings",
    [*((q, 1) for q in ("latent_potential", "ceiling_verification", "ratio_distribution", "driver_impacts", "driver_impacts_legacy", "explanation_metrics", "explanation_payload", "sfa_loglik_terms", "outlet_report", "efficiency_correlation")),
     *((q, 2) for q in ("spend_allocation", "allocation_summary", "spend_by_distributor", "spend_by_size", "spend_by_type"))],
)
def test_transactions_are_read_once_and_competitors_only_counted(spark, monkeypatch, name, readings):
    made, whole = [], catalog.T.transactions
    monkeypatch.setattr(catalog.T, "transactions", lambda *a: made.append(1) or whole(*a))
    monkeypatch.setattr(nearby, "competitor_totals", lambda *a: pytest.fail("the pairs' frictions aren't wanted"))
    catalog.QUERIES[name](spark, SF)
    assert len(made) == readings  # the province's own outlets take another


def test_places_at_the_radius_itself_are_counted():
    import numpy as np

    x, y = np.array([0.0, 3000.0, 5000.0, 0.0, 5000.1]), np.array([0.0, 4000.0, 0.0, -5000.0, 0.0])
    who = np.arange(5)
    assert nearby.rivals(x[:1], y[:1], who[:1], x, y, who, 5000.0).tolist() == [3]
