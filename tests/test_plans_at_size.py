"""Plans that large tables need: nothing is sorted by text a line at a time, nothing is exchanged twice, and no generated code is too long for Java to compile."""

import random
import re

import pytest
from demandscope.operators import allocation, features, nearby, projection, spatial
from demandscope.plans import catalog
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
LINES = "Outlet_ID string, Year int, Month int, Distributor_ID string, Volume_Liters double, Total_Bill_Value double"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_the_projection_is_compiled(spark):
    p = spark.range(10).select("id", (6.5 + F.rand(1)).alias("Latitude"), (79.9 + F.rand(2)).alias("Longitude"))
    told = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(spatial.projected(p, "id")._jdf.queryExecution().executedPlan())
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", told)]
    assert sizes and max(sizes) < 8000  # beyond that Java interprets a method


def test_monthly_sums_are_not_sorted_by_text(spark):
    plan = _plan(projection.histories(catalog.T.transactions(spark, SF)))
    assert not re.search(r"SortAggregate\(key=\[Outlet_ID#\d+, Year#\d+, Month#\d+\]", plan)
    newest = _plan(features.newest_months(catalog.T.transactions(spark, SF)))
    assert "ShuffledHashJoin" in newest  # only lines of the months that can be the newest are added up


def test_panel_rows_meet_their_outlets_without_a_sort(spark):
    panel = spark.createDataFrame([("O1", 2024, 1, "DIST_W_01", 5.0, 1.0)], LINES)
    outlets = spark.createDataFrame([("O1", 3)], "Outlet_ID string, Cooler_Count int")
    days = spark.createDataFrame([("2024-01-05",)], "Date string")
    assert "ShuffledHashJoin [Outlet_ID" in _plan(features._known(panel, outlets, days))


def test_points_are_dealt_to_their_tiles_by_one_exchange(spark):
    outlets = spark.createDataFrame([(f"O{i}", 6.9 + i / 1000, 80.0) for i in range(20)], "Outlet_ID string, Latitude double, Longitude double")
    assert len(re.findall(r"Exchange hashpartitioning\(__tx", _plan(nearby.competitor_counts(outlets)))) == 2  # outlets and points


def test_distributors_are_spread_before_they_are_multiplied(spark):
    assert re.search(r"Exchange hashpartitioning\(s_suppkey", _plan(catalog.T.seasons(spark, SF)))


def test_a_province_leaves_few_lines_for_the_orders(spark):
    plan = _plan(allocation.in_province(catalog.T.transactions(spark, SF)))
    assert plan.index("l_orderkey") < plan.index("s_suppkey")  # the join with orders stands above that with distributors
    joins = re.findall(r"Join \[(\w+)#", plan)
    assert joins == ["l_orderkey", "l_suppkey"]


def test_a_point_is_dealt_to_few_tiles(spark, monkeypatch):
    made = []
    monkeypatch.setattr(nearby, "once", lambda df: made.append(df) or df)
    outlets = spark.range(900).select(F.concat(F.lit("O"), "id").alias("Outlet_ID"), ((F.col("id") % 30) * 1000.0).alias("x"), (F.floor(F.col("id") / 30) * 1000.0).alias("y"))
    plan = nearby.competitor_counts(outlets)
    inside = plan.count()
    tiles = made[0].count()
    assert inside == 900 and tiles == 9  # of 10 by 10 km, no more than twice the reach
    spots = outlets.select("x", "y", F.lit("school").alias("POI_Type"))
    assert nearby.poi_totals(outlets, spots).count() == 900 and made[1].count() == 25  # of 6 by 6 km


@pytest.mark.parametrize("seed", [1, 2])
def test_goods_taken_back_count_for_first_and_newest_months(spark, seed):
    rnd = random.Random(seed)
    rows = [(f"O{i % 40}", rnd.choice([2023, 2024]), rnd.randrange(1, 4), rnd.choice(["DIST_W_01", "DIST_W_02", None]), rnd.choice([-8.0, -2.0, 2.0, 4e-7, 8.0, None]), 1.0) for i in range(240)]
    t = spark.createDataFrame(rows, LINES)
    panel = features.monthly_panel(t).where("Volume_Liters > 0")
    first = panel.groupBy("Outlet_ID").agg(F.min(F.struct("Year", "Month", "Distributor_ID")).alias("k")).select("Outlet_ID", "k.*")
    assert _rows(projection.first_sales(projection.histories(t))) == _rows(first)
    order = F.struct(-F.col("Year"), -F.col("Month"), "Distributor_ID")
    newest = panel.groupBy("Outlet_ID").agg(F.min_by(F.struct(*[c for c in panel.columns if c != "Outlet_ID"]), order).alias("r")).select("Outlet_ID", "r.*")
    assert _rows(features.newest_months(t)) == _rows(newest)
