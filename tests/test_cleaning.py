from demandscope.functions.numeric import clip, ratio, round_half_even, share, skewness_corrected
from demandscope.functions.text import missing_to_null, province
from demandscope.operators import anomalies, cleaning, quality
from pyspark.sql import functions as F

T = "Outlet_ID string, Year int, Month int, Distributor_ID string, SKU_ID string, Volume_Liters double, Total_Bill_Value double"
M = "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string"
C = "Outlet_ID string, Latitude double, Longitude double"


def test_transactions_split_into_kept_and_rejected(spark):
    row = ("A", 2024, 1, "DIST_W_01", "S", 1.0, 2.0)
    t = spark.createDataFrame([row, row, row, ("B", *row[1:]), (None, *row[1:]), (None, *row[1:]), ("A", 2024, 2, None, "S", -1.0, 2.0)], T)
    kept, rejected = cleaning.clean_transactions(t, spark.createDataFrame([("A",), (None,)], "Outlet_ID string"))
    reasons = sorted((r.Outlet_ID or "", r.failure_reason) for r in rejected.collect())
    assert reasons == [("", cleaning.DUPLICATE), ("", cleaning.ORPHAN), ("A", cleaning.DUPLICATE), ("A", cleaning.DUPLICATE), ("B", cleaning.ORPHAN)]
    assert sorted(r.Volume_Liters for r in kept.collect()) == [-1.0, 1.0]
    assert kept.count() + rejected.count() == t.count()
    assert kept.columns == t.columns


def test_transactions_with_more_columns_keep_the_first(spark):
    row = ("A", 2024, 1, "D", "S", 1.0, 2.0)
    t = spark.createDataFrame([(*row, 2), (*row, 1)], T + ", line int")
    kept, rejected = cleaning.clean_transactions(t, spark.createDataFrame([("A",)], "Outlet_ID string"))
    assert [r.line for r in kept.collect()] == [1] and [r.line for r in rejected.collect()] == [2]


def test_outlets(spark):
    places = {"A": (6.9, 79.9), "B": (79.9, 6.9), "C": (0.0, 0.0), "D": (None, 80.0), "E": (6.9, 79.9), "F": (5.9, 81.9), "G": (9.9, 79.6), "H": (5.8999, 80.0)}
    m = spark.createDataFrame([(k, " extra large " if k == "A" else None, 1, " Bakry ") for k in [*places, "I"]], M)
    kept, rejected = cleaning.clean_outlets(m, spark.createDataFrame([(k, *v) for k, v in places.items()], C))
    got = {r.Outlet_ID: r for r in kept.collect()}
    assert sorted(got) == ["A", "F", "G"]  # B is swapped, and then at A's place as E is
    assert got["A"].Outlet_Type == "Bakery" and got["A"].Outlet_Size == "Extra Large" and got["F"].Outlet_Size == "Unknown"
    assert {r.Outlet_ID: r.failure_reason for r in rejected.collect()} == {"B": cleaning.SAME_GPS, "E": cleaning.SAME_GPS, "C": cleaning.OUTSIDE, "H": cleaning.OUTSIDE, "D": cleaning.NO_GPS, "I": cleaning.NO_GPS}
    assert {r.Outlet_Type for r in rejected.collect()} == {" Bakry "}


def test_missing_values_and_rounding(spark):
    df = spark.createDataFrame([(0.285, 1.0), (1.005, 0.0), (2.675, None)], "a double, b double")
    assert [r[0] for r in df.select(round_half_even(F.col("a"))).collect()] == [0.28, 1.0, 2.68]
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [0.285, None, None]
    assert [r[0] for r in df.select(clip(F.col("b"), 0.5, 0.75)).collect()] == [0.75, 0.5, None]
    assert df.agg(share(F.col("b") > 0)).first()[0] == 1 / 3
    assert df.agg(skewness_corrected(F.col("b"))).first()[0] is None
    text = spark.createDataFrame([("NA",), ("x",), ("",)], "t string")
    assert [r[0] for r in text.select(missing_to_null(F.col("t"))).collect()] == [None, "x", None]


def test_province(spark):
    df = spark.createDataFrame([("DIST_W_01",), ("DIST_Q_1",), ("DIST",)], "d string")
    assert [r[0] for r in df.select(province(F.col("d"))).collect()] == ["Western", "Other", "Unknown"]


def test_checks(spark):
    t = spark.createDataFrame([("A", 1.0), ("A", 1.0), (None, None), (None, None), ("C", 9.0)], "k string, v double")
    assert {r.column_name: r.null_count for r in quality.check_nulls(t, ["k", "v", "absent"]).collect()} == {"k": 2, "v": 2}
    assert quality.check_duplicates(t, ["k", "v"]).first()[0] == 2
    assert [r.k for r in quality.check_ranges(t, "v", 0, 5).collect()] == ["C"]
    parent = spark.createDataFrame([("A",), (None,)], "p string")
    assert sorted(str(r[0]) for r in quality.check_referential_integrity(t, parent, "k", "p").collect()) == ["C", "None"]
    assert quality.check_datatypes(t, {"k": "string", "v": "int", "z": "int"}).count() == 2
    assert quality.check_nulls(t, ["absent"]).count() == 0


def test_detectors_on_missing_columns_and_nulls(spark):
    c = spark.createDataFrame([("A", None, 80.0), ("B", 6.0, 80.0), ("C", None, 80.0), ("D", 95.0, 0.0)], C)
    assert anomalies.outlets_in_ocean(c).count() == 3
    assert sorted(r.Outlet_ID for r in anomalies.duplicate_gps(c).collect()) == ["A", "C"]
    assert [r.Outlet_ID for r in anomalies.invalid_coordinates(c).collect()] == ["D"]
    assert anomalies.repeated_timestamps(c, "ts").count() == 0 and anomalies.midnight_batches(c, "ts").count() == 0
    noise = anomalies.id_noise(spark.createDataFrame([("OUT_1",), ("out 2 ",)], "id string"), "id")
    assert sorted(r.noise for r in noise.collect()) == ["lowercase", "symbol", "whitespace"]
