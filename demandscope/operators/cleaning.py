"""Cleaning of outlets and transactions with quarantined rejects. Kept and rejected rows together are the input's."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import number
from ..functions.text import respell, title

#: Fixed rules of the domain.
KEYS = ("Outlet_ID", "Year", "Month", "Distributor_ID", "SKU_ID", "Volume_Liters", "Total_Bill_Value")
LAT_RANGE, LON_RANGE = (5.9, 9.9), (79.6, 81.9)
SPELLINGS = {"Grocry": "Grocery", "Bakry": "Bakery"}
DUPLICATE, ORPHAN = "Duplicate Transaction", "Invalid Outlet_ID"
NO_GPS, OUTSIDE, SAME_GPS = "Missing GPS Coordinates", "Coordinates Outside Sri Lanka Bounds", "Duplicate GPS Location"


def split(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept without the reason, rejected with it) of rows marked by a nullable ``failure_reason``."""
    return marked.where("failure_reason IS NULL").drop("failure_reason"), marked.where("failure_reason IS NOT NULL")


def mark_transactions(df: DataFrame, outlets: DataFrame) -> DataFrame:
    """``failure_reason`` of each transaction: a repeat of all ``KEYS`` first, then an outlet that isn't in ``outlets``.

    Equal rows are counted in partial sums and then expanded, so that a hot key is never sorted as one group; nulls are equal to each other as keys. A null outlet is an orphan.
    """
    known = outlets.select(F.col("Outlet_ID").alias("__known")).where("__known IS NOT NULL").distinct()
    extra = [c for c in df.columns if c not in KEYS]
    if extra:
        nth = F.row_number().over(Window.partitionBy(*KEYS).orderBy(*extra))
        numbered = df.withColumn("__nth", nth)
    else:
        numbered = df.groupBy(*KEYS).agg(F.count("*").alias("__n")).withColumn("__nth", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).drop("__n")
    joined = numbered.join(known, F.col("Outlet_ID") == F.col("__known"), "left")
    reason = F.when(F.col("__nth") > 1, DUPLICATE).when(F.col("__known").isNull(), ORPHAN)
    return joined.select(*df.columns, reason.alias("failure_reason"))


def clean_transactions(df: DataFrame, outlets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected). Negative volumes are kept; ``validation`` reports them."""
    return split(mark_transactions(df, outlets))


def mark_outlets(master: DataFrame, coordinates: DataFrame) -> DataFrame:
    """Master with coordinates and ``failure_reason``; swapped coordinates are put right; of outlets at one place the smallest id stays."""
    merged = master.join(coordinates.select("Outlet_ID", number("Latitude").alias("Latitude"), number("Longitude").alias("Longitude")), "Outlet_ID", "left")
    inside = lambda lat, lon: F.col(lat).between(*LAT_RANGE) & F.col(lon).between(*LON_RANGE)
    missing = F.col("Latitude").isNull() | F.col("Longitude").isNull()
    right, swapped = inside("Latitude", "Longitude"), inside("Longitude", "Latitude")
    turn = ~missing & ~right & swapped
    merged = merged.withColumns({
        "failure_reason": F.when(missing, NO_GPS).when(~right & ~swapped, OUTSIDE),
        "Latitude": F.when(turn, F.col("Longitude")).otherwise(F.col("Latitude")),
        "Longitude": F.when(turn, F.col("Latitude")).otherwise(F.col("Longitude")),
    })
    # rows that are out already stand alone, so that many missing places are no common group
    bad = F.col("failure_reason").isNotNull()
    place = Window.partitionBy(F.when(bad, F.col("Outlet_ID")), bad, "Latitude", "Longitude").orderBy("Outlet_ID")
    return merged.withColumn("failure_reason", F.coalesce("failure_reason", F.when(F.row_number().over(place) > 1, SAME_GPS)))


def standardise(outlets: DataFrame) -> DataFrame:
    """Trimmed and respelled types; titled sizes, Unknown where missing."""
    return outlets.withColumns({"Outlet_Type": respell(F.trim("Outlet_Type"), SPELLINGS), "Outlet_Size": F.coalesce(title(F.col("Outlet_Size")), F.lit("Unknown"))})


def clean_outlets(master: DataFrame, coordinates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(clean, rejected); rejects keep their raw spellings."""
    kept, rejected = split(mark_outlets(master, coordinates))
    return standardise(kept), rejected
