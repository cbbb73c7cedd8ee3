"""Anomaly detectors. Each takes and returns DataFrames; column names are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import equal_total, number, ratio, total

MAGIC = (9999, 1111, 1234, 0, -1)
MONTH = ("Year", "Month")


def _repeated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows whose key stands more than once, missing values being equal.

    Keys are counted with partial sums and joined back: a hot key is split over tasks, where a window would gather it in one.
    """
    many = df.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    on = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return df.alias("l").join(many.alias("r"), on, "left_semi")


def negative_quantities(df: DataFrame, column: str = "Volume_Liters") -> DataFrame:
    return df.where(number(column) < 0)


def impossible_spikes(df: DataFrame, column: str = "Total_Bill_Value", threshold_z: float = 3.0) -> DataFrame:
    """Rows above the mean plus ``threshold_z`` deviations of all rows; the two statistics are one row, joined to all."""
    stats = df.agg((F.avg(number(column)) + F.lit(threshold_z) * F.stddev_samp(number(column))).alias("__limit"))
    return df.crossJoin(F.broadcast(stats)).where(number(column) > F.col("__limit")).drop("__limit")  # a single row


def duplicate_invoices(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    return _repeated(df, keys or df.columns)


def repeated_timestamps(df: DataFrame, time_column: str, outlet: str = "Outlet_ID") -> DataFrame:
    """Rows of an outlet at the same time as another; no rows if the column isn't there."""
    return _repeated(df, [outlet, time_column]) if time_column in df.columns else df.limit(0)


def midnight_batches(df: DataFrame, time_column: str) -> DataFrame:
    """Rows at hour, minute and second zero; fractions of the second don't count."""
    if time_column not in df.columns:
        return df.limit(0)
    t = F.col(time_column)
    return df.where((F.hour(t) == 0) & (F.minute(t) == 0) & (F.second(t) == 0))


def duplicate_gps(coordinates: DataFrame) -> DataFrame:
    return _repeated(coordinates, ["Latitude", "Longitude"])


def invalid_coordinates(coordinates: DataFrame) -> DataFrame:
    return coordinates.where((F.abs(number("Latitude")) > 90) | (F.abs(number("Longitude")) > 180))


def outlets_in_ocean(coordinates: DataFrame, lat=(5.9, 9.9), lon=(79.6, 81.9)) -> DataFrame:
    """Outside the bounding box; missing coordinates count as outside."""
    inside = number("Latitude").between(*lat) & number("Longitude").between(*lon)
    return coordinates.where(~F.coalesce(inside, F.lit(False)))


def inactive_outlets(master: DataFrame, transactions: DataFrame) -> DataFrame:
    return master.join(transactions.select("Outlet_ID").distinct(), "Outlet_ID", "left_anti")


def extreme_volatility(transactions: DataFrame, column: str = "Total_Bill_Value", limit: float = 2.0) -> DataFrame:
    """Transactions of outlets whose coefficient of variation is above the limit."""
    wild = transactions.groupBy("Outlet_ID").agg(ratio(F.stddev_samp(number(column)), F.avg(number(column))).alias("__cv")).where(F.col("__cv") > limit)
    return transactions.join(wild, "Outlet_ID", "left_semi")


def delivery_caps(transactions: DataFrame, column: str = "Volume_Liters") -> DataFrame:
    """Distributor months with a sum that another month of the distributor has too. Sums are decimals, so equality is exact."""
    months = transactions.groupBy("Distributor_ID", *MONTH).agg(equal_total(F.col(column)).alias("total"))
    return _repeated(months, ["Distributor_ID", "total"]).withColumn("total", F.col("total").cast("double"))


def round_numbers(transactions: DataFrame, column: str = "Total_Bill_Value", divisor: float = 1000) -> DataFrame:
    return transactions.where(number(column) % divisor == 0)


def monthly_ceilings(transactions: DataFrame, column: str = "Total_Bill_Value") -> DataFrame:
    """All months (Distributor_ID, Year, Month, total) of distributors that reach their largest monthly sum more than once. Rows without a key are left out."""
    months = transactions.dropna(subset=["Distributor_ID", *MONTH]).groupBy("Distributor_ID", *MONTH).agg(F.coalesce(equal_total(F.col(column)), F.lit(0)).alias("total"))
    capped = months.groupBy("Distributor_ID", "total").agg(F.count("*").alias("n")).groupBy("Distributor_ID").agg(F.max_by("n", "total").alias("n")).where("n > 1")
    return months.join(capped, "Distributor_ID", "left_semi").withColumn("total", F.col("total").cast("double"))


def id_noise(df: DataFrame, column: str) -> DataFrame:
    """(noise, value): distinct ids with lower case, white space at an end, or other symbols than A-Z, 0-9 and underscore."""
    v = F.col("value")
    kinds = F.array(F.when(v.rlike("[a-z]"), "lowercase"), F.when(v.rlike(r"^\s|\s$"), "whitespace"), F.when(v.rlike("[^A-Z0-9_]"), "symbol"))
    return df.select(F.col(column).alias("value")).distinct().select("value", F.explode(F.array_compact(kinds)).alias("noise"))


def ghost_entries(transactions: DataFrame, column: str = "Total_Bill_Value", limit: float = 1.0) -> DataFrame:
    """Outlets whose sum is below the limit."""
    return transactions.groupBy("Outlet_ID").agg(total(F.col(column)).alias("total")).where(F.col("total") < limit)


def batch_writes(transactions: DataFrame, keys: Sequence[str] = ("Distributor_ID", "Year", "Month", "Total_Bill_Value"), limit: int = 50) -> DataFrame:
    """Groups of more than ``limit`` equal records."""
    return transactions.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("records")).where(F.col("records") > limit)


def count_spikes(transactions: DataFrame, threshold_z: float = 3.0) -> DataFrame:
    """Distributor months with more records than the mean plus ``threshold_z`` deviations of all of them."""
    months = transactions.groupBy("Distributor_ID", *MONTH).agg(F.count("*").alias("tx_count"))
    return impossible_spikes(months, "tx_count", threshold_z)


def data_decay(transactions: DataFrame, months: int = 6) -> DataFrame:
    """Outlets last seen more than ``months`` before the last month of all."""
    day = F.make_date(F.col("Year"), F.col("Month"), F.lit(1))
    seen = transactions.groupBy("Outlet_ID").agg(F.max(day).alias("last_seen"))
    end = seen.agg(F.add_months(F.max("last_seen"), -months).alias("__limit"))
    return seen.crossJoin(F.broadcast(end)).where("last_seen < __limit").drop("__limit")  # a single row


def magic_numbers(transactions: DataFrame, column: str = "Total_Bill_Value", numbers: Sequence[float] = MAGIC) -> DataFrame:
    """(value, hits) of default values found."""
    return transactions.where(F.col(column).isin(*[float(x) for x in numbers])).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("hits"))
