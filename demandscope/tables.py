"""The driver's star schema read as outlets, transactions, points of interest, seasons and holidays.

The only place that knows both vocabularies. A customer is an outlet, an order line a transaction, a supplier a distributor, a part a
point of interest; coordinates and faults are functions of the keys, so that both engines make the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.features import VOCABULARIES as VOCABULARIES_OF_THE_DOMAIN

#: The driver's categories of the gold table's 0/1 columns.
VOCABULARIES = VOCABULARIES_OF_THE_DOMAIN | {"Outlet_Type": ("Automobile", "Bakery", "Building", "Furniture", "Grocery", "Household", "Machinery")}
CODES = ("W", "C", "S", "NW", "E", "NC", "U", "SG", "N", "X")
POI_TYPES = ("bus_stop", "school", "hospital", "hotel", "place_of_worship", "marketplace", "station", "clinic", "university", "apartments", "guest_house", "industrial", "restaurant", "museum", "college", "bus_station", "unknown")


MOON = 29_530_589  # millionths of a day in a mean month of the moon


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _outlet(key) -> F.Column:
    return F.concat(F.lit("OUT_"), F.lpad(key.cast("string"), 7, "0"))


def distributors(spark, sf_dir) -> DataFrame:
    """s_suppkey and Distributor_ID like DIST_W_0000012, the code by the supplier's nation."""
    code = F.element_at(F.array(*[F.lit(c) for c in CODES]), (F.col("s_nationkey") % len(CODES) + 1).cast("int"))
    return raw(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("DIST_"), code, F.lit("_"), F.lpad(F.col("s_suppkey").cast("string"), 7, "0")).alias("Distributor_ID"))


def transactions(spark, sf_dir) -> DataFrame:
    """Outlet_ID, Year, Month, Distributor_ID, SKU_ID, Volume_Liters, Total_Bill_Value.

    What an order tells is made once for all of its lines; distributors are joined first, so that those of one province leave few lines for the orders.
    """
    o = raw(spark, sf_dir, "orders").select("o_orderkey", _outlet(F.col("o_custkey")).alias("Outlet_ID"), F.year("o_orderdate").alias("Year"), F.month("o_orderdate").alias("Month"))
    lines = raw(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    t = lines.join(distributors(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey")).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
    return t.select(
        "Outlet_ID", "Year", "Month", "Distributor_ID",
        F.concat(F.lit("SKU_"), F.col("l_partkey").cast("string")).alias("SKU_ID"), F.col("l_quantity").alias("Volume_Liters"), F.col("l_extendedprice").alias("Total_Bill_Value"),
    )


def dirty_transactions(spark, sf_dir) -> DataFrame:
    """Transactions with every line of orders divisible by 53 twice, and outlets divisible by 29 under an unknown id."""
    t = transactions(spark, sf_dir)
    n = F.substring("Outlet_ID", 5, 7).cast("int")
    t = t.withColumn("Outlet_ID", F.when(n % 29 == 0, F.concat(F.lit("BAD_"), F.substring("Outlet_ID", 5, 7))).otherwise(F.col("Outlet_ID")))
    return t.unionByName(t.where(F.substring("SKU_ID", 5, 20).cast("int") % 53 == 0))


def outlet_master(spark, sf_dir) -> DataFrame:
    """Outlet_ID, Outlet_Size, Cooler_Count, Outlet_Type, with odd spellings and missing sizes."""
    k = F.col("c_custkey")
    sizes = F.element_at(F.array(F.lit(None), *[F.lit(x) for x in ("small", " Medium", "LARGE", "extra large", "Small", "Large ")]), (k % 7 + 1).cast("int"))
    kind = F.when(k % 11 == 0, "Grocry").when(k % 13 == 0, " Bakry ").otherwise(F.initcap("c_mktsegment"))
    return raw(spark, sf_dir, "customer").select(_outlet(k).alias("Outlet_ID"), sizes.alias("Outlet_Size"), (k % 6).cast("int").alias("Cooler_Count"), kind.alias("Outlet_Type"))


def _lat(k):
    return F.lit(6.5) + ((k * 7919) % 8009).cast("double") / F.lit(10000.0)


def _lon(k):
    return F.lit(79.85) + ((k * k * 31 + k * 104729) % 7001).cast("double") / F.lit(10000.0)


def outlet_coordinates(spark, sf_dir) -> DataFrame:
    """Outlet_ID, Latitude, Longitude: some missing, swapped, at zero, or at a neighbour's place."""
    k = F.col("c_custkey")
    at = F.when(k % 47 == 0, k - 1).otherwise(k)
    lat, lon = _lat(at), _lon(at)
    pick = lambda own, other: F.when(k % 37 == 0, F.lit(None)).when(k % 41 == 0, other).when(k % 43 == 0, F.lit(0.0)).otherwise(own)
    return raw(spark, sf_dir, "customer").select(_outlet(k).alias("Outlet_ID"), pick(lat, lon).alias("Latitude"), pick(lon, lat).alias("Longitude"))


def pois(spark, sf_dir) -> DataFrame:
    """POI_ID, POI_Type, Latitude, Longitude."""
    k = F.col("p_partkey")
    kind = F.element_at(F.array(*[F.lit(x) for x in POI_TYPES]), (k % len(POI_TYPES) + 1).cast("int"))
    lat = F.lit(6.5) + ((k * 6101 + 17) % 8011).cast("double") / F.lit(10000.0)
    lon = F.lit(79.85) + ((k * k * 37 + k * 15485) % 7013).cast("double") / F.lit(10000.0)
    return raw(spark, sf_dir, "part").select(F.concat(F.lit("POI_"), F.lpad(k.cast("string"), 6, "0")).alias("POI_ID"), kind.alias("POI_Type"), lat.alias("Latitude"), lon.alias("Longitude"))


def holidays(spark, sf_dir) -> DataFrame:
    """Date: days of full moon (by the mean month, counted from that of 21 January 2000) on which there are orders."""
    day = F.datediff(F.to_date("o_orderdate"), F.lit("2000-01-21").cast("date")).cast("long") * 1_000_000
    return raw(spark, sf_dir, "orders").where(F.pmod(day, F.lit(MOON)) < 1_000_000).select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("Date")).distinct()


def seasons(spark, sf_dir) -> DataFrame:
    """Distributor_ID, Year, Month, Seasonality_Index for every distributor and every year of the orders. Distributors are spread first, as their table may be a single file."""
    years = raw(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"))
    spread = distributors(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "s_suppkey")
    d = spread.crossJoin(F.broadcast(years))  # a single row
    grid = d.select("Distributor_ID", "s_suppkey", F.explode(F.sequence("first", "last")).alias("Year")).select("*", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("Month"))
    index = F.element_at(F.array(F.lit("Favorable"), F.lit("Moderate"), F.lit("Un-Favorable")), ((F.col("s_suppkey") + F.col("Month")) % 3 + 1).cast("int"))
    return grid.select("Distributor_ID", "Year", "Month", index.alias("Seasonality_Index"))


def events(spark, sf_dir) -> DataFrame:
    """Timestamped records: Outlet_ID, ts, Volume_Liters, Total_Bill_Value."""
    return raw(spark, sf_dir, "events").select("event_id", _outlet(F.col("user_id")).alias("Outlet_ID"), "ts", F.col("value").alias("Total_Bill_Value"))
