"""File sources: delimited text with declared types, Parquet, required and alternative paths, byte-true bronze copies.

Paths are resolved by Hadoop's file systems, so that any store that Spark reads works.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from ..functions.numeric import without_nan
from ..functions.text import missing_to_null

#: Declared schemas of the raw layer.
SCHEMAS = {
    "transactions_history_final": "Outlet_ID string, Year int, Month int, Distributor_ID string, SKU_ID string, Volume_Liters double, Total_Bill_Value double",
    "outlet_master": "Outlet_ID string, Outlet_Size string, Cooler_Count int, Outlet_Type string",
    "outlet_coordinates": "Outlet_ID string, Latitude double, Longitude double",
    "distributor_seasonality_details": "Distributor_ID string, Year int, Month int, Seasonality_Index string",
    "holiday_list": "Date string",
    "poi_counts": "Outlet_ID string, POI_Count_500m long, POI_Count_1km long",
}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def require(spark: SparkSession, paths: Sequence[str]) -> None:
    """Raises FileNotFoundError for the first path that isn't there."""
    for path in paths:
        if not exists(spark, path):
            raise FileNotFoundError(f"Required dataset not found: {path}")


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    for path in paths:
        if exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these is there: {', '.join(paths)}")


def read_csv(spark: SparkSession, path: str, schema: str | StructType, columns: Sequence[str] | None = None) -> DataFrame:
    """Delimited text with a header, in any column order. The usual spellings of a missing value are null; NaN is null; a value that
    doesn't fit its type raises. Columns are read as text and cast, so only those asked for are kept."""
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    text = spark.read.option("header", True).option("multiLine", False).option("escape", '"').csv(path)
    fields = [f for f in wanted if columns is None or f.name in columns]
    return text.select(*[missing_to_null(F.trim(f.name) if not isinstance(f.dataType, StringType) else F.col(f.name)).cast(f.dataType).alias(f.name) for f in fields])


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_csv(spark, f"{folder}/{name}.csv", SCHEMAS[name])


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet with NaN as a missing value."""
    df = spark.read.parquet(path)
    return without_nan(df.select(*columns) if columns else df)


def ingest_bronze(spark: SparkSession, raw: str, bronze: str, names: Sequence[str] = tuple(n for n in SCHEMAS if n != "poi_counts")) -> dict[str, str]:
    """Copies raw files byte for byte; returns what became of each: copied, skipped (there already) or missing."""
    out, util = {}, spark._jvm.org.apache.hadoop.fs.FileUtil
    conf = spark._jsc.hadoopConfiguration()
    for name in names:
        (src_fs, src), (dst_fs, dst) = _fs(spark, f"{raw}/{name}.csv"), _fs(spark, f"{bronze}/{name}.csv")
        if not src_fs.exists(src):
            out[name] = "missing"
        elif dst_fs.exists(dst):
            out[name] = "skipped"
        else:
            dst_fs.mkdirs(dst.getParent())
            util.copy(src_fs, src, dst_fs, dst, False, conf)
            out[name] = "copied"
    return out


def coordinates(corrected: DataFrame, raw: DataFrame, use_legacy: bool = True) -> DataFrame:
    """Outlet_ID, Latitude, Longitude of valid outlets, as they came or corrected."""
    if not use_legacy:
        return corrected.select("Outlet_ID", "Latitude", "Longitude")
    return corrected.select("Outlet_ID").join(raw.select("Outlet_ID", "Latitude", "Longitude"), "Outlet_ID")


def reuse_or(spark: SparkSession, output: str, needed: str, build) -> DataFrame:
    """``build()`` if the input is there, else the output of an earlier run; raises if neither is."""
    if exists(spark, needed):
        return build()
    if exists(spark, output):
        return spark.read.parquet(output)
    raise FileNotFoundError(f"{needed} isn't there, and no earlier output at {output}")


