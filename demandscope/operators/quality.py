"""Data-quality checks and the two validation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import missing, number


def _missing(df: DataFrame, column: str) -> Column:
    return missing(column) if dict(df.dtypes)[column] in ("double", "float") else F.col(column).isNull()


def check_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, null_count) of columns that have missing values; a column that isn't there is skipped. One pass."""
    there = [c for c in columns if c in df.columns]
    if not there:
        return df.sparkSession.createDataFrame([], "column_name string, null_count long")
    counts = df.agg(*[F.count_if(_missing(df, c)).alias(c) for c in there])
    return counts.unpivot([], there, "column_name", "null_count").where("null_count > 0")


def check_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """duplicate_count: rows beyond the first of each key; missing keys are equal to each other."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_count"))


def check_ranges(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """Rows outside [low, high]; a missing value passes."""
    v = number(column)
    return df.where((v < low) | (v > high))


def check_referential_integrity(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """missing_key: distinct keys of the child without a parent, a missing key included."""
    keys = child.select(F.col(child_key).alias("missing_key")).distinct()
    return keys.join(parent.select(F.col(parent_key).alias("__p")).distinct(), F.col("missing_key") == F.col("__p"), "left_anti")


def check_datatypes(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """(column_name, expected, found) of columns whose type differs, or that aren't there."""
    found = dict(df.dtypes)
    rows = [(c, t, found.get(c, "Missing Column")) for c, t in schema.items() if found.get(c) != t]
    return df.sparkSession.createDataFrame(rows, "column_name string, expected string, found string")


def _in_one_pass(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, issues) of conditions, all counted in one pass."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(name) for name, c in checks.items()])
    return counts.unpivot([], [F.col(f"`{name}`") for name in checks], "check_name", "issues")


def _one(df: DataFrame, name: str, count: Column) -> DataFrame:
    return df.agg(F.coalesce(count, F.lit(0)).cast("long").alias("issues")).select(F.lit(name).alias("check_name"), "issues")


def _outside(column: str, low: float, high: float) -> Column:
    v = number(column)
    return (v < low) | (v > high)


def _report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).withColumn("status", F.when(F.col("issues") == 0, "OK").otherwise("FAIL"))


def silver_report(transactions: DataFrame, outlets: DataFrame, keys: Sequence[str], lat=(5.9, 9.9), lon=(79.6, 81.9)) -> DataFrame:
    """check_name, issues, status of the cleaned layer: missing values of every column, repeats, orphans and coordinates. A pass over each table and one each for repeats and orphans."""
    of = lambda df, name: {f"{name} null {c}": _missing(df, c) for c in df.columns}
    places = {"outlets latitude range": _outside("Latitude", *lat), "outlets longitude range": _outside("Longitude", *lon)}
    return _report(
        _in_one_pass(transactions, of(transactions, "transactions")),
        _in_one_pass(outlets, of(outlets, "outlets") | places),
        _one(check_duplicates(transactions, keys), "transactions duplicates", F.sum("duplicate_count")),
        _one(check_duplicates(outlets, ["Outlet_ID"]), "outlets duplicates", F.sum("duplicate_count")),
        _one(check_referential_integrity(transactions, outlets, "Outlet_ID", "Outlet_ID"), "transactions orphan outlets", F.count("*")),
    )


def bronze_report(transactions: DataFrame, master: DataFrame, keys: Sequence[str], volume=(0.0, 1e9)) -> DataFrame:
    """check_name, issues, status of raw transactions: missing values, volume range, repeats, orphans."""
    return _report(
        _in_one_pass(transactions, {f"null {c}": _missing(transactions, c) for c in keys} | {"volume range": _outside("Volume_Liters", *volume)}),
        _one(check_duplicates(transactions, keys), "duplicates", F.sum("duplicate_count")),
        _one(check_referential_integrity(transactions, master, "Outlet_ID", "Outlet_ID"), "orphan outlets", F.count("*")),
    )
