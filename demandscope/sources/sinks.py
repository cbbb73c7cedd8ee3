"""Sinks: Parquet, quarantined rejects, single-file CSV, JSON, and the Markdown spend report."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.allocation import allocation_summary, spend_by


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Overwrites; an empty result still leaves its schema."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def write_rejects(df: DataFrame, path: str) -> bool:
    """Writes rejected rows as CSV, if there are any."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").option("header", True).csv(path)
    return True


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """One distributed write with a header; ``single`` for the small files that are handed over."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).csv(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text from the driver to any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    write_text(spark, path, json.dumps(value, indent=2, ensure_ascii=False))


_HEAD = "| {0} | Outlets | Active | Spend | Share | Lift | ROI |\n| :--- | ---: | ---: | ---: | ---: | ---: | ---: |"


def _section(allocated: DataFrame, column: str, title: str) -> str:
    line = F.format_string("| %s | %,d | %,d | %,.2f | %.2f%% | %,.2f | %.5f |", F.col(column), "outlets", "active_outlets", "total_spend", "spend_share", "total_lift", "roi")
    rows = spend_by(allocated, column).orderBy(column).select(line.alias("t")).collect()  # a row each distributor, size or type
    return f"## {title}\n\n{_HEAD.format(title)}\n" + "\n".join(r.t for r in rows)


def spend_report(allocated: DataFrame, budget: float, b: float) -> str:
    """Markdown: totals, then spend by distributor, size and type. Aggregated by Spark; only the report's lines reach the driver."""
    s = allocation_summary(allocated, budget).first()
    of = lambda n, m: 100 * n / m if m else 0.0
    figures = {
        "Total budget": f"{budget:,.2f}", "Allocated": f"{s.allocated:,.2f} ({of(s.allocated, budget):.2f}%)", "Expected lift (liters)": f"{s.lift:,.2f}", "Return (liters per unit)": f"{s.roi:.5f}",
        "Active outlets": f"{s.active_outlets:,} / {s.outlets:,} ({of(s.active_outlets, s.outlets):.1f}%)", "Outlets at their ceiling": f"{s.ceiling_outlets:,}", "Response parameter": f"{b}",
    }
    top = "# Spend summary\n\n| Measure | Value |\n| :--- | ---: |\n" + "\n".join(f"| {k} | {v} |" for k, v in figures.items())
    parts = [_section(allocated, c, t) for c, t in (("Distributor_ID", "Distributor"), ("Outlet_Size", "Outlet size"), ("Outlet_Type", "Outlet type"))]
    return "\n\n".join([top, *parts]) + "\n"
