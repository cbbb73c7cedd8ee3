"""Latent potential of a target month, and the check of ceilings against history."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import SUM_DIGITS, mean, number, ratio, round_half_even, share, total
from .features import LEAST_SUM, PANEL_KEYS, by_outlet, month_number
from .frontier import INTERCEPT, Frontier

#: Fixed mean number of holidays of the target month.
TARGET_MONTH, TARGET_HOLIDAYS, LEAST = 1, 11.3, 0.01
SEASON = "Seasonality_Index_"
CELLS = 4096  # of a measure's range in the search for its quantiles


def first_per_group(df: DataFrame, key: str, values: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First non-missing value of each column in order of ``order`` (a business order, since rows have none)."""
    at = F.struct(*order)
    return df.groupBy(key).agg(*[F.min_by(v, F.when(F.col(v).isNotNull(), at)).alias(v) for v in values])


def latest_row(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The newest row of each key; an aggregate of whole rows, so that a key with many is never sorted."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")).select(key, "__row.*")


def historical_peaks(transactions: DataFrame, month: int = TARGET_MONTH) -> DataFrame:
    """Overall_Max and Jan_Max (the overall one where the month has no sales) of monthly sums of positive volumes."""
    months = transactions.where(number("Volume_Liters") > 0).groupBy("Outlet_ID", "Year", "Month").agg(total(F.col("Volume_Liters")).alias("v"))
    peaks = months.groupBy("Outlet_ID").agg(F.max("v").alias("Overall_Max"), F.max(F.when(F.col("Month") == month, F.col("v"))).alias("m"))
    return peaks.select("Outlet_ID", "Overall_Max", F.coalesce("m", "Overall_Max").alias("Jan_Max"))


def histories(transactions: DataFrame, month: int = TARGET_MONTH) -> DataFrame:
    """What predictions and their check take from the transactions, an outlet a row, after one exchange of them.

    First_Sale: Year, Month, Distributor_ID of the first row of the gold table; Distributor_ID: the first that isn't missing; Overall_Max and Jan_Max as of ``historical_peaks``; hist_max
    and hist_mean of monthly volumes. Sums by distributor are made of the months that can hold the first sale: until the first one with a sale and nothing taken back, or all.
    """
    keys, v, at = list(PANEL_KEYS), F.col("v"), month_number()
    lines = by_outlet(transactions.select(*keys, number("Volume_Liters").alias("v")).where("Outlet_ID IS NOT NULL"))
    dated = F.col("Year").isNotNull() & F.col("Month").isNotNull() & F.col("Distributor_ID").isNotNull()
    # numbers only, so that nothing is sorted by text
    months = lines.groupBy(*keys[:3]).agg(total(v).alias("v"), F.round(F.sum(F.when(v > 0, v)), SUM_DIGITS).alias("up"), F.count_if(dated & (v >= LEAST_SUM)).alias("sold"), F.count_if(dated & (v < 0)).alias("back"))
    # of months without positive sales there is no peak
    told = {
        "Overall_Max": F.max("up"), "Jan_Max": F.coalesce(F.max(F.when(F.col("Month") == month, F.col("up"))), F.max("up")), "hist_max": F.max("v"), "hist_mean": mean(v),
        "__until": F.min(F.when((F.col("sold") > 0) & (F.col("back") == 0), at)),
    }
    own = months.groupBy("Outlet_ID").agg(*[c.alias(k) for k, c in told.items()]).withColumnRenamed("Outlet_ID", "__own")
    # a row an outlet where its lines are already, hence the hint; each outlet keeps lines
    early = lines.join(own.hint("shuffle_hash"), (F.col("Outlet_ID") == F.col("__own")) & F.coalesce(at <= F.col("__until"), F.lit(True)))
    known = [c for c in told if not c.startswith("__")]
    panel = early.groupBy(*keys).agg(F.sum("v").alias("v"), *[F.max(c).alias(c) for c in known])
    sale = F.when(dated & (F.round("v", SUM_DIGITS) > 0), F.struct("Year", "Month", "Distributor_ID"))
    first = F.when(F.col("Distributor_ID").isNotNull(), F.struct("Year", "Month", "Distributor_ID"))
    return panel.groupBy("Outlet_ID").agg(F.min(sale).alias("First_Sale"), F.min(first)["Distributor_ID"].alias("Distributor_ID"), *[F.max(c).alias(c) for c in known])


def first_sales(history: DataFrame) -> DataFrame:
    """Keys of the first gold row of each outlet that has one."""
    return history.where("First_Sale IS NOT NULL").select("Outlet_ID", "First_Sale.*")


def static_features(features: Sequence[str]) -> list[str]:
    """Those that an outlet's first gold row tells; season and holidays are the target month's."""
    return [f for f in features if not f.startswith(SEASON) and f not in ("Holiday_Count", INTERCEPT)]


def target_features(gold: DataFrame, transactions: DataFrame, season: DataFrame, features: Sequence[str], month: int = TARGET_MONTH, holidays: float = TARGET_HOLIDAYS) -> DataFrame:
    """One row an outlet: its first static features, the season of its first distributor in the target month, constant holidays. ``transactions`` may be their ``histories``."""
    seasons = {f: f.removeprefix(SEASON) for f in features if f.startswith(SEASON)}
    rows = first_per_group(gold, "Outlet_ID", static_features(features), ["Year", "Month", "Distributor_ID"])
    made = "First_Sale" in transactions.columns
    distributor = transactions.select("Outlet_ID", "Distributor_ID") if made else first_per_group(transactions, "Outlet_ID", ["Distributor_ID"], ["Year", "Month", "Distributor_ID"])
    then = first_per_group(season.where(F.col("Month") == month), "Distributor_ID", ["Seasonality_Index"], ["Year"])
    found = rows.join(distributor, "Outlet_ID", "left").join(then, "Distributor_ID", "left")
    dummies = {c: F.coalesce((F.col("Seasonality_Index") == s).cast("int"), F.lit(0)) for c, s in seasons.items()}
    return found.withColumns({**dummies, "Holiday_Count": F.lit(holidays)}).select("Outlet_ID", *[f for f in features if f != INTERCEPT])


def latent_potential(gold: DataFrame, transactions: DataFrame, season: DataFrame, model: Frontier, month: int = TARGET_MONTH) -> DataFrame:
    """Outlet_ID, Group_Frontier, Jan_Max, Overall_Max, Maximum_Monthly_Liters.

    The ceiling is the larger of frontier and own peak, lifted by the mean inefficiency of the half-normal model, at 2 places and 0.01 at least.
    ``transactions`` may be their ``histories``, and ``gold`` may then have an outlet's first row only.
    """
    x = target_features(gold, transactions, season, model.features, month)
    peaks = transactions.select("Outlet_ID", "Overall_Max", "Jan_Max") if "First_Sale" in transactions.columns else historical_peaks(transactions, month)
    out = x.select("Outlet_ID", model.potential().alias("Group_Frontier")).join(peaks, "Outlet_ID", "left")
    lift = math.exp(model.sigma_u * math.sqrt(2 / math.pi))
    # a missing peak must not pass for a ceiling
    ceiling = F.when(F.col("Jan_Max").isNotNull(), F.greatest("Group_Frontier", "Jan_Max"))
    return out.withColumn("Maximum_Monthly_Liters", F.when(ceiling.isNotNull(), F.greatest(round_half_even(ceiling * F.lit(lift), 2), F.lit(LEAST))))


def _ratios(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    history = transactions
    if "First_Sale" not in transactions.columns:
        months = transactions.groupBy("Outlet_ID", "Year", "Month").agg(total(F.col("Volume_Liters")).alias("v"))
        history = months.groupBy("Outlet_ID").agg(F.max("v").alias("hist_max"), mean(F.col("v")).alias("hist_mean"))
    both = predictions.select("Outlet_ID", "Maximum_Monthly_Liters").join(history.select("Outlet_ID", "hist_max", "hist_mean"), "Outlet_ID")
    p = F.col("Maximum_Monthly_Liters")
    return both.withColumns({"ratio_to_max": ratio(p, F.col("hist_max")), "ratio_to_mean": ratio(p, F.col("hist_mean"))})


def ceiling_verification(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    """One row: outlets evaluated and unmatched, percent at or above mean and maximum, missing and non-positive predictions, smallest and largest. ``transactions`` may be their ``histories``."""
    p = F.col("Maximum_Monthly_Liters")
    found = _ratios(predictions, transactions).agg(
        F.count("*").alias("evaluated"), (share(p >= F.col("hist_max")) * 100).alias("pct_above_max"), (share(p >= F.col("hist_mean")) * 100).alias("pct_above_mean"),
        F.count_if(~F.coalesce(p >= F.col("hist_max"), F.lit(False))).alias("under_max"),
    )
    own = predictions.agg(F.count("*").alias("__n"), F.count_if(p.isNull()).alias("null_predictions"), F.count_if(p <= 0).alias("non_positive"), F.min(p).alias("min_prediction"), F.max(p).alias("max_prediction"))
    both = found.crossJoin(own)  # a row each
    return both.withColumn("unmatched", F.col("__n") - F.col("evaluated")).drop("__n")


def describe(df: DataFrame, columns: Sequence[str], points: Sequence[float] = (0.05, 0.25, 0.5, 0.75, 0.95)) -> DataFrame:
    """(measure, n, mean, std, min, max, p05 ...): exact quantiles, interpolated between neighbours; missing values are skipped.

    The range of a measure is cut into cells; their counts tell in which cells the wanted ranks lie, and only the values in those are sorted. No task holds
    the values of a whole column.
    """
    rows = df.unpivot([], [number(c).alias(c) for c in columns], "measure", "v").where("v IS NOT NULL")
    stats = rows.groupBy("measure").agg(F.count("v").alias("n"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    wide = F.col("max") - F.col("min")
    cell = F.when(wide > 0, F.least(F.floor((F.col("v") - F.col("min")) / wide * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0)).cast("int")
    placed = rows.join(F.broadcast(stats.select("measure", "min", "max")), "measure").select("measure", "v", cell.alias("cell"))  # a row a column
    counts = placed.groupBy("measure", "cell").agg(F.count("*").alias("c"))
    upto = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, 0)
    cells = counts.withColumn("until", F.sum("c").over(upto("measure", "cell")))
    # of each point the two ranks that it lies between, and how far it is from the first
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("point"), ((F.col("n") - 1) * F.lit(float(q))).alias("h")) for k, q in enumerate(points)])).alias("w")
    wanted = stats.select("measure", "n", at).select("measure", "w.point", (F.col("w.h") - F.floor("w.h")).alias("share"), F.explode(F.array(F.floor("w.h"), F.least(F.floor("w.h") + 1, F.col("n") - 1))).alias("rank"))
    wanted = wanted.distinct().join(cells.withColumnRenamed("measure", "m"), (F.col("measure") == F.col("m")) & (F.col("rank") < F.col("until")) & (F.col("rank") >= F.col("until") - F.col("c")))
    wanted = wanted.select("measure", "point", "share", "cell", (F.col("rank") - F.col("until") + F.col("c")).alias("inside"))  # two rows a point and column
    near = placed.join(F.broadcast(wanted.select("measure", "cell").distinct()), ["measure", "cell"], "left_semi").groupBy("measure", "cell", "v").agg(F.count("*").alias("c"))
    near = near.withColumn("until", F.sum("c").over(upto("measure", "cell", "v")))
    met = near.join(F.broadcast(wanted.withColumnsRenamed({"measure": "m", "cell": "k"})), (F.col("measure") == F.col("m")) & (F.col("cell") == F.col("k")) & (F.col("inside") < F.col("until")) & (F.col("inside") >= F.col("until") - F.col("c")))
    low, high = F.min("v"), F.max("v")
    values = met.groupBy("measure", "point").agg((low + (high - low) * F.max("share")).alias("q"))
    quantiles = values.groupBy("measure").agg(*[F.max(F.when(F.col("point") == k, F.col("q"))).alias(f"p{round(q * 100):02d}") for k, q in enumerate(points)])
    return stats.join(quantiles, "measure").select("measure", "n", "mean", "std", "min", *[f"p{round(q * 100):02d}" for q in points], "max")


def ratio_distribution(predictions: DataFrame, transactions: DataFrame) -> DataFrame:
    """``describe`` of the ratios to maximum and mean, and of that to the maximum where it isn't reached (``ratio_under_max``)."""
    both = _ratios(predictions, transactions)
    under = F.when(F.col("Maximum_Monthly_Liters") < F.col("hist_max"), F.col("ratio_to_max"))
    return describe(both.select("ratio_to_max", "ratio_to_mean", under.alias("ratio_under_max")), ["ratio_to_max", "ratio_to_mean", "ratio_under_max"])
