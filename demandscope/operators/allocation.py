"""Budget allocation under diminishing returns and ceilings, solved exactly by water-filling.

With price mu = 1 / lambda each outlet spends clip(a * mu - 1 / b, 0, U): zero up to one breakpoint, a slope of a, then its ceiling. Total spend is piecewise
linear in mu, so the exact price lies in the segment where the running sum of slopes and intercepts crosses the budget. Breakpoints are first summed
over ranges of mu; a short ordered pass over the ranges finds the one with the crossing, and only its breakpoints are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import clip, mean, number, ratio, round_half_even, total
from ..session import once
from .features import by_outlet

BUDGET, RESPONSE, TARGET_MONTH, STEEPEST = 5_000_000.0, 0.0005, 1, 50.0
RANGES = 64  # of a factor of e


def in_province(transactions: DataFrame, code: str = "W") -> DataFrame:
    """Transactions of distributors with the province's code; a missing distributor is outside."""
    return transactions.where(F.coalesce(F.col("Distributor_ID").contains(f"_{code}_"), F.lit(False)))


def baselines(transactions: DataFrame, month: int = TARGET_MONTH) -> DataFrame:
    """Y_historical: mean over years of the target month's volume, else mean of all months; 0 if there are none."""
    months = transactions.groupBy("Outlet_ID", "Year", "Month").agg(total(F.col("Volume_Liters")).alias("v"))
    own = mean(F.when(F.col("Month") == month, F.col("v")))
    return months.groupBy("Outlet_ID").agg(F.coalesce(own, mean(F.col("v")), F.lit(0.0)).alias("Y_historical"))


def prices(transactions: DataFrame) -> DataFrame:
    """Price_Per_Liter: sum of bills over sum of volumes, the overall price where an outlet has no volume."""
    return _prices(transactions.groupBy("Outlet_ID").agg(total(F.col("Total_Bill_Value")).alias("bill"), total(F.col("Volume_Liters")).alias("vol"))).select("Outlet_ID", "Price_Per_Liter")


def _prices(own: DataFrame) -> DataFrame:
    """``own`` with Price_Per_Liter of its ``bill`` and ``vol``."""
    every = own.agg(ratio(total(F.col("bill")), total(F.col("vol"))).alias("every"))
    return own.crossJoin(F.broadcast(every)).withColumn("Price_Per_Liter", F.coalesce(ratio(F.col("bill"), F.col("vol")), F.col("every"))).drop("every")  # a single row


def histories(transactions: DataFrame, month: int = TARGET_MONTH) -> DataFrame:
    """``baselines``, ``prices`` and the first Distributor_ID of each outlet, after one exchange of the transactions."""
    v, first = F.col("v"), F.struct("Year", "Month", "Distributor_ID")
    lines = by_outlet(transactions.select("Outlet_ID", "Year", "Month", "Distributor_ID", number("Volume_Liters").alias("l"), number("Total_Bill_Value").alias("b")))
    months = lines.groupBy("Outlet_ID", "Year", "Month").agg(total(F.col("l")).alias("v"), F.sum("l").alias("l"), F.sum("b").alias("b"), F.min(F.when(F.col("Distributor_ID").isNotNull(), first)).alias("f"))
    own = mean(F.when(F.col("Month") == month, v))
    return _prices(once(months.groupBy("Outlet_ID").agg(F.coalesce(own, mean(v), F.lit(0.0)).alias("Y_historical"), total(F.col("b")).alias("bill"), total(F.col("l")).alias("vol"), F.min("f")["Distributor_ID"].alias("Distributor_ID")))).drop("bill", "vol")


def problem(history: DataFrame, predictions: DataFrame, b: float = RESPONSE) -> DataFrame:
    """Headroom, scale a and largest useful spend U of each outlet. The exponent is kept at 50 so that it can't overflow."""
    both = history.join(predictions.select("Outlet_ID", F.col("Maximum_Monthly_Liters").alias("Y_frontier")), "Outlet_ID", "left")
    both = both.withColumn("Y_frontier", F.coalesce("Y_frontier", "Y_historical"))
    both = both.withColumns({"Headroom": clip(F.col("Y_frontier") - F.col("Y_historical"), 0.0), "a": clip(F.col("Y_historical"), 1.0)})
    return both.withColumn("U", (F.exp(F.least(F.col("Headroom") / F.col("a"), F.lit(STEEPEST))) - F.lit(1.0)) / F.lit(b))


def water_level(rows: DataFrame, budget: float, b: float) -> DataFrame:
    """One row: ``mu``, or null where all ceilings together fit the budget. Uses columns a > 0 and U >= 0."""
    a, u = F.col("a"), F.col("U")
    up = F.struct((F.lit(1.0) / (a * F.lit(b))).alias("mu"), a.alias("slope"), F.lit(-1.0 / b).alias("shift"))
    down = F.struct(((u + F.lit(1.0 / b)) / a).alias("mu"), (-a).alias("slope"), (u + F.lit(1.0 / b)).alias("shift"))
    # a ceiling above the budget never binds
    events = rows.where("U > 0").select(F.explode(F.when(u <= budget, F.array(up, down)).otherwise(F.array(up))).alias("e")).select("e.*")
    events = events.withColumn("range", F.floor(F.ln("mu") * RANGES))
    ranges = events.groupBy("range").agg(F.sum("slope").alias("slope"), F.sum("shift").alias("shift"), F.max("mu").alias("top"))
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumns({"s": F.sum("slope").over(upto), "i": F.sum("shift").over(upto)})
    under = ranges.where(F.col("s") * F.col("top") + F.col("i") <= budget).agg(F.max("range").alias("last"), F.max_by("s", "range").alias("s0"), F.max_by("i", "range").alias("i0"))
    start = under.select(F.coalesce("last", F.lit(-(10**9)).cast("long")).alias("last"), F.coalesce("s0", F.lit(0.0)).alias("s0"), F.coalesce("i0", F.lit(0.0)).alias("i0"))
    cut = ranges.crossJoin(F.broadcast(start)).where(F.col("range") > F.col("last")).groupBy("s0", "i0").agg(F.min("range").alias("cut"))
    inside = events.join(F.broadcast(cut), F.col("range") == F.col("cut"))  # a single row
    inside = inside.groupBy("s0", "i0", "mu").agg(F.sum("slope").alias("slope"), F.sum("shift").alias("shift"))  # equal breakpoints are one: small outlets share theirs
    order = Window.orderBy("mu").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumns({"s": F.col("s0") + F.sum("slope").over(order), "i": F.col("i0") + F.sum("shift").over(order)})
    inside = inside.where(F.col("s") * F.col("mu") + F.col("i") <= budget).agg(F.max_by(F.struct("s", "i"), "mu").alias("in"))
    at = start.crossJoin(inside).select(F.coalesce("in.s", "s0").alias("s"), F.coalesce("in.i", "i0").alias("i"))  # a row each
    fits = rows.agg((F.coalesce(F.sum("U"), F.lit(0.0)) <= budget).alias("fits"))
    return at.crossJoin(fits).select(F.when(~F.col("fits"), ratio(F.lit(budget) - F.col("i"), F.col("s"))).alias("mu"))


def spend(mu: Column, b: float) -> Column:
    return F.when(mu.isNull(), F.col("U")).otherwise(clip(F.col("a") * mu - F.lit(1.0 / b), 0.0, F.col("U")))


def allocate(rows: DataFrame, budget: float = BUDGET, b: float = RESPONSE) -> DataFrame:
    """``rows`` with Trade_Spend_Allocation_LKR and Volume_Lift_Liters, both at 2 places."""
    level = F.broadcast(water_level(rows, budget, b))  # a single row
    out = rows.crossJoin(level).withColumn("Trade_Spend_Allocation_LKR", round_half_even(spend(F.col("mu"), b), 2)).drop("mu")
    return out.withColumn("Volume_Lift_Liters", round_half_even(F.col("a") * F.ln(F.lit(1.0) + F.lit(b) * F.col("Trade_Spend_Allocation_LKR")), 2))


def spend_allocation(transactions: DataFrame, predictions: DataFrame, budget: float = BUDGET, b: float = RESPONSE, code: str = "W", month: int = TARGET_MONTH) -> DataFrame:
    """Allocation over the outlets of a province. ``transactions`` may be ``histories`` of those in the province."""
    history = transactions if "Y_historical" in transactions.columns else histories(in_province(transactions, code), month)
    return allocate(once(problem(history.drop("Distributor_ID"), predictions, b)), budget, b)  # the search for the level reads the rows several times


def spend_by(allocated: DataFrame, column: str, label: str | None = None) -> DataFrame:
    """Outlets, active outlets, spend, share of spend, lift and return by a dimension; a missing value has no group."""
    money = lambda c: total(F.col(c))
    groups = allocated.where(F.col(column).isNotNull()).groupBy(F.col(column).alias(label or column)).agg(
        F.count("Outlet_ID").alias("outlets"), F.count_if(F.col("Trade_Spend_Allocation_LKR") > 0.01).alias("active_outlets"), money("Trade_Spend_Allocation_LKR").alias("total_spend"), money("Volume_Lift_Liters").alias("total_lift"),
    )
    every = allocated.agg(money("Trade_Spend_Allocation_LKR").alias("__all"))
    joined = groups.crossJoin(F.broadcast(every))  # a single row
    return joined.withColumns({"spend_share": F.coalesce(ratio(F.col("total_spend"), F.col("__all")) * 100, F.lit(0.0)), "roi": F.coalesce(ratio(F.col("total_lift"), F.col("total_spend")), F.lit(0.0))}).drop("__all")


def allocation_summary(allocated: DataFrame, budget: float = BUDGET) -> DataFrame:
    """One row: spend, lift, return, active outlets, and outlets at their ceiling within a relative 1e-3."""
    x, u = F.col("Trade_Spend_Allocation_LKR"), F.col("U")
    s = allocated.agg(F.count("*").alias("outlets"), total(x).alias("allocated"), total(F.col("Volume_Lift_Liters")).alias("lift"), F.count_if(x > 0.01).alias("active_outlets"), F.count_if(F.abs(x - u) <= F.lit(1e-8) + F.lit(1e-3) * F.abs(u)).alias("ceiling_outlets"))
    return s.withColumns({"budget": F.lit(budget), "roi": F.coalesce(ratio(F.col("lift"), F.col("allocated")), F.lit(0.0))})
