"""The monthly panel, its features, and the gold table that the frontier is fitted on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import SUM_DIGITS, number, ratio, share, total
from ..functions.text import PROVINCES, indicator_names, indicators, lookup, province

#: Fixed categories of points of interest.
CATEGORIES = {
    "bus_stop": "Transport", "bus_station": "Transport", "station": "Transport", "halt": "Transport", "school": "Education", "university": "Education", "college": "Education", "hospital": "Health",
    "clinic": "Health", "industrial": "Commercial", "marketplace": "Commercial", "restaurant": "Commercial", "cafe": "Commercial", "kitchen": "Commercial", "apartments": "Residential",
    "place_of_worship": "Social", "community_centre": "Social", "theatre": "Social", "shelter": "Social", "hotel": "Tourism", "guest_house": "Tourism", "attraction": "Tourism", "museum": "Tourism",
}
CATEGORY_NAMES = tuple(sorted({*CATEGORIES.values(), "Other"}))
OUTLET_TYPES = ("Bakery", "Eatery", "Grocery", "Hotel", "Kiosk", "Pharmacy", "SMMT")
OUTLET_SIZES = ("Extra Large", "Large", "Medium", "Small", "Unknown")
SEASONS = ("Favorable", "Moderate", "Un-Favorable")
PROVINCE_NAMES = tuple(sorted({*PROVINCES.values(), "Other", "Unknown"}))
#: The domain's categories; tables with others pass their own, or have them found.
VOCABULARIES = {"Outlet_Type": OUTLET_TYPES, "Outlet_Size": OUTLET_SIZES, "Province": PROVINCE_NAMES, "Seasonality_Index": SEASONS}
PANEL_KEYS = ("Outlet_ID", "Year", "Month", "Distributor_ID")
PROXIES = ("CV_Volume", "Flatline_Score", "Round_Number_Bias", "Price_Rigidity")


def by_outlet(rows: DataFrame) -> DataFrame:
    """``rows`` dealt by outlet once for all that follows. The number of parts is given: sums of many months take more room than their rows' bytes tell, so parts aren't to be put together."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "Outlet_ID")


def monthly_panel(transactions: DataFrame) -> DataFrame:
    """Volume and bill by outlet, year, month and distributor; rows with a missing key are left out."""
    return _monthly(transactions.dropna(subset=list(PANEL_KEYS)))


def _monthly(transactions: DataFrame, *more: str) -> DataFrame:
    return transactions.groupBy(*PANEL_KEYS, *more).agg(total(F.col("Volume_Liters")).alias("Volume_Liters"), total(F.col("Total_Bill_Value")).alias("Total_Bill_Value"))


def constraint_proxies(panel: DataFrame) -> DataFrame:
    """Per outlet: coefficient of variation of volume, share of the commonest volume, share of volumes divisible by 50, variance of the price per litre.

    An outlet with one month has 0 for all but the round share. Only the commonest volume needs two levels of aggregation.
    """
    flat = flatline(panel)
    rest = panel.groupBy("Outlet_ID").agg(*_spread())
    return rest.join(flat, "Outlet_ID").select("Outlet_ID", *PROXIES)


def _spread() -> list[Column]:
    """The proxies that one aggregation gives."""
    price = ratio(F.col("Total_Bill_Value"), F.col("Volume_Liters"))
    v = F.col("Volume_Liters")
    return [
        F.coalesce(ratio(F.stddev_samp(v), F.avg(v)), F.lit(0.0)).alias("CV_Volume"),
        share(v % 50 == 0).alias("Round_Number_Bias"),
        F.coalesce(F.var_samp(price), F.lit(0.0)).alias("Price_Rigidity"),
    ]


def proxies_at_once(panel: DataFrame) -> DataFrame:
    """``constraint_proxies`` in one aggregation, for a panel whose outlets lie together: an outlet's volumes (a row a month and distributor) are sorted to find the commonest."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, v: Column) -> Column:
        run = F.when(s["last"].eqNullSafe(v), s["run"] + 1).otherwise(F.lit(1))
        return F.struct(v.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    top = F.aggregate(F.sort_array(F.col("__v")), start, step, lambda s: s["best"])
    flat = F.when(F.col("__n") < 2, F.lit(0.0)).otherwise(top.cast("double") / F.col("__n").cast("double"))
    found = panel.groupBy("Outlet_ID").agg(*_spread(), F.count("*").alias("__n"), F.collect_list("Volume_Liters").alias("__v"))
    return found.withColumn("Flatline_Score", flat).select("Outlet_ID", *PROXIES)


def flatline(panel: DataFrame) -> DataFrame:
    """Share of the commonest volume; missing volumes count as rows but not as a volume; 0 for a single row."""
    by_value = panel.groupBy("Outlet_ID", "Volume_Liters").agg(F.count("*").alias("__n"))
    top = F.coalesce(F.max(F.when(F.col("Volume_Liters").isNotNull(), F.col("__n"))), F.lit(0))
    rows = F.sum("__n")
    return by_value.groupBy("Outlet_ID").agg(F.when(rows < 2, F.lit(0.0)).otherwise(top.cast("double") / rows.cast("double")).alias("Flatline_Score"))


def both_ways(edges: DataFrame) -> DataFrame:
    """Each edge from either end: Outlet_ID, Competitor_ID, distance, friction."""
    rest = ("Distance_Meters", "Competitive_Friction")
    there = edges.select(F.col("Source_Outlet_ID").alias("Outlet_ID"), F.col("Target_Competitor_ID").alias("Competitor_ID"), *rest)
    back = edges.select(F.col("Target_Competitor_ID").alias("Outlet_ID"), F.col("Source_Outlet_ID").alias("Competitor_ID"), *rest)
    return there.unionByName(back)


def competitor_features(edges: DataFrame) -> DataFrame:
    friction = F.col("Competitive_Friction").cast("decimal(18,4)")
    added = F.sum(friction).cast("double")
    return both_ways(edges).groupBy("Outlet_ID").agg(
        F.count("Competitor_ID").alias("Competitor_Count_5km"), F.min("Distance_Meters").alias("Min_Competitor_Distance_Meters"),
        added.alias("Total_Competitive_Friction"), (added / F.count(friction).cast("double")).alias("Average_Competitive_Friction"),
    )


def poi_category_pivot(edges: DataFrame, categories: Sequence[str] = CATEGORY_NAMES) -> DataFrame:
    """Impact of each category for each outlet, 0 where there is none. The category list is fixed, so the plan needs no job of its own."""
    cat = edges.withColumn("__cat", lookup(F.col("POI_Type"), CATEGORIES, "Other"))
    sums = [F.coalesce(F.sum(F.when(F.col("__cat") == c, F.col("Footfall_Impact_Score").cast("decimal(24,2)"))).cast("double"), F.lit(0.0)).alias(f"POI_Impact_{c}") for c in categories]
    return cat.groupBy("Outlet_ID").agg(*sums)


def poi_totals(edges: DataFrame) -> DataFrame:
    added = F.sum(F.col("Footfall_Impact_Score").cast("decimal(24,2)")).cast("double")
    mean = F.sum(F.col("Distance_Meters").cast("decimal(18,2)")).cast("double") / F.count("Distance_Meters").cast("double")
    return edges.groupBy("Outlet_ID").agg(added.alias("POI_Total_Impact_Score"), mean.alias("POI_Avg_Distance_Meters"))


def poi_features(edges: DataFrame) -> DataFrame:
    """Totals and categories of each outlet."""
    return poi_totals(edges).join(poi_category_pivot(edges), "Outlet_ID", "full_outer")


def holiday_counts(holidays: DataFrame) -> DataFrame:
    day = F.to_date("Date")
    return holidays.select(F.year(day).alias("Year"), F.month(day).alias("Month")).dropna().groupBy("Year", "Month").agg(F.count("*").alias("Holiday_Count"))


COMPETITION = ("Competitor_Count_5km", "Min_Competitor_Distance_Meters", "Total_Competitive_Friction", "Average_Competitive_Friction")
POINTS = ("POI_Total_Impact_Score", "POI_Avg_Distance_Meters", *(f"POI_Impact_{c}" for c in CATEGORY_NAMES))
POINT_COUNTS = ("POI_Count_500m", "POI_Count_1km")
MEASURES = ("Volume_Liters", "Total_Bill_Value", "Latitude", "Longitude", "ln_volume")
MOST_CATEGORIES = 1000
LEAST_SUM = 10.0**-SUM_DIGITS  # a volume that sums with others, none of which is negative, above zero


def feature_columns(impacts: bool = True, vocabularies: Mapping[str, Sequence[str]] = VOCABULARIES) -> list[str]:
    """Demand drivers of the gold table, in order, without the intercept."""
    spatial = (*COMPETITION, *POINTS) if impacts else POINT_COUNTS
    return ["Cooler_Count", *spatial, "Holiday_Count", *(n for name, values in vocabularies.items() for n in indicator_names(name, values))]


def drivers(gold: DataFrame) -> list[str]:
    """The demand drivers that a gold table has, whatever its categories."""
    return [c for c in gold.columns if c not in (*PANEL_KEYS, *MEASURES, *PROXIES)]


def vocabularies_of(df: DataFrame) -> dict[str, tuple[str, ...]]:
    """The categories that the rows have, column by column, in order; raises beyond ``MOST_CATEGORIES`` in one. The first of each is the base of its 0/1 columns."""
    out = {}
    for c in VOCABULARIES:
        found = df.select(c).where(F.col(c).isNotNull()).distinct().limit(MOST_CATEGORIES + 1).collect()  # bounded by the limit
        if len(found) > MOST_CATEGORIES:
            raise ValueError(f"{c} has more than {MOST_CATEGORIES} categories")
        out[c] = tuple(sorted(r[0] for r in found))
    return out


def check_vocabulary(df: DataFrame, vocabularies: Mapping[str, Sequence[str]] = VOCABULARIES) -> None:
    """Raises if a category isn't in the vocabularies (strict mode)."""
    row = df.agg(*[F.count_if(~F.col(c).isin(*v)).alias(c) for c, v in vocabularies.items() if c in df.columns]).first()
    if wrong := {k: v for k, v in row.asDict().items() if v}:
        raise ValueError(f"values outside the vocabularies: {wrong}")


def season_lists(season: DataFrame) -> DataFrame:
    """``__seasons`` of each distributor and month, as many as it has rows. A table that is made from a small one is taken to be small and would be sent whole to every task, hence the hint."""
    return season.groupBy("Distributor_ID", "Year", "Month").agg(F.flatten(F.collect_list(F.array("Seasonality_Index"))).alias("__seasons")).hint("shuffle_hash")


def _known(rows: DataFrame, outlet: DataFrame, holiday: DataFrame) -> DataFrame:
    """Panel rows and all that is known of their month and outlet; the wide outlets come last, so that no wide row is exchanged. They are a row an outlet: the hint keeps the many panel rows from being sorted by text."""
    gold = rows.join(holiday_counts(holiday), ["Year", "Month"], "left").join(outlet.hint("shuffle_hash"), "Outlet_ID")
    gold = gold.fillna({"Holiday_Count": 0}).withColumn("Province", province(F.col("Distributor_ID")))
    return gold.withColumn("ln_volume", F.ln("Volume_Liters")) if "Volume_Liters" in rows.columns else gold


def _with_categories(gold: DataFrame, impacts: bool, vocabularies, strict: bool, wanted: Sequence[str] | None = None) -> DataFrame:
    if vocabularies is None:
        vocabularies = vocabularies_of(gold)
    elif strict:
        check_vocabulary(gold, vocabularies)
    gold = gold.withColumns({k: c for name, values in vocabularies.items() if name in gold.columns for k, c in indicators(name, values).items()})
    told = [c for c in (*feature_columns(impacts, vocabularies), *PROXIES) if wanted is None or c in wanted]
    return gold.select(*PANEL_KEYS, *[c for c in MEASURES if c in gold.columns], *told)


def _outlets_with(outlets: DataFrame, competitors: DataFrame, points: DataFrame, *more: DataFrame) -> DataFrame:
    """Outlets and everything known of them; both tables are edges or their totals."""
    rivals = competitors if "Competitor_Count_5km" in competitors.columns else competitor_features(competitors)
    near = points if "POI_Total_Impact_Score" in points.columns else poi_features(points)
    fills = {"Competitor_Count_5km": 0, "Min_Competitor_Distance_Meters": 5000.0, "Total_Competitive_Friction": 0.0, "Average_Competitive_Friction": 0.0}
    fills |= {"POI_Total_Impact_Score": 0.0, "POI_Avg_Distance_Meters": 1000.0, **{f"POI_Impact_{c}": 0.0 for c in CATEGORY_NAMES}}
    for table in (rivals, near, *more):
        outlets = outlets.join(table, "Outlet_ID", "left")
    return outlets.fillna({k: v for k, v in fills.items() if k in outlets.columns})


def gold_features(
    transactions: DataFrame, outlets: DataFrame, competitors: DataFrame, points: DataFrame, season: DataFrame, holiday: DataFrame, vocabularies: Mapping[str, Sequence[str]] | None = VOCABULARIES, strict: bool = False,
    wanted: Sequence[str] | None = None,
) -> DataFrame:
    """Panel rows with positive volume, every feature, the four proxies, the logarithm of volume and 0/1 categories.

    ``competitors`` and ``points`` are edges, or the totals of edges by outlet (``nearby``) where there are too many to be made.
    ``vocabularies`` gives the categories of each column, the first in order being the base; None has them found in the rows, which takes a job of its own.
    ``wanted`` names the features and proxies that are told, None: all; totals need no others.
    """
    # dealt by outlet once: months, proxies and the commonest volume need no other exchange, so seasons come before
    month = ["Distributor_ID", "Year", "Month"]
    dated = by_outlet(transactions.select(*PANEL_KEYS, "Volume_Liters", "Total_Bill_Value").dropna(subset=list(PANEL_KEYS)).join(season_lists(season), month, "left"))
    panel = _monthly(dated, "__seasons")
    # everything known of an outlet is put together before the panel is touched
    proxies = wanted is None or bool({*wanted} & {*PROXIES})
    outlet = _outlets_with(outlets, competitors, points, *([proxies_at_once(panel)] if proxies else []))
    rows = panel.where("Volume_Liters > 0")
    if proxies:
        # true of every bill: it keeps the column in this branch, which then shares its exchanges with the proxies' even where nothing else reads it
        rows = rows.where(F.abs("Total_Bill_Value") >= 0)
    rows = rows.withColumn("Seasonality_Index", F.explode_outer("__seasons")).drop("__seasons")
    return _with_categories(_known(rows, outlet, holiday), True, vocabularies, strict, wanted)


def month_number() -> Column:
    """Year and Month as one number in the same order, missing ones first."""
    return F.coalesce(F.col("Year").cast("long"), F.lit(-900_000_000)) * F.lit(10_000_000_000) + F.coalesce(F.col("Month").cast("long"), F.lit(-(1 << 32)))


def newest_months(transactions: DataFrame) -> DataFrame:
    """Of each outlet's panel rows with positive volume the newest, of the smallest distributor in that month.

    Sums by distributor are made of the months that can have it: those from the outlet's last sale on where nothing was taken back then or later, else of all.
    """
    lines = by_outlet(transactions.select(*PANEL_KEYS, "Volume_Liters", "Total_Bill_Value").dropna(subset=list(PANEL_KEYS)))
    v, at = number("Volume_Liters"), month_number()
    # true of every line: it keeps the columns in this branch, which then shares its exchange with the sums'
    every = (F.octet_length("Distributor_ID") >= 0) & F.coalesce(F.abs("Total_Bill_Value") >= 0, F.lit(True))
    own = lines.groupBy("Outlet_ID").agg(F.max(F.when((v >= LEAST_SUM) & every, at)).alias("__sold"), F.max(F.when(v < 0, at)).alias("__back"))
    own = own.select(F.col("Outlet_ID").alias("__own"), F.when(F.col("__back").isNull() | (F.col("__sold") > F.col("__back")), F.col("__sold")).alias("__from"))
    # a row an outlet where its lines are already, hence the hint
    late = lines.join(own.hint("shuffle_hash"), (F.col("Outlet_ID") == F.col("__own")) & F.coalesce(at >= F.col("__from"), F.lit(True))).drop("__own", "__from")
    panel = _monthly(late).where("Volume_Liters > 0")
    order = F.struct(-F.col("Year"), -F.col("Month"), "Distributor_ID")
    return panel.groupBy("Outlet_ID").agg(F.min_by(F.struct(*[c for c in panel.columns if c != "Outlet_ID"]), order).alias("__r")).select("Outlet_ID", "__r.*")


def gold_rows(
    panel: DataFrame, outlets: DataFrame, competitors: DataFrame, points: DataFrame, season: DataFrame | None, holiday: DataFrame, vocabularies: Mapping[str, Sequence[str]], wanted: Sequence[str]
) -> DataFrame:
    """The rows of ``gold_features`` that stand for the given panel rows, of which there are few, with the features ``wanted``: those that take no whole panel, and no season where there is none."""
    # a table that is made from a small one is taken to be small, hence the hint
    rows = panel if season is None else panel.join(season.hint("shuffle_hash"), ["Distributor_ID", "Year", "Month"], "left")
    return _with_categories(_known(rows, _outlets_with(outlets, competitors, points), holiday), True, vocabularies, False, wanted)


def gold_features_legacy(
    transactions: DataFrame, outlets: DataFrame, counts: DataFrame, season: DataFrame, holiday: DataFrame, vocabularies: Mapping[str, Sequence[str]] | None = VOCABULARIES, strict: bool = False
) -> DataFrame:
    """The older table: point counts in place of decayed impact and competition; missing counts, variation and rigidity stay missing."""
    panel = monthly_panel(transactions)
    lone = panel.groupBy("Outlet_ID").agg(F.count("*").alias("__months"), F.count(ratio(F.col("Total_Bill_Value"), F.col("Volume_Liters"))).alias("__prices"))
    proxies = constraint_proxies(panel).join(lone, "Outlet_ID")
    proxies = proxies.withColumns({"CV_Volume": F.when(F.col("__months") > 1, F.col("CV_Volume")), "Price_Rigidity": F.when(F.col("__prices") > 1, F.col("Price_Rigidity"))}).drop("__months", "__prices")
    outlet = outlets.join(counts, "Outlet_ID", "left").join(proxies, "Outlet_ID", "left")
    rows = panel.where("Volume_Liters > 0").join(season, ["Distributor_ID", "Year", "Month"], "left")
    return _with_categories(_known(rows, outlet, holiday), False, vocabularies, strict)
