"""Explanations: driver impacts, signals, the payload of an outlet, and the narrative."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import round_half_even
from .frontier import INTERCEPT, Frontier

#: Fixed words of feature names; the first list is tried first.
ENVIRONMENT = ("competitor", "poi", "distance", "friction", "province", "holiday")
CONSTRAINT = ("cooler", "flatline", "bias", "rigidity", "cv_")
COOLER = "Cooler_Count"
PEAK = 0.5


def signal_kind(name: str) -> str | None:
    low = name.lower()
    return "environment" if any(w in low for w in ENVIRONMENT) else "constraint" if any(w in low for w in CONSTRAINT) else None


def signal_kind_column(name: Column) -> Column:
    low = F.lower(name)
    has = lambda words: F.greatest(*[low.contains(w) for w in words])
    return F.when(has(ENVIRONMENT), "environment").when(has(CONSTRAINT), "constraint")


def performance(rows: DataFrame, model: Frontier, actual: str = "Volume_Liters") -> DataFrame:
    """Adds predicted_potential, efficiency_score, opportunity_gap and inefficiency_pct (0 where the actual is above)."""
    a, p = F.col(actual), F.col("predicted_potential")
    out = rows.withColumn("predicted_potential", model.potential()).withColumn("efficiency_score", a / p)
    return out.withColumns({"opportunity_gap": F.greatest(F.lit(0.0), p - a), "inefficiency_pct": F.when(a > p, F.lit(0.0)).otherwise((F.lit(1.0) - F.col("efficiency_score")) * 100)})


def _value(rows: DataFrame, feature: str, missing: float) -> Column:
    return F.coalesce(F.col(feature).cast("double"), F.lit(missing)) if feature in rows.columns else F.lit(missing)


def impacts(rows: DataFrame, model: Frontier, missing: float = 0.0) -> Column:
    """Array of feature, coefficient, percentage_impact, value and strength, the strongest first; a feature that isn't there has value 0."""
    parts = []
    for f, b in zip(model.features, model.beta, strict=True):
        if f == INTERCEPT:
            continue
        v, pct = _value(rows, f, missing), (F.exp(F.lit(b)) - 1.0) * 100.0
        parts.append(F.struct((-(v * pct)).alias("o"), F.lit(f).alias("feature_name"), F.lit(b).alias("coefficient"), pct.alias("percentage_impact"), v.alias("feature_value"), (v * pct).alias("local_driver_strength")))
    return F.transform(F.sort_array(F.array(*parts)), lambda x: x.dropFields("o"))


def driver_impacts(rows: DataFrame, model: Frontier, key: Sequence[str] = ("Outlet_ID",)) -> DataFrame:
    """One row a driver: key, rank, feature_name, coefficient, percentage_impact, feature_value, local_driver_strength, signal."""
    out = rows.select(*key, F.posexplode(impacts(rows, model)).alias("p", "d"))
    return out.select(*key, (F.col("p") + 1).alias("rank"), "d.*", signal_kind_column(F.col("d.feature_name")).alias("signal"))


def top_drivers_legacy(rows: DataFrame, model: Frontier, n: int = 2, actual: str = "Volume_Liters") -> DataFrame:
    """The older explanation: contribution is value times coefficient (1 for a feature that isn't there); potential is raised to the actual."""
    parts = [F.struct((-(_value(rows, f, 1.0) * b)).alias("o"), F.lit(f).alias("feature_name"), (_value(rows, f, 1.0) * b).alias("contribution")) for f, b in zip(model.features, model.beta, strict=True) if f != INTERCEPT]
    p, a = model.potential(), F.col(actual)
    out = rows.select("Outlet_ID", F.greatest(p, a).alias("predicted_potential"), F.when(a > p, F.lit(0.0)).otherwise((F.lit(1.0) - a / p) * 100).alias("inefficiency_pct"), F.posexplode(F.slice(F.sort_array(F.array(*parts)), 1, n)).alias("k", "d"))
    return out.select("Outlet_ID", "predicted_potential", "inefficiency_pct", (F.col("inefficiency_pct") <= PEAK).alias("at_peak"), (F.col("k") + 1).alias("rank"), "d.feature_name", "d.contribution")


def payload(rows: DataFrame, model: Frontier, negatives: str = "weakest", actual: str = "Volume_Liters") -> DataFrame:
    """Outlet_ID and ``payload``, a JSON text with rounded figures, key drivers and signals.

    Up to three positive drivers, then two negative ones: the weakest two (as narratives have been written so far) or the
    ``strongest``. Environmental signals of zero are left out; the cooler count is always told where the row has it.
    """
    scored = performance(rows, model, actual).withColumn("__d", impacts(rows, model))
    up = F.slice(F.filter("__d", lambda d: d["local_driver_strength"] > 0), 1, 3)
    below = F.filter("__d", lambda d: d["local_driver_strength"] < 0)
    down = F.slice(below if negatives == "weakest" else F.reverse(below), 1, 2)
    tell = lambda word, sign: lambda d: F.struct(F.replace(d["feature_name"], F.lit("_"), F.lit(" ")).alias("feature"), d["feature_value"].alias("value"), F.lit(word).alias("direction"), F.format_string(sign, d["local_driver_strength"]).alias("compounding_lift"))
    drivers = F.concat(F.transform(up, tell("Positive Impact", "+%.2f%%")), F.transform(down, tell("Negative Impact", "%.2f%%")))

    def signals(kind: str, zeros: bool):
        names = [f for f in model.features if f != INTERCEPT and signal_kind(f) == kind]
        if kind == "constraint" and COOLER in rows.columns and COOLER not in names:
            names.append(COOLER)
        pairs = [F.struct(F.lit(n.replace("_", " ")).alias("k"), round_half_even(_value(rows, n, 0.0), 4).alias("v")) for n in names]
        made = F.map_from_entries(F.array(*pairs)) if pairs else F.create_map().cast("map<string,double>")
        return made if zeros else F.map_filter(made, lambda _, v: v != 0)

    two = lambda c: round_half_even(F.col(c), 2)
    told = F.struct(
        F.col("Outlet_ID").alias("outlet_id"), two(actual).alias("historical_actual_sales_liters"), two("predicted_potential").alias("predicted_maximum_potential_liters"), two("opportunity_gap").alias("opportunity_gap_liters"),
        two("efficiency_score").alias("technical_efficiency_score"), two("inefficiency_pct").alias("inefficiency_percentage"), drivers.alias("key_compounding_drivers"),
        signals("environment", False).alias("local_environmental_signals"), signals("constraint", True).alias("operational_constraints"),
    )
    return scored.select("Outlet_ID", F.to_json(told).alias("payload"))


def point_lookup(gold: DataFrame, outlet_id: str) -> DataFrame:
    """The newest row of one outlet; the filter reaches the scan. Raises if there is none."""
    rows = gold.where(F.col("Outlet_ID") == outlet_id).withColumn("__k", F.row_number().over(Window.orderBy(F.desc("Year"), F.desc("Month"), "Distributor_ID"))).where("__k = 1").drop("__k")
    if rows.isEmpty():
        raise ValueError(f"Outlet ID {outlet_id} not found")
    return rows


def narrative_prompt(payload_json: str) -> str:
    return "Explain this outlet's sales potential in three paragraphs: its ceiling against its actual sales, what lifts it, and what holds it back with one action. Use only these figures.\n" + json.dumps(json.loads(payload_json), indent=2)


def template_narrative(prompt: str) -> str:
    """Offline narrative: the same three parts from the payload alone."""
    p = json.loads(prompt[prompt.index("{") :])
    up = [d["feature"] for d in p["key_compounding_drivers"] if d["direction"].startswith("Pos")]
    gap = f"an opportunity of {p['opportunity_gap_liters']:,.2f} liters" if p["opportunity_gap_liters"] > 0 else "already above what comparable outlets reach"
    limits = ", ".join(f"{k} {v:g}" for k, v in p["operational_constraints"].items()) or "no recorded constraint"
    return f"Outlet {p['outlet_id']} sells {p['historical_actual_sales_liters']:,.2f} liters against a potential of {p['predicted_maximum_potential_liters']:,.2f}: {gap}.\n\nIts demand is lifted by {', '.join(up) or 'no single factor'}.\n\nOperations show {limits}; support there is the first use of the budget."


def explain(gold: DataFrame, model: Frontier, outlet_id: str, providers: Sequence[Callable[[str], str]] = ()) -> dict:
    """Payload and narrative of one outlet. ``providers`` are tried in turn on the driver; the template is the last."""
    told = payload(point_lookup(gold, outlet_id), model).first().payload
    prompt, errors = narrative_prompt(told), []
    for ask in (*providers, template_narrative):
        try:
            return {"outlet_id": outlet_id, "payload": json.loads(told), "narrative": ask(prompt), "errors": errors}
        except Exception as e:  # noqa: BLE001  a provider can fail in any way; the next one is asked and the failure is told
            errors.append(f"{getattr(ask, '__name__', ask)}: {e}")
    raise RuntimeError("; ".join(errors))
