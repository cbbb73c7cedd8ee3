import json
import math

import numpy as np
import pytest
from demandscope.functions.numeric import log_normal_cdf
from demandscope.operators import allocation, explain, frontier, projection
from pyspark.sql import functions as F


def test_log_normal_cdf():
    assert abs(log_normal_cdf(np.array([0.0]))[0] - math.log(0.5)) < 1e-12
    low = log_normal_cdf(np.array([-29.999, -30.001, -60.0]))
    assert np.isfinite(low).all() and abs(low[0] - low[1]) < 0.1


def test_gradient_is_the_derivative():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(40, 3)), rng.normal(size=40)
    p = np.array([0.3, -0.2, 0.1, -0.4, 0.2])
    f = lambda q: frontier.value_and_gradient(x, y, q[:3], q[3], q[4])[0]
    g = frontier.value_and_gradient(x, y, p[:3], p[3], p[4])[1:6]
    for k in range(5):
        h = np.zeros(5)
        h[k] = 1e-6
        assert abs((f(p + h) - f(p - h)) / 2e-6 - g[k]) < 1e-5 * max(1, abs(g[k]))
    assert abs(f(p) - frontier.log_likelihood(y - x @ p[:3], math.exp(p[3]), math.exp(p[4])).sum()) < 1e-9


def test_fit_recovers_the_model_with_dependent_columns(spark, tmp_path):
    rng = np.random.default_rng(5)
    n = 6000
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 1.0 + 0.5 * a - 0.3 * b - np.abs(rng.normal(0, 0.8, n)) + rng.normal(0, 0.3, n)
    df = spark.createDataFrame([(float(i), float(j), float(i + j), float(k)) for i, j, k in zip(a, b, y, strict=True)], "a double, b double, both double, ln_volume double")
    model = frontier.fit(df, ["a", "b", "both"])
    assert abs(model.sigma_u - 0.8) < 0.06 and abs(model.sigma_v - 0.3) < 0.04
    at = dict(zip(model.features, model.beta, strict=True))
    assert abs(at["a"] + at["both"] - 0.5) < 0.03 and abs(at["b"] + at["both"] + 0.3) < 0.03 and abs(at["Intercept"] - 1.0) < 0.06
    start = df.agg(F.avg("ln_volume")).first()[0]
    terms = frontier.likelihood_terms(df, model).agg(F.sum("log_likelihood")).first()[0]
    assert terms > frontier.log_likelihood(y - start, 0.8, 0.3).sum()
    model.save(spark, str(tmp_path / "model"))
    assert frontier.Frontier.load(spark, str(tmp_path / "model")) == model
    with pytest.raises(ValueError):
        frontier.fit(df.limit(0), ["a"])


def _rows(spark, rows):
    return spark.createDataFrame(rows, "Outlet_ID string, a double, U double")


def _brute(rows, budget, b):
    if sum(u for _, _, u in rows) <= budget:
        return {k: u for k, _, u in rows}
    lo, hi = 1e-15, max(a for _, a, _ in rows) * b + 1
    for _ in range(200):
        lam = (lo + hi) / 2
        total = sum(min(max(a / lam - 1 / b, 0), u) for _, a, u in rows)
        lo, hi = (lam, hi) if total > budget else (lo, lam)
    return {k: min(max(a / lo - 1 / b, 0), u) for k, a, u in rows}


@pytest.mark.parametrize("budget", [0.0, 50.0, 1000.0, 50_000.0, 1e9])
def test_allocation_is_the_water_level(spark, budget):
    rng = np.random.default_rng(3)
    rows = [(f"o{i}", float(rng.integers(1, 40)), float(rng.exponential(3000)) if i % 5 else 0.0) for i in range(200)] + [("huge", 20.0, 1e25 if budget < 1e9 else 10.0)]
    got = {r.Outlet_ID: r.Trade_Spend_Allocation_LKR for r in allocation.allocate(_rows(spark, rows), budget, 0.0005).collect()}
    want = _brute(rows, budget, 0.0005)
    assert max(abs(got[k] - want[k]) for k in want) < 0.02
    assert sum(got.values()) <= budget + 1 + 0.005 * len(rows)
    inside = [a / (1 + 0.0005 * got[k]) for k, a, u in rows if 0.5 < got[k] < u - 0.5]
    assert not inside or max(inside) - min(inside) < 1e-3  # equal marginal return


def test_peaks_and_potential(spark):
    t = spark.createDataFrame([("A", 2024, 1, 5.0), ("A", 2024, 2, 9.0), ("B", 2024, 3, 7.0), ("B", 2024, 1, -1.0)], "Outlet_ID string, Year int, Month int, Volume_Liters double")
    assert {r.Outlet_ID: (r.Overall_Max, r.Jan_Max) for r in projection.historical_peaks(t).collect()} == {"A": (9.0, 5.0), "B": (7.0, 7.0)}


def test_first_per_group_skips_missing(spark):
    df = spark.createDataFrame([("A", 1, None, "x"), ("A", 2, "b", "y"), ("B", 1, None, None)], "k string, o int, v string, w string")
    assert sorted(tuple(r) for r in projection.first_per_group(df, "k", ["v", "w"], ["o"]).collect()) == [("A", "b", "x"), ("B", None, None)]


MODEL = frontier.Frontier(("poi_a", "poi_b", "Province_X", "d", "e", "f", "Intercept"), (0.5, 0.1, 0.2, -0.1, -0.5, -0.01, 1.0), 0.5, 0.2)


def _outlet(spark, volume):
    return spark.createDataFrame([("A", 2024, 1, "D", 1.0, 2.0, 0.0, 1.0, 1.0, 1.0, 3, volume), ("A", 2023, 12, "D", 9.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9, 1.0)], "Outlet_ID string, Year int, Month int, Distributor_ID string, poi_a double, poi_b double, Province_X double, d double, e double, f double, Cooler_Count int, Volume_Liters double")


def test_explanation(spark):
    told = explain.explain(_outlet(spark, 1.0), MODEL, "A", [lambda prompt: (_ for _ in ()).throw(RuntimeError("no network"))])
    p = told["payload"]
    assert [(d["feature"], d["direction"][:3]) for d in p["key_compounding_drivers"]] == [("poi a", "Pos"), ("poi b", "Pos"), ("f", "Neg"), ("d", "Neg")]
    assert p["local_environmental_signals"] == {"poi a": 1.0, "poi b": 2.0} and p["operational_constraints"] == {"Cooler Count": 3.0}
    assert "no network" in told["errors"][0] and told["narrative"].count("\n\n") == 2
    strongest = json.loads(explain.payload(explain.point_lookup(_outlet(spark, 1.0), "A"), MODEL, "strongest").first().payload)
    assert [d["feature"] for d in strongest["key_compounding_drivers"]][2:] == ["e", "d"]
    with pytest.raises(ValueError):
        explain.explain(_outlet(spark, 1.0), MODEL, "Z")


def test_explanation_above_potential(spark):
    p = json.loads(explain.payload(explain.point_lookup(_outlet(spark, 1e6), "A"), MODEL).first().payload)
    assert p["inefficiency_percentage"] == 0.0 and p["opportunity_gap_liters"] == 0.0
    old = explain.top_drivers_legacy(explain.point_lookup(_outlet(spark, 1e6), "A"), MODEL).collect()
    assert old[0].predicted_potential == 1e6 and old[0].at_peak and [r.feature_name for r in old] == ["poi_a", "poi_b"]


def test_packed_rows_are_the_rows():
    rng = np.random.default_rng(8)
    outlet, month = np.repeat(rng.normal(size=(50, 4)), 40, axis=0), rng.integers(0, 2, size=(2000, 3)).astype(float)
    for x in (np.column_stack([outlet, month, np.ones(2000)]), rng.normal(size=(300, 5)), rng.normal(size=(1, 3))):
        y, beta = rng.normal(size=len(x)), rng.normal(size=x.shape[1]) * 0.1
        p = frontier.Packed.of(x, y)
        assert (p.dense() == x).all() and np.allclose(p @ beta, x @ beta)
        assert np.allclose(frontier.value_and_gradient(p, y, beta, 0.1, -0.2), frontier.value_and_gradient(x, y, beta, 0.1, -0.2))
        assert np.allclose(p.moments()[: x.shape[1] ** 2].reshape(x.shape[1], -1), x.T @ x)
    p = frontier.Packed.of(np.column_stack([outlet, month, np.ones(2000)]), np.zeros(2000))
    assert len(p.slow) == 50 and len(p.fast) <= 8  # an outlet's columns are kept once


def test_erfc_of_arrays():
    from demandscope.functions.numeric import erfc

    x = np.concatenate([np.linspace(-26, 26, 5201), [0.46875, 4.0, -0.46875, -4.0]])
    assert np.allclose(erfc(x), [math.erfc(v) for v in x], rtol=2e-13, atol=0) and np.isnan(erfc(np.array([np.nan]))).all()
