"""The same queries in DuckDB SQL, written apart from the Spark plans: theta joins, window functions and plain sorting.

Word lists, tables, features and the model's parameters stand here a second time, so that a wrong one in the library shows as a difference.
"""

from __future__ import annotations

import math

#: Fixed values of the domain and of the test tables.
PROVINCES = {"W": "Western", "C": "Central", "S": "Southern", "NW": "North Western", "E": "Eastern", "NC": "North Central", "U": "Uva", "SG": "Sabaragamuwa", "N": "Northern"}
CATEGORIES = {
    "bus_stop": "Transport", "bus_station": "Transport", "station": "Transport", "halt": "Transport", "school": "Education", "university": "Education", "college": "Education", "hospital": "Health",
    "clinic": "Health", "industrial": "Commercial", "marketplace": "Commercial", "restaurant": "Commercial", "cafe": "Commercial", "kitchen": "Commercial", "apartments": "Residential",
    "place_of_worship": "Social", "community_centre": "Social", "theatre": "Social", "shelter": "Social", "hotel": "Tourism", "guest_house": "Tourism", "attraction": "Tourism", "museum": "Tourism",
}
CATEGORY_NAMES = ("Commercial", "Education", "Health", "Other", "Residential", "Social", "Tourism", "Transport")
FOOTFALL = {
    "station": 25000.0, "bus_station": 10000.0, "hospital": 5000.0, "university": 4000.0, "marketplace": 3000.0, "college": 2000.0, "school": 1000.0,
    "apartments": 500.0, "place_of_worship": 300.0, "clinic": 200.0, "bus_stop": 150.0, "hotel": 100.0, "guest_house": 50.0, "industrial": 1000.0,
}
CODES = ("W", "C", "S", "NW", "E", "NC", "U", "SG", "N", "X")
POI_TYPES = ("bus_stop", "school", "hospital", "hotel", "place_of_worship", "marketplace", "station", "clinic", "university", "apartments", "guest_house", "industrial", "restaurant", "museum", "college", "bus_station", "unknown")
SEASONS = ("Favorable", "Moderate", "Un-Favorable")
#: 0/1 columns: each column's categories in order, without the first.
HOT = {
    "Outlet_Type": ("Bakery", "Building", "Furniture", "Grocery", "Household", "Machinery"), "Outlet_Size": ("Large", "Medium", "Small", "Unknown"),
    "Province": ("Eastern", "North Central", "North Western", "Northern", "Other", "Sabaragamuwa", "Southern", "Unknown", "Uva", "Western"), "Seasonality_Index": ("Moderate", "Un-Favorable"),
}
COMPETITION = ("Competitor_Count_5km", "Min_Competitor_Distance_Meters", "Total_Competitive_Friction", "Average_Competitive_Friction")
BETA = {
    "Cooler_Count": 0.05, "Competitor_Count_5km": -0.0001, "POI_Total_Impact_Score": 0.000002, "Holiday_Count": 0.01, "Outlet_Size_Large": 0.2, "Seasonality_Index_Moderate": -0.1, "Province_Western": 0.15, "Intercept": 3.0,
}
SIGMA_U, SIGMA_V = 0.6, 0.4
BUDGET, DENSITY = 20_000.0, 10.0
GOLD_ROUND = {"ln_volume": 6, "CV_Volume": 6, "Price_Rigidity": 2, "Flatline_Score": 10, "Round_Number_Bias": 10}


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _map(values: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': {repr(v) if not isinstance(v, str) else chr(39) + v + chr(39)}" for k, v in values.items()) + "}"


def _prov(c: str) -> str:
    return f"CASE WHEN len(string_split({c}, '_')) > 1 THEN coalesce(({_map(PROVINCES)})[string_split({c}, '_')[2]], 'Other') ELSE 'Unknown' END"


def _half_even(e: str, digits: int) -> str:
    return f"(round_even(({e}) * {10.0**digits}, 0) / {10.0**digits})"


def _money(c: str) -> str:
    return f"round({_exact(c)}, 2)"


def _exact(c: str) -> str:
    return f"coalesce(round(sum({c}), 6), 0.0)"


_LAT = "6.5::DOUBLE + ((({k}) * 7919) % 8009)::DOUBLE / 10000.0::DOUBLE"
_LON = "79.85::DOUBLE + ((({k}) * ({k}) * 31 + ({k}) * 104729) % 7001)::DOUBLE / 10000.0::DOUBLE"
_AT = "CASE WHEN c_custkey % 47 = 0 THEN c_custkey - 1 ELSE c_custkey END"
_INSIDE = "{a} BETWEEN 5.9 AND 9.9 AND {b} BETWEEN 79.6 AND 81.9"

_n = (1 / 298.257223563) / (2 - 1 / 298.257223563)
_radius = 0.9996 * 6378137.0 / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_a = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240)
_e = 2 * math.sqrt(_n) / (1 + _n)
_X = " + ".join(["eta"] + [f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(_a, 1)])
_Y = " + ".join(["xi"] + [f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(_a, 1)])


def _projected(source: str, keep: str) -> str:
    return f"""SELECT {keep}, 500000.0 + {_radius!r} * ({_X}) AS x, {_radius!r} * ({_Y}) AS y FROM (
      SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM (
        SELECT *, radians(Longitude - 81.0) AS dl, sinh(atanh(sin(radians(Latitude))) - {_e!r} * atanh({_e!r} * sin(radians(Latitude)))) AS t
        FROM {source} WHERE Latitude IS NOT NULL AND Longitude IS NOT NULL))"""


_FILL = {"Competitor_Count_5km": "0", "Min_Competitor_Distance_Meters": "5000.0", "Total_Competitive_Friction": "0.0", "Average_Competitive_Friction": "0.0", "Holiday_Count": "0", "POI_Total_Impact_Score": "0.0", "POI_Avg_Distance_Meters": "1000.0"} | {
    f"POI_Impact_{c}": "0.0" for c in CATEGORY_NAMES
}


def _gold(impacts: bool) -> str:
    spatial = [*COMPETITION, "POI_Total_Impact_Score", "POI_Avg_Distance_Meters", *(f"POI_Impact_{c}" for c in CATEGORY_NAMES)] if impacts else ["POI_Count_500m", "POI_Count_1km"]
    cols = [f"coalesce({f}, {_FILL[f]}) AS {f}" if f in _FILL else f for f in ("Cooler_Count", *spatial, "Holiday_Count")]
    cols += [f"coalesce(({name} = '{v}')::INT, 0) AS \"{name}_{v}\"" for name, values in HOT.items() for v in values]
    cv, rigid = ("CV_Volume", "Price_Rigidity") if impacts else ("CASE WHEN months > 1 THEN CV_Volume END AS CV_Volume", "CASE WHEN prices > 1 THEN Price_Rigidity END AS Price_Rigidity")
    return f"""SELECT p.Outlet_ID, p.Year, p.Month, p.Distributor_ID, Volume_Liters, Total_Bill_Value, Latitude, Longitude, ln(Volume_Liters) AS ln_volume,
      {', '.join(cols)}, {cv}, Flatline_Score, Round_Number_Bias, {rigid}
    FROM (SELECT *, {_prov('Distributor_ID')} AS Province FROM panel WHERE Volume_Liters > 0) p JOIN dims d ON p.Outlet_ID = d.Outlet_ID LEFT JOIN compf c ON c.Outlet_ID = p.Outlet_ID
    LEFT JOIN {'poif' if impacts else 'poic'} f ON f.Outlet_ID = p.Outlet_ID LEFT JOIN proxies x ON x.Outlet_ID = p.Outlet_ID
    LEFT JOIN seasons s ON s.Distributor_ID = p.Distributor_ID AND s.Year = p.Year AND s.Month = p.Month LEFT JOIN holi h ON h.Year = p.Year AND h.Month = p.Month"""


_XB = " + ".join(str(b) if f == "Intercept" else f'"{f}"::DOUBLE * ({b!r}::DOUBLE)' for f, b in BETA.items())
_POT = f"exp({_XB}) * {math.exp(0.5 * SIGMA_V**2)!r}::DOUBLE"
_EFFECTS = [(f, b) for f, b in BETA.items() if f != "Intercept"]

PARTS = {
    "dist": f"SELECT s_suppkey, 'DIST_' || ({_list(CODES)})[(s_nationkey % 10) + 1] || '_' || lpad(s_suppkey::VARCHAR, 7, '0') AS Distributor_ID FROM supplier",
    "trans": "SELECT 'OUT_' || lpad(o_custkey::VARCHAR, 7, '0') AS Outlet_ID, year(o_orderdate)::INT AS Year, month(o_orderdate)::INT AS Month, Distributor_ID, 'SKU_' || l_partkey::VARCHAR AS SKU_ID, l_quantity AS Volume_Liters, l_extendedprice AS Total_Bill_Value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN dist ON l_suppkey = s_suppkey",
    "dirty1": "SELECT * REPLACE (CASE WHEN substr(Outlet_ID, 5, 7)::INT % 29 = 0 THEN 'BAD_' || substr(Outlet_ID, 5, 7) ELSE Outlet_ID END AS Outlet_ID) FROM trans",
    "dirty": "SELECT * FROM dirty1 UNION ALL SELECT * FROM dirty1 WHERE substr(SKU_ID, 5)::INT % 53 = 0",
    "master": "SELECT 'OUT_' || lpad(c_custkey::VARCHAR, 7, '0') AS Outlet_ID, ([NULL, 'small', ' Medium', 'LARGE', 'extra large', 'Small', 'Large '])[(c_custkey % 7) + 1] AS Outlet_Size, (c_custkey % 6)::INT AS Cooler_Count, CASE WHEN c_custkey % 11 = 0 THEN 'Grocry' WHEN c_custkey % 13 = 0 THEN ' Bakry ' ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS Outlet_Type FROM customer",
    "coords0": f"SELECT c_custkey, {_LAT.format(k='(' + _AT + ')')} AS la, {_LON.format(k='(' + _AT + ')')} AS lo FROM customer",
    "coords": "SELECT 'OUT_' || lpad(c_custkey::VARCHAR, 7, '0') AS Outlet_ID, CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN lo WHEN c_custkey % 43 = 0 THEN 0.0 ELSE la END AS Latitude, CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 41 = 0 THEN la WHEN c_custkey % 43 = 0 THEN 0.0 ELSE lo END AS Longitude FROM coords0",
    "marked0": f"SELECT m.*, Latitude AS la, Longitude AS lo, Latitude IS NULL OR Longitude IS NULL AS missing, {_INSIDE.format(a='Latitude', b='Longitude')} AS ok, {_INSIDE.format(a='Longitude', b='Latitude')} AS swapped FROM master m LEFT JOIN coords c ON c.Outlet_ID = m.Outlet_ID",
    "marked1": "SELECT Outlet_ID, Outlet_Size, Cooler_Count, Outlet_Type, CASE WHEN NOT missing AND NOT ok AND swapped THEN lo ELSE la END AS Latitude, CASE WHEN NOT missing AND NOT ok AND swapped THEN la ELSE lo END AS Longitude, CASE WHEN missing THEN 'Missing GPS Coordinates' WHEN NOT ok AND NOT swapped THEN 'Coordinates Outside Sri Lanka Bounds' END AS r FROM marked0",
    "marked": "SELECT * EXCLUDE r, coalesce(r, CASE WHEN row_number() OVER (PARTITION BY r IS NULL, Latitude, Longitude ORDER BY Outlet_ID) > 1 THEN 'Duplicate GPS Location' END) AS failure_reason FROM marked1",
    "tidy": "SELECT Outlet_ID, CASE trim(Outlet_Type) WHEN 'Grocry' THEN 'Grocery' WHEN 'Bakry' THEN 'Bakery' ELSE trim(Outlet_Type) END AS Outlet_Type, coalesce(array_to_string(list_transform(string_split(trim(Outlet_Size), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' '), 'Unknown') AS Outlet_Size FROM master",
    "dims": "SELECT Outlet_ID, t.Outlet_Size, Cooler_Count, t.Outlet_Type, Latitude, Longitude FROM marked m JOIN tidy t USING (Outlet_ID) WHERE failure_reason IS NULL",
    "outxy": _projected("dims", "Outlet_ID"),
    "pois": f"SELECT 'POI_' || lpad(p_partkey::VARCHAR, 6, '0') AS POI_ID, ({_list(POI_TYPES)})[(p_partkey % {len(POI_TYPES)}) + 1] AS POI_Type, 6.5::DOUBLE + ((p_partkey * 6101 + 17) % 8011)::DOUBLE / 10000.0::DOUBLE AS Latitude, 79.85::DOUBLE + ((p_partkey * p_partkey * 37 + p_partkey * 15485) % 7013)::DOUBLE / 10000.0::DOUBLE AS Longitude FROM part",
    "poixy": _projected("pois", "POI_ID, POI_Type"),
    "comp": f"SELECT s, t, {_half_even('d', 2)} AS Distance_Meters, {_half_even('exp(-(d * d) / 2000000.0)', 4)} AS Competitive_Friction FROM (SELECT a.Outlet_ID AS s, b.Outlet_ID AS t, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS d FROM outxy a JOIN outxy b ON a.Outlet_ID < b.Outlet_ID AND abs(a.x - b.x) <= 5000.0 AND abs(a.y - b.y) <= 5000.0) WHERE d <= 5000.0",
    "compf": "SELECT Outlet_ID, count(*) AS Competitor_Count_5km, min(Distance_Meters) AS Min_Competitor_Distance_Meters, sum(Competitive_Friction::DECIMAL(18,4))::DOUBLE AS Total_Competitive_Friction, sum(Competitive_Friction::DECIMAL(18,4))::DOUBLE / count(*)::DOUBLE AS Average_Competitive_Friction FROM (SELECT s AS Outlet_ID, * FROM comp UNION ALL SELECT t AS Outlet_ID, * FROM comp) GROUP BY Outlet_ID",
    "near": f"SELECT Outlet_ID, POI_ID, POI_Type, coalesce(({_map(FOOTFALL)})[POI_Type], 100.0)::DOUBLE AS Base_Footfall, d FROM (SELECT o.Outlet_ID, p.POI_ID, p.POI_Type, sqrt((p.x - o.x) * (p.x - o.x) + (p.y - o.y) * (p.y - o.y)) AS d FROM outxy o JOIN poixy p ON abs(p.x - o.x) <= 3000.0 AND abs(p.y - o.y) <= 3000.0) WHERE d <= 3000.0",
    "poie": f"SELECT n.Outlet_ID, POI_ID, POI_Type, {_half_even('d', 2)} AS Distance_Meters, Base_Footfall, {_half_even('m', 2)} AS Regional_Multiplier, {_half_even('exp(-(d * d) / 180000.0)', 4)} AS Decay_Weight, {_half_even('Base_Footfall * m * exp(-(d * d) / 180000.0)', 2)} AS Footfall_Impact_Score FROM near n JOIN (SELECT Outlet_ID, least(greatest(count(*)::DOUBLE / {DENSITY}::DOUBLE, 0.2), 2.0) AS m FROM near GROUP BY 1) c ON c.Outlet_ID = n.Outlet_ID WHERE d <= 1000.0",
    "poic": "SELECT Outlet_ID, count(*) FILTER (WHERE d <= 500.0) AS POI_Count_500m, count(*) AS POI_Count_1km FROM near WHERE d <= 1000.0 GROUP BY Outlet_ID",
    "poip": "SELECT Outlet_ID, " + ", ".join(f"coalesce(sum(Footfall_Impact_Score::DECIMAL(24,2)) FILTER (WHERE cat = '{c}')::DOUBLE, 0.0) AS POI_Impact_{c}" for c in CATEGORY_NAMES) + f" FROM (SELECT *, coalesce(({_map(CATEGORIES)})[POI_Type], 'Other') AS cat FROM poie) GROUP BY Outlet_ID",
    "poif": "SELECT a.*, p.* EXCLUDE Outlet_ID FROM (SELECT Outlet_ID, sum(Footfall_Impact_Score::DECIMAL(24,2))::DOUBLE AS POI_Total_Impact_Score, sum(Distance_Meters::DECIMAL(18,2))::DOUBLE / count(*)::DOUBLE AS POI_Avg_Distance_Meters FROM poie GROUP BY Outlet_ID) a JOIN poip p ON p.Outlet_ID = a.Outlet_ID",
    "holidays": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m-%d') AS Date FROM orders WHERE ((date_diff('day', DATE '2000-01-21', o_orderdate::DATE) * 1000000) % 29530589 + 29530589) % 29530589 < 1000000",
    "holi": "SELECT year(Date::DATE)::INT AS Year, month(Date::DATE)::INT AS Month, count(*) AS Holiday_Count FROM holidays GROUP BY 1, 2",
    "seasons": f"SELECT Distributor_ID, y::INT AS Year, m::INT AS Month, ({_list(SEASONS)})[((s_suppkey + m) % 3) + 1] AS Seasonality_Index FROM dist, (SELECT unnest(range(min(year(o_orderdate)), max(year(o_orderdate)) + 1)) AS y FROM orders) a, range(1, 13) b(m)",
    "panel": f"SELECT Outlet_ID, Year, Month, Distributor_ID, {_exact('Volume_Liters')} AS Volume_Liters, {_exact('Total_Bill_Value')} AS Total_Bill_Value FROM trans GROUP BY ALL",
    "flat": "SELECT Outlet_ID, CASE WHEN sum(n) < 2 THEN 0.0::DOUBLE ELSE max(n)::DOUBLE / sum(n)::DOUBLE END AS Flatline_Score FROM (SELECT Outlet_ID, Volume_Liters, count(*) AS n FROM panel GROUP BY 1, 2) GROUP BY 1",
    "proxies": "SELECT Outlet_ID, coalesce(stddev_samp(Volume_Liters) / nullif(avg(Volume_Liters), 0), 0.0) AS CV_Volume, Flatline_Score, avg(CASE WHEN Volume_Liters % 50 = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS Round_Number_Bias, coalesce(var_samp(Total_Bill_Value / nullif(Volume_Liters, 0)), 0.0) AS Price_Rigidity, count(*) AS months, count(Total_Bill_Value / nullif(Volume_Liters, 0)) AS prices FROM panel JOIN flat USING (Outlet_ID) GROUP BY Outlet_ID, Flatline_Score",
    "gold": _gold(True),
    "goldl": _gold(False),
    "months": f"SELECT Outlet_ID, Year, Month, {_exact('Volume_Liters')} AS v FROM trans WHERE Volume_Liters > 0 GROUP BY ALL",
    "peaks": "SELECT Outlet_ID, max(v) AS Overall_Max, coalesce(max(v) FILTER (WHERE Month = 1), max(v)) AS Jan_Max FROM months GROUP BY Outlet_ID",
    "pot": "SELECT Outlet_ID, round(g, 4) AS Group_Frontier, Jan_Max, Overall_Max, greatest(" + _half_even(f"greatest(g, Jan_Max) * {math.exp(SIGMA_U * math.sqrt(2 / math.pi))!r}::DOUBLE", 2) + ", 0.01) AS Maximum_Monthly_Liters FROM (SELECT Outlet_ID, " + _POT.replace('"Holiday_Count"::DOUBLE', "11.3::DOUBLE").replace('"Seasonality_Index_Moderate"', "coalesce((si = 'Moderate')::INT, 0)") + " AS g FROM (SELECT g.*, si FROM (SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY Outlet_ID ORDER BY Year, Month, Distributor_ID) = 1) g LEFT JOIN (SELECT Outlet_ID, arg_min(Distributor_ID, (Year, Month, Distributor_ID)) AS fd FROM trans GROUP BY 1) t USING (Outlet_ID) LEFT JOIN (SELECT Distributor_ID AS fd, arg_min(Seasonality_Index, Year) AS si FROM seasons WHERE Month = 1 GROUP BY 1) s USING (fd))) LEFT JOIN peaks USING (Outlet_ID)",
    "pred": "SELECT Outlet_ID, Maximum_Monthly_Liters FROM pot",
    "wp": "SELECT * FROM trans WHERE contains(Distributor_ID, '_W_')",
    "wpm": f"SELECT Outlet_ID, Year, Month, {_exact('Volume_Liters')} AS v FROM wp GROUP BY ALL",
    "base": "SELECT Outlet_ID, coalesce(round(sum(v) FILTER (WHERE Month = 1), 6) / nullif((count(v) FILTER (WHERE Month = 1))::DOUBLE, 0), round(sum(v), 6) / count(v)::DOUBLE, 0.0) AS Y_historical FROM wpm GROUP BY Outlet_ID",
    "own": f"SELECT Outlet_ID, {_exact('Total_Bill_Value')} AS bill, {_exact('Volume_Liters')} AS vol FROM wp GROUP BY Outlet_ID",
    "price": "SELECT Outlet_ID, coalesce(bill / nullif(vol, 0), (SELECT round(sum(bill), 6) / round(sum(vol), 6) FROM own)) AS Price_Per_Liter FROM own",
    "prob0": "SELECT Outlet_ID, Y_historical, Price_Per_Liter, coalesce(Maximum_Monthly_Liters, Y_historical) AS Y_frontier FROM base JOIN price USING (Outlet_ID) LEFT JOIN pred USING (Outlet_ID)",
    "prob": "SELECT *, (exp(least(Headroom / a, 50.0)) - 1.0) / 0.0005::DOUBLE AS U FROM (SELECT *, greatest(Y_frontier - Y_historical, 0.0) AS Headroom, greatest(Y_historical, 1.0) AS a FROM prob0)",
    "ev": "SELECT 1.0 / (a * 0.0005::DOUBLE) AS mu, a AS slope, -2000.0::DOUBLE AS shift FROM prob WHERE U > 0 UNION ALL SELECT (U + 2000.0::DOUBLE) / a, -a, U + 2000.0::DOUBLE FROM prob WHERE U > 0",
    "sweep": "SELECT mu, sum(slope) OVER o AS s, sum(shift) OVER o AS i FROM ev WINDOW o AS (ORDER BY mu)",
    "level": f"SELECT CASE WHEN (SELECT sum(U) FROM prob) > {BUDGET} THEN ({BUDGET} - i) / s END AS mu FROM sweep WHERE s * mu + i <= {BUDGET} ORDER BY sweep.mu DESC LIMIT 1",
    "alloc": f"SELECT *, {_half_even('a * ln(1.0 + 0.0005::DOUBLE * Trade_Spend_Allocation_LKR)', 2)} AS Volume_Lift_Liters FROM (SELECT p.*, {_half_even('CASE WHEN l.mu IS NULL THEN U ELSE least(greatest(a * l.mu - 2000.0, 0.0), U) END', 2)} AS Trade_Spend_Allocation_LKR FROM prob p, level l)",
    "firstd": "SELECT Outlet_ID, arg_min(Distributor_ID, (Year, Month, Distributor_ID)) AS Distributor_ID FROM wp GROUP BY Outlet_ID",
    "summ": "SELECT a.*, t.Outlet_Size, t.Outlet_Type, f.Distributor_ID FROM alloc a LEFT JOIN tidy t USING (Outlet_ID) LEFT JOIN firstd f USING (Outlet_ID)",
    "hist": "SELECT Outlet_ID, max(v) AS hist_max, round(sum(v), 6) / count(v)::DOUBLE AS hist_mean FROM months GROUP BY Outlet_ID",
    "rat": "SELECT p.*, hist_max, hist_mean, Maximum_Monthly_Liters / nullif(hist_max, 0) AS ratio_to_max, Maximum_Monthly_Liters / nullif(hist_mean, 0) AS ratio_to_mean, CASE WHEN Maximum_Monthly_Liters < hist_max THEN Maximum_Monthly_Liters / nullif(hist_max, 0) END AS ratio_under_max FROM pred p JOIN hist USING (Outlet_ID)",
    "scored": f"SELECT *, {_POT} AS Potential_Volume, Volume_Liters / ({_POT}) AS Efficiency_Score FROM gold",
    "rep": "SELECT Outlet_ID, avg(Volume_Liters) AS Avg_Monthly_Volume, avg(Potential_Volume) AS Potential_Volume, avg(Efficiency_Score) AS Efficiency_Score, avg(CV_Volume) AS CV_Volume, avg(Flatline_Score) AS Flatline_Score, avg(Round_Number_Bias) AS Round_Number_Bias, avg(Price_Rigidity) AS Price_Rigidity FROM scored GROUP BY Outlet_ID",
    "lastg": "SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY Outlet_ID ORDER BY Year DESC, Month DESC, Distributor_ID) = 1",
    "perf": f"SELECT *, {_POT} AS p, Volume_Liters AS a FROM lastg",
    "fx": "SELECT Outlet_ID, f.n AS feature_name, f.b AS coefficient, (exp(f.b) - 1.0) * 100.0 AS percentage_impact, f.v AS feature_value, f.v * ((exp(f.b) - 1.0) * 100.0) AS strength FROM (SELECT Outlet_ID, unnest([" + ", ".join(f"{{'n': '{f}', 'b': {b!r}::DOUBLE, 'v': \"{f}\"::DOUBLE}}" for f, b in _EFFECTS) + "]) AS f FROM lastg)",
    "fxr": "SELECT *, row_number() OVER (PARTITION BY Outlet_ID ORDER BY strength DESC, feature_name) AS rank, CASE WHEN regexp_matches(lower(feature_name), 'competitor|poi|distance|friction|province|holiday') THEN 'environment' WHEN regexp_matches(lower(feature_name), 'cooler|flatline|bias|rigidity|cv_') THEN 'constraint' END AS signal FROM fx",
    "kept0": "SELECT *, row_number() OVER (PARTITION BY Outlet_ID, Year, Month, Distributor_ID, SKU_ID, Volume_Liters, Total_Bill_Value) AS nth FROM dirty",
    "tm": "SELECT *, CASE WHEN nth > 1 THEN 'Duplicate Transaction' WHEN Outlet_ID NOT IN (SELECT Outlet_ID FROM master) THEN 'Invalid Outlet_ID' END AS failure_reason FROM kept0",
    "tmd": "SELECT *, CASE WHEN nth > 1 THEN 'Duplicate Transaction' WHEN Outlet_ID NOT IN (SELECT Outlet_ID FROM dims) THEN 'Invalid Outlet_ID' END AS failure_reason FROM kept0",
    "tk": "SELECT * EXCLUDE (nth, failure_reason) FROM tmd WHERE failure_reason IS NULL",
}
_KEYS = "Outlet_ID, Year, Month, Distributor_ID, SKU_ID, Volume_Liters, Total_Bill_Value"


def _checks(rows: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS check_name, issues::BIGINT AS issues, CASE WHEN issues = 0 THEN 'OK' ELSE 'FAIL' END AS status FROM ({q}) q(issues)" for n, q in rows)


def _spend(column: str) -> str:
    return f"SELECT {column}, count(*) AS outlets, count(*) FILTER (WHERE Trade_Spend_Allocation_LKR > 0.01) AS active_outlets, {_exact('Trade_Spend_Allocation_LKR')} AS total_spend, {_exact('Volume_Lift_Liters')} AS total_lift, round(coalesce({_exact('Trade_Spend_Allocation_LKR')} / nullif((SELECT {_exact('Trade_Spend_Allocation_LKR')} FROM alloc), 0) * 100, 0.0), 6) AS spend_share, round(coalesce({_exact('Volume_Lift_Liters')} / nullif({_exact('Trade_Spend_Allocation_LKR')}, 0), 0.0), 6) AS roi FROM summ WHERE {column} IS NOT NULL GROUP BY {column}"


def _describe(source: str, columns: list[str], digits: int, skew: bool = False) -> str:
    def one(c):
        q = ", ".join(f"round(quantile_cont(v, {p}), {digits}) AS p{round(p * 100):02d}" for p in (0.05, 0.25, 0.5, 0.75, 0.95))
        more = f", round(skewness(v), {digits}) AS skew" if skew else ""
        return f"SELECT '{c}' AS measure, count(v) AS n, round(avg(v), {digits}) AS mean, round(stddev_samp(v), {digits}) AS std, round(min(v), {digits}) AS min, {q}, round(max(v), {digits}) AS max{more} FROM (SELECT {c}::DOUBLE AS v FROM {source}) HAVING count(v) > 0"

    return " UNION ALL ".join(one(c) for c in columns)


_PROXY = "SELECT Outlet_ID, round({c}, {d}) AS {c} FROM proxies"
_GOLD_OUT = "SELECT * REPLACE (" + ", ".join(f"round({c}, {n}) AS {c}" for c, n in GOLD_ROUND.items()) + "{more}) FROM {t}"
_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_ODD = "substr(Outlet_ID, 5, 7)::INT"

_S = math.hypot(SIGMA_U, SIGMA_V)
#: Logarithm of the normal distribution function at w: by its series, and by its continued fraction in the lower tail.
_SERIES = "list_reduce(list_prepend(1.0::DOUBLE, list_transform(range(120, 0, -1), lambda k: k::DOUBLE)), lambda acc, k: 1.0 + acc * w * w / (2.0 * k + 1.0))"
_FRACTION = "list_reduce(list_prepend(-w, list_transform(range(80, 0, -1), lambda k: k::DOUBLE)), lambda acc, k: k / acc - w)"
_LOG_CDF = f"CASE WHEN w > -4 THEN ln(0.5 + exp(-0.5 * w * w) / {math.sqrt(2 * math.pi)!r} * w * {_SERIES}) ELSE -0.5 * w * w - {0.5 * math.log(2 * math.pi)!r} - ln({_FRACTION}) END"
_WORDS = "'competitor|poi|distance|friction|province|holiday'"
_SIGNALS = {k: [f for f, _ in _EFFECTS if any(w in f.lower() for w in words)] for k, words in (("local_environmental_signals", ("competitor", "poi", "distance", "friction", "province", "holiday")), ("operational_constraints", ("cooler",)))}
_ENV = "[" + ", ".join(f'{_half_even(chr(34) + f + chr(34) + "::DOUBLE", 4)}' for f in _SIGNALS["local_environmental_signals"]) + "]"

QUERIES = {
    "sfa_loglik_terms": f"SELECT Outlet_ID, Year, Month, Distributor_ID, round(e, 6) AS residual, round({math.log(2 / _S) - 0.5 * math.log(2 * math.pi)!r} - 0.5 * z * z + {_LOG_CDF}, 6) AS log_likelihood FROM (SELECT *, e / {_S!r} AS z, -(e / {_S!r}) * {SIGMA_U / SIGMA_V!r} AS w FROM (SELECT *, ln_volume - ({_XB}) AS e FROM gold))",
    "explanation_payload": f"""SELECT Outlet_ID, {_half_even('a', 2)} AS historical_actual_sales_liters, {_half_even('p', 2)} AS predicted_maximum_potential_liters, {_half_even('greatest(0.0, p - a)', 2)} AS opportunity_gap_liters,
      {_half_even('a / p', 2)} AS technical_efficiency_score, {_half_even('CASE WHEN a > p THEN 0.0 ELSE (1.0 - a / p) * 100 END', 2)} AS inefficiency_percentage, coalesce(drivers, '') AS drivers,
      len(list_filter(env, lambda v: v <> 0))::INT AS n_local_environmental_signals, round(coalesce(list_sum(env), 0.0), 3) AS local_environmental_signals, 1 AS n_operational_constraints, round({_half_even('"Cooler_Count"::DOUBLE', 4)}, 3) AS operational_constraints
    FROM (SELECT *, {_ENV} AS env FROM perf) LEFT JOIN (
      SELECT Outlet_ID, string_agg(replace(feature_name, '_', ' ') || '|' || CASE WHEN strength > 0 THEN 'Positive Impact|+' ELSE 'Negative Impact|' END || printf('%.2f%%', strength), ';' ORDER BY strength < 0, k) AS drivers
      FROM (SELECT *, row_number() OVER (PARTITION BY Outlet_ID, strength > 0 ORDER BY rank) AS k FROM fxr WHERE strength <> 0) WHERE k <= CASE WHEN strength > 0 THEN 3 ELSE 2 END GROUP BY Outlet_ID) USING (Outlet_ID)""",
    "monthly_panel": "SELECT * FROM panel",
    "constraint_proxies": "SELECT Outlet_ID, round(CV_Volume, 6) AS CV_Volume, round(Flatline_Score, 10) AS Flatline_Score, round(Round_Number_Bias, 10) AS Round_Number_Bias, round(Price_Rigidity, 2) AS Price_Rigidity FROM proxies",
    "proxy_flatline": _PROXY.format(c="Flatline_Score", d=10), "proxy_cv": _PROXY.format(c="CV_Volume", d=6), "proxy_round_bias": _PROXY.format(c="Round_Number_Bias", d=10), "proxy_price_rigidity": _PROXY.format(c="Price_Rigidity", d=2),
    "holiday_counts": "SELECT * FROM holi",
    "province_lookup": f"SELECT Distributor_ID, {_prov('Distributor_ID')} AS Province FROM dist",
    "clean_outlets_kept": "SELECT * FROM dims",
    "clean_outlets_rejected": "SELECT * FROM marked WHERE failure_reason IS NOT NULL",
    "clean_transactions_kept": "SELECT * EXCLUDE (nth, failure_reason) FROM tm WHERE failure_reason IS NULL",
    "clean_transactions_rejected": "SELECT * EXCLUDE nth FROM tm WHERE failure_reason IS NOT NULL",
    "standardised_categories": "SELECT Outlet_ID, Outlet_Type AS kind, Outlet_Size AS size FROM tidy",
    "utm_project": "SELECT Outlet_ID, round(x, 4) AS x, round(y, 4) AS y FROM outxy",
    "competitor_edges": "SELECT s AS Source_Outlet_ID, t AS Target_Competitor_ID, Distance_Meters, Competitive_Friction FROM comp",
    "competitor_features": "SELECT * REPLACE (round(Total_Competitive_Friction, 10) AS Total_Competitive_Friction, round(Average_Competitive_Friction, 10) AS Average_Competitive_Friction) FROM compf",
    "poi_edges": "SELECT * FROM poie",
    "poi_edges_no_multiplier": f"SELECT Outlet_ID, POI_ID, POI_Type, {_half_even('d', 2)} AS Distance_Meters, Base_Footfall, {_half_even('exp(-(d * d) / 180000.0)', 4)} AS Decay_Weight, {_half_even('Base_Footfall * exp(-(d * d) / 180000.0)', 2)} AS Footfall_Impact_Score FROM near WHERE d <= 1000.0",
    "poi_counts": "SELECT * FROM poic",
    "poi_category_pivot": "SELECT * FROM poip",
    "poi_features": "SELECT * REPLACE (round(POI_Avg_Distance_Meters, 9) AS POI_Avg_Distance_Meters) FROM poif",
    "gold_features": _GOLD_OUT.format(t="gold", more=", round(Total_Competitive_Friction, 10) AS Total_Competitive_Friction, round(Average_Competitive_Friction, 10) AS Average_Competitive_Friction, round(POI_Avg_Distance_Meters, 9) AS POI_Avg_Distance_Meters"),
    "gold_features_legacy": _GOLD_OUT.format(t="goldl", more=""),
    "onehot_dropfirst": "SELECT c_custkey, " + ", ".join(f"(c_mktsegment = '{v.upper()}')::INT AS Segment_{v}" for v in ("Building", "Furniture", "Household", "Machinery")) + " FROM customer",
    "latest_row": "SELECT o_custkey, o_orderdate, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
    "first_per_group": "SELECT o_custkey, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderkey % 3 <> 0) AS status, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS o_orderpriority FROM orders GROUP BY o_custkey",
    "sequential_ids": "SELECT p_partkey, 'POI_' || lpad((row_number() OVER (ORDER BY p_partkey) - 1)::VARCHAR, 6, '0') AS poi_id FROM part",
    "historical_peaks": "SELECT * FROM peaks",
    "baseline_january": "SELECT Outlet_ID, round(Y_historical, 6) AS Y_historical FROM base",
    "price_fallback": "SELECT Outlet_ID, round(Price_Per_Liter, 9) AS Price_Per_Liter FROM price",
    "latent_potential": "SELECT * FROM pot",
    "spend_allocation": "SELECT * EXCLUDE U REPLACE (round(Y_historical, 9) AS Y_historical, round(Price_Per_Liter, 9) AS Price_Per_Liter, round(Headroom, 9) AS Headroom, round(a, 9) AS a) FROM alloc",
    "allocation_summary": f"SELECT count(*) AS outlets, {_exact('Trade_Spend_Allocation_LKR')} AS allocated, {_exact('Volume_Lift_Liters')} AS lift, count(*) FILTER (WHERE Trade_Spend_Allocation_LKR > 0.01) AS active_outlets, count(*) FILTER (WHERE abs(Trade_Spend_Allocation_LKR - U) <= 1e-8 + 1e-3 * abs(U)) AS ceiling_outlets, {BUDGET}::DOUBLE AS budget, round(coalesce({_exact('Volume_Lift_Liters')} / nullif({_exact('Trade_Spend_Allocation_LKR')}, 0), 0.0), 6) AS roi FROM alloc",
    "spend_by_distributor": _spend("Distributor_ID"), "spend_by_size": _spend("Outlet_Size"), "spend_by_type": _spend("Outlet_Type"),
    "ceiling_verification": "SELECT (SELECT count(*) FROM pred) - count(*) AS unmatched, count(*) AS evaluated, round(avg((Maximum_Monthly_Liters >= hist_max)::INT::DOUBLE) * 100, 6) AS pct_above_max, round(avg((Maximum_Monthly_Liters >= hist_mean)::INT::DOUBLE) * 100, 6) AS pct_above_mean, count(*) FILTER (WHERE Maximum_Monthly_Liters < hist_max) AS under_max, (SELECT count(*) FROM pred WHERE Maximum_Monthly_Liters IS NULL) AS null_predictions, (SELECT count(*) FROM pred WHERE Maximum_Monthly_Liters <= 0) AS non_positive, (SELECT min(Maximum_Monthly_Liters) FROM pred) AS min_prediction, (SELECT max(Maximum_Monthly_Liters) FROM pred) AS max_prediction FROM rat",
    "ratio_distribution": _describe("rat", ["ratio_to_max", "ratio_to_mean", "ratio_under_max"], 6),
    "outlet_report": "SELECT Outlet_ID, round(Avg_Monthly_Volume, 4) AS Avg_Monthly_Volume, round(Potential_Volume, 4) AS Potential_Volume, round(Efficiency_Score, 4) AS Efficiency_Score, round(CV_Volume, 4) AS CV_Volume, round(Flatline_Score, 4) AS Flatline_Score, round(Round_Number_Bias, 4) AS Round_Number_Bias, round(Price_Rigidity, 2) AS Price_Rigidity FROM rep",
    "efficiency_correlation": " UNION ALL ".join(f"SELECT '{c}' AS proxy, round(corr(Efficiency_Score, {c}), 5) AS correlation FROM rep" for c in ("CV_Volume", "Flatline_Score", "Round_Number_Bias", "Price_Rigidity")),
    "ranked_coefficients": "SELECT *, row_number() OVER (ORDER BY abs(beta) DESC, feature)::INT AS rank FROM (VALUES " + ", ".join(f"('{f}', {b!r}::DOUBLE)" for f, b in BETA.items()) + ") v(feature, beta)",
    "driver_impacts": "SELECT Outlet_ID, rank::INT AS rank, feature_name, coefficient, round(percentage_impact, 6) AS percentage_impact, feature_value, round(strength, 6) AS local_driver_strength, signal FROM fxr",
    "explanation_metrics": "SELECT Outlet_ID, round(p, 4) AS predicted_potential, round(a / p, 4) AS efficiency_score, round(greatest(0.0, p - a), 4) AS opportunity_gap, round(CASE WHEN a > p THEN 0.0 ELSE (1.0 - a / p) * 100 END, 4) AS inefficiency_pct FROM perf",
    "driver_impacts_legacy": "SELECT Outlet_ID, round(greatest(p, a), 4) AS predicted_potential, round(CASE WHEN a > p THEN 0.0 ELSE (1.0 - a / p) * 100 END, 4) AS inefficiency_pct, CASE WHEN a > p THEN 0.0 ELSE (1.0 - a / p) * 100 END <= 0.5 AS at_peak, k::INT AS rank, feature_name, round(c, 4) AS contribution FROM perf JOIN (SELECT Outlet_ID, feature_name, feature_value * coefficient AS c, row_number() OVER (PARTITION BY Outlet_ID ORDER BY feature_value * coefficient DESC, feature_name) AS k FROM fx) USING (Outlet_ID) WHERE k <= 2",
    "dq_nulls": "SELECT * FROM (SELECT 'Latitude' AS column_name, count(*) FILTER (WHERE Latitude IS NULL) AS null_count FROM coords UNION ALL SELECT 'Longitude', count(*) FILTER (WHERE Longitude IS NULL) FROM coords UNION ALL SELECT 'Outlet_Size', count(*) FILTER (WHERE Outlet_Size IS NULL) FROM master) WHERE null_count > 0",
    "dq_duplicates": "SELECT (count(*) - count(DISTINCT (l_orderkey, l_linenumber)))::BIGINT AS duplicate_count FROM lineitem",
    "dq_ranges": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9000",
    "dq_referential": "SELECT DISTINCT Outlet_ID AS missing_key FROM dirty WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM master)",
    "dq_datatypes": "SELECT * FROM (VALUES ('c_name', 'bigint', 'string'), ('c_phone', 'string', 'Missing Column')) v(column_name, expected, found)",
    "silver_report": _checks(
        [(f"transactions null {c}", f"SELECT count(*) FROM tk WHERE {c} IS NULL") for c in _KEYS.split(", ")]
        + [(f"outlets null {c}", f"SELECT count(*) FROM dims WHERE {c} IS NULL") for c in ("Outlet_ID", "Outlet_Size", "Cooler_Count", "Outlet_Type", "Latitude", "Longitude")]
        + [
            ("transactions duplicates", f"SELECT (SELECT count(*) FROM tk) - (SELECT count(*) FROM (SELECT DISTINCT {_KEYS} FROM tk))"), ("outlets duplicates", "SELECT count(*) - count(DISTINCT Outlet_ID) FROM dims"),
            ("transactions orphan outlets", "SELECT count(DISTINCT Outlet_ID) FROM tk WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM dims)"),
            ("outlets latitude range", "SELECT count(*) FROM dims WHERE Latitude < 5.9 OR Latitude > 9.9"), ("outlets longitude range", "SELECT count(*) FROM dims WHERE Longitude < 79.6 OR Longitude > 81.9"),
        ]
    ),
    "bronze_report": _checks(
        [(f"null {c}", f"SELECT count(*) FROM dirty WHERE {c} IS NULL") for c in _KEYS.split(", ")]
        + [("duplicates", f"SELECT (SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT {_KEYS} FROM dirty))"), ("volume range", "SELECT count(*) FROM dirty WHERE Volume_Liters < 0 OR Volume_Liters > 1e9"), ("orphan outlets", "SELECT count(DISTINCT Outlet_ID) FROM dirty WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM master)")]
    ),
    "anom_negative": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0",
    "anom_spikes": "SELECT Outlet_ID, SKU_ID, Total_Bill_Value FROM trans WHERE Total_Bill_Value > (SELECT avg(Total_Bill_Value) + 1.5 * stddev_samp(Total_Bill_Value) FROM trans)",
    "anom_duplicate_invoices": "SELECT Outlet_ID, Year, Month, SKU_ID, Volume_Liters FROM trans QUALIFY count(*) OVER (PARTITION BY Outlet_ID, Year, Month, SKU_ID, Volume_Liters) > 1",
    "anom_repeated_timestamps": "SELECT event_id, 'OUT_' || lpad(user_id::VARCHAR, 7, '0') AS Outlet_ID FROM events QUALIFY count(*) OVER (PARTITION BY user_id, date_trunc('minute', ts)) > 1",
    "anom_midnight": "SELECT o_orderkey FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate ELSE o_orderdate + INTERVAL 1 HOUR END AS moment FROM orders) WHERE hour(moment) = 0 AND minute(moment) = 0 AND second(moment) = 0",
    "anom_duplicate_gps": "SELECT Outlet_ID FROM coords QUALIFY count(*) OVER (PARTITION BY Latitude, Longitude) > 1",
    "anom_invalid_coordinates": f"SELECT Outlet_ID FROM (SELECT Outlet_ID, CASE WHEN {_ODD} % 17 = 0 THEN Latitude * 20 ELSE Latitude END AS la, Longitude FROM coords) WHERE abs(la) > 90 OR abs(Longitude) > 180",
    "anom_ocean": "SELECT Outlet_ID FROM coords WHERE NOT coalesce(Latitude BETWEEN 5.9 AND 9.9 AND Longitude BETWEEN 79.6 AND 81.9, false)",
    "anom_inactive": "SELECT Outlet_ID FROM master WHERE Outlet_ID NOT IN (SELECT Outlet_ID FROM trans)",
    "anom_inactive_events": "SELECT Outlet_ID FROM master WHERE Outlet_ID NOT IN (SELECT 'OUT_' || lpad(user_id::VARCHAR, 7, '0') FROM events)",
    "anom_volatility": "SELECT Outlet_ID, SKU_ID, Total_Bill_Value FROM trans WHERE Outlet_ID IN (SELECT Outlet_ID FROM trans GROUP BY 1 HAVING stddev_samp(Total_Bill_Value) / avg(Total_Bill_Value) > 0.7)",
    "anom_delivery_caps": "SELECT * FROM (SELECT Distributor_ID, Year, Month, sum(Volume_Liters::DECIMAL(38,6))::DOUBLE AS total FROM trans GROUP BY ALL) QUALIFY count(*) OVER (PARTITION BY Distributor_ID, total) > 1",
    "anom_round_numbers": "SELECT Outlet_ID, SKU_ID, Volume_Liters FROM trans WHERE Volume_Liters % 25 = 0",
    "anom_monthly_ceilings": "WITH m AS (SELECT Distributor_ID, Year, Month, sum(Volume_Liters::DECIMAL(38,6)) AS total FROM trans GROUP BY ALL), top AS (SELECT Distributor_ID, max(total) AS total FROM m GROUP BY 1) SELECT Distributor_ID, Year, Month, total::DOUBLE AS total FROM m WHERE Distributor_ID IN (SELECT Distributor_ID FROM m JOIN top USING (Distributor_ID, total) GROUP BY 1 HAVING count(*) > 1)",
    "anom_id_noise": r"SELECT value, noise FROM (SELECT DISTINCT coalesce(Outlet_Type, '') AS value FROM master), (VALUES ('lowercase', '[a-z]'), ('whitespace', '^\s|\s$'), ('symbol', '[^A-Z0-9_]')) k(noise, pattern) WHERE regexp_matches(value, pattern)",
    "anom_ghosts": f"SELECT Outlet_ID, round(sum(CASE WHEN {_ODD} % 19 = 0 THEN 0.01::DOUBLE ELSE Total_Bill_Value END), 6) AS total FROM trans GROUP BY 1 HAVING total < 1.0",
    "anom_batch_writes": "SELECT Distributor_ID, Year, Month, Volume_Liters, count(*) AS records FROM trans GROUP BY ALL HAVING count(*) > 2",
    "anom_count_spikes": "WITH c AS (SELECT Distributor_ID, Year, Month, count(*) AS tx_count FROM trans GROUP BY ALL) SELECT * FROM c WHERE tx_count > (SELECT avg(tx_count) + 2.0 * stddev_samp(tx_count) FROM c)",
    "anom_data_decay": "WITH c AS (SELECT Outlet_ID, max(make_date(Year, Month, 1)) AS last_seen FROM trans GROUP BY 1) SELECT Outlet_ID, last_seen::VARCHAR AS last_seen FROM c WHERE last_seen < (SELECT max(last_seen) - INTERVAL 6 MONTH FROM c)",
    "anom_magic_numbers": "SELECT Volume_Liters AS value, count(*) AS hits FROM trans WHERE Volume_Liters IN (1, 11, 50, -1) GROUP BY 1",
    "monthly_trend": f"SELECT make_date(Year, Month, 1)::VARCHAR AS day, {_money('Volume_Liters')} AS volume, {_money('Total_Bill_Value')} AS bill FROM trans GROUP BY 1",
    "province_trend": f"SELECT {_prov('Distributor_ID')} AS Province, Year, Month, {_money('Total_Bill_Value')} AS bill, {_money('Volume_Liters')} AS volume FROM trans GROUP BY ALL",
    "province_totals": f"SELECT {_prov('Distributor_ID')} AS Province, {_money('Total_Bill_Value')} AS bill, {_money('Volume_Liters')} AS volume, count(DISTINCT Outlet_ID) AS outlets FROM trans GROUP BY ALL",
    "top_distributors": f"SELECT Distributor_ID, {_money('Total_Bill_Value')} AS bill FROM trans GROUP BY 1 ORDER BY bill DESC, Distributor_ID LIMIT 20",
    "enriched_transactions": f"SELECT Outlet_Type, count(*) AS n, {_money('Total_Bill_Value')} AS bill FROM trans LEFT JOIN master USING (Outlet_ID) GROUP BY 1",
    "describe_skew": _describe("lineitem", ["l_quantity", "l_extendedprice", "l_discount"], 4, skew=True),
    "correlation_matrix": " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS correlation FROM lineitem" for a in _CORR for b in _CORR),
    "value_counts_top10": "SELECT l_quantity, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_quantity LIMIT 10",
    "random_sample": "SELECT o_orderkey FROM orders ORDER BY md5('7|' || o_orderkey::VARCHAR) LIMIT 1000",
}


def _needs(text: str) -> set[str]:
    import re

    return {p for p in PARTS if re.search(rf"\b{p}\b", text)}


def sql() -> dict[str, str]:
    """Each query with the common table expressions that it needs, in order."""
    out = {}
    for name, q in QUERIES.items():
        need, more = set(), _needs(q)
        while more:
            need |= more
            more = set().union(*(_needs(PARTS[p]) for p in more)) - need
        parts = [f"{p} AS ({body})" for p, body in PARTS.items() if p in need]
        head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
        out[name] = head + (q if not q.startswith("WITH ") else f"SELECT * FROM ({q})")
    return out
