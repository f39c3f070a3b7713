"""Exploratory datasets."""

from __future__ import annotations

from basketlens.catalog.oracle_base import banded, listed, money_avg, money_sum, over_orders
from basketlens.catalog.rounding import rounded
from basketlens.functions import bands
from basketlens.plans import charts
from basketlens.sources.retail import retail_orders

AMT, SAT, FREQ = "Purchase_Amount", "Customer_Satisfaction", "Frequency_of_Purchase"
ID = "Customer_ID"

# name -> (dataset, order columns it reads)
SPECS = {
    "a00_kpis": (charts.kpi_texts, [AMT, SAT, "Return_Rate", "Discount_Used", "Customer_Loyalty_Program_Member"]),
    "a01_hist": (charts.amount_histogram, [AMT]),
    "a01_box": (charts.amount_box, [AMT]),
    "a02_channel": (charts.channel, ["Purchase_Channel", AMT, ID, SAT]),
    "a03_top_categories": (charts.top_categories, ["Purchase_Category", AMT]),
    "a04_age_frequency": (charts.age_frequency, ["Age", FREQ]),
    "a05_income_gender": (charts.income_gender_pivot, ["Income_Level", "Gender", AMT]),
    "a06_sensitivity_box": (charts.sensitivity_box, ["Discount_Sensitivity", SAT]),
    "a07_intent_shares": (charts.intent_shares, ["Purchase_Intent"]),
    "a08_correlations": (charts.correlation_matrix, charts.CORRELATED),
    "a09_influence_loyalty": (charts.influence_loyalty, ["Social_Media_Influence", "Brand_Loyalty"]),
    "a10_monthly": (charts.monthly, ["Purchase_Month", AMT, ID]),
    "a11_marital": (charts.marital, ["Marital_Status", AMT, SAT, ID]),
    "a12_education": (charts.education, ["Education_Level", AMT, FREQ, SAT, "Research_Hours", ID]),
    "a13_occupation": (charts.occupation, ["Occupation", AMT, FREQ, "Brand_Loyalty"]),
    "a14_top_locations": (charts.top_locations, ["Location", AMT, ID, SAT]),
    "a15_rating": (charts.rating, ["Product_Rating", ID, SAT, "Return_Rate"]),
    "a16a_decision_hist": (charts.decision_histogram, ["Time_to_Decision"]),
    "a16b_decision_line": (charts.decision_line, ["Time_to_Decision", SAT]),
    "a16c_decision_by_intent": (
        lambda o: charts.decision_by(o, "Purchase_Intent"), ["Purchase_Intent", "Time_to_Decision"]),
    "a16c_decision_by_channel": (
        lambda o: charts.decision_by(o, "Purchase_Channel"), ["Purchase_Channel", "Time_to_Decision"]),
    "a17_weekday": (charts.weekday, ["Purchase_DayOfWeek", AMT, ID]),
    "a17_quarter": (charts.quarter, ["Purchase_Quarter", AMT, ID]),
    "a18_device_channel": (charts.device_channel_pivot, ["Device_Used_for_Shopping", "Purchase_Channel", AMT]),
    "a19_engagement": (charts.engagement, ["Engagement_with_Ads", AMT, FREQ, "Purchase_Intent", SAT]),
    "a20_shipping": (charts.shipping, ["Shipping_Preference", SAT, "Return_Rate", "Time_to_Decision", ID]),
    "a21_education_channel": (charts.education_channel_pivot, ["Education_Level", "Purchase_Channel", SAT]),
    "a22_loyalty_bands": (charts.loyalty_bands, [
        "Brand_Loyalty", AMT, FREQ, SAT, "Return_Rate", "Discount_Used", "Customer_Loyalty_Program_Member"]),
    "a23_data_quality": (charts.data_quality, None),
}


def _query(build, columns):
    def run(spark, path):
        return rounded(build(retail_orders(spark, path, columns)))

    return run


QUERIES = {name: _query(build, columns) for name, (build, columns) in SPECS.items()}

REV = f"round({money_sum()}, 6)"
AOV = f"round({money_avg()}, 6)"


def _avg(column: str) -> str:
    return f"round(avg({column}), 6)"


def hist_sql(value: str, bins: int, source: str) -> str:
    """Counts of equal-width bins, empty ones included."""
    return f"""SELECT CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS bin_start,
      round(lo + (b.i + 1) * w, 6) AS bin_end,
      (SELECT count(s.{value}) FROM {source} s WHERE s.{value} IS NOT NULL AND least(floor((s.{value} - lo) / w), {bins - 1}) = b.i) AS count
      FROM range({bins}) b(i),
      (SELECT CAST(min({value}) AS DOUBLE) AS lo, (CAST(max({value}) AS DOUBLE) - min({value})) / {bins} AS w
       FROM {source})"""


def box_sql(value: str, source: str, group: str | None = None) -> str:
    key = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    match = f"x.{group} = f.{group}" if group else "true"
    out = f"f.{group}, " if group else ""
    return f"""SELECT {out}round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, count(*) AS n,
      CAST(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_low,
      CAST(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS DOUBLE) AS whisker_high,
      count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM (SELECT {key}{value} AS v FROM {source} WHERE {value} IS NOT NULL) x
      JOIN (SELECT {key}quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.5) AS med,
                   quantile_cont({value}, 0.75) AS q3 FROM {source} {by}) f ON {match}
      GROUP BY {out}q1, med, q3"""


def _pivot_sql(row, column, levels, agg):
    cells = ", ".join(
        f"round({agg.replace('@', 'CASE WHEN ' + column + chr(61) + chr(39) + v + chr(39) + ' THEN')}, 6) AS \"{v}\""
        for v in levels)
    return over_orders(f"SELECT {row}, {cells} FROM o WHERE {row} IS NOT NULL GROUP BY {row}")


def _money_cell():
    total = "CAST(sum(@ CAST(Purchase_Amount AS DECIMAL(18,2)) END) AS DOUBLE)"
    return f"{total} / count(@ Purchase_Amount END)"


def _by(key, body, where=""):
    keep = f"{key} IS NOT NULL" + (f" AND {where}" if where else "")
    return over_orders(f"SELECT {key}, {body} FROM o WHERE {keep} GROUP BY {key}")


def _levels(names):
    return ", ".join("('" + n.replace("'", "''") + "')" for n in names)


def _ordered(key, names, body):
    return over_orders(
        f"SELECT l.{key}, g.* EXCLUDE ({key}) FROM (VALUES {_levels(names)}) AS l({key}) "
        f"LEFT JOIN (SELECT {key}, {body} FROM o GROUP BY {key}) g USING ({key})")


_AGE = banded("Age", bands.AGE_BANDS)
_LOYAL = banded("Brand_Loyalty", bands.LOYALTY_BANDS)
_DAY = listed("Purchase_DayOfWeek", bands.WEEKDAYS_SHORT) + " AS label"
_MISSING = ["Purchase_Category", "Brand_Loyalty", "Research_Hours", "Discount_Sensitivity", "Time_to_Decision"]

ORACLE = {
    "a00_kpis": over_orders(f"""SELECT unnest(['Total Orders', 'Total Revenue ($)', 'AOV ($)', 'Avg Satisfaction',
        'Avg Return Rate', 'Discount Usage %', 'Loyalty Members %']) AS kpi,
        unnest([CAST(count(*) AS VARCHAR), format('{{:,.2f}}', {money_sum()}), format('{{:,.2f}}', {money_avg()}),
        format('{{:.2f}}', avg({SAT})) || '/10', format('{{:.3f}}', avg(Return_Rate)),
        format('{{:.1f}}', avg(Discount_Used) * 100) || '%',
        format('{{:.1f}}', avg(Customer_Loyalty_Program_Member) * 100) || '%']) AS value FROM o"""),
    "a01_hist": over_orders(hist_sql(AMT, 30, "o")),
    "a01_box": over_orders(box_sql(AMT, "o")),
    "a02_channel": _by("Purchase_Channel", f"{REV} AS total_revenue, count(*) AS num_orders, {_avg(SAT)} AS avg_satisfaction"),
    "a03_top_categories": over_orders(f"""SELECT Purchase_Category, {REV} AS total_revenue FROM o
        WHERE Purchase_Category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 8"""),
    "a04_age_frequency": over_orders(f"""SELECT Age_Group, {_avg(FREQ)} AS avg_freq
        FROM (SELECT *, {_AGE} AS Age_Group FROM o) WHERE Age_Group IS NOT NULL GROUP BY 1"""),
    "a05_income_gender": _pivot_sql("Income_Level", "Gender", ["Female", "Male"], _money_cell()),
    "a06_sensitivity_box": over_orders(
        f"SELECT l.Discount_Sensitivity, b.* EXCLUDE (Discount_Sensitivity) FROM (VALUES {_levels(bands.SENSITIVITY)}) "
        f"AS l(Discount_Sensitivity) LEFT JOIN ({box_sql(SAT, 'o', 'Discount_Sensitivity')}) b USING (Discount_Sensitivity)"),
    "a07_intent_shares": over_orders(
        "SELECT Purchase_Intent, count(*) AS count, round(100.0 * count(*) / (SELECT count(*) FROM o), 6)::DOUBLE AS percent "
        "FROM o GROUP BY 1"),
    "a08_correlations": over_orders(" UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, "
        + ("1.0::DOUBLE AS r" if a == b else f"round(corr({a}, {b}), 6) AS r FROM o")
        for a in charts.CORRELATED for b in charts.CORRELATED)),
    "a09_influence_loyalty": _ordered("Social_Media_Influence", bands.INFLUENCE,
        "round(avg(Brand_Loyalty), 6) AS avg_loyalty, round(stddev_samp(Brand_Loyalty), 6) AS sd_loyalty"),
    "a10_monthly": _by("Purchase_Month", f"{REV} AS revenue, count(*) AS orders"),
    "a11_marital": _by("Marital_Status", f"{AOV} AS aov, {_avg(SAT)} AS avg_sat, count(*) AS count"),
    "a12_education": _ordered("Education_Level", bands.EDUCATION,
        f"{AOV} AS aov, {_avg(FREQ)} AS avg_freq, {_avg(SAT)} AS avg_sat, {_avg('Research_Hours')} AS avg_research, count(*) AS count"),
    "a13_occupation": _by("Occupation", f"{REV} AS total_rev, {AOV} AS aov, {_avg(FREQ)} AS avg_freq, {_avg('Brand_Loyalty')} AS avg_loyalty"),
    "a14_top_locations": over_orders(f"""SELECT Location, {REV} AS total_revenue, count(*) AS num_orders, {_avg(SAT)} AS avg_sat
        FROM o WHERE Location IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15"""),
    "a15_rating": _by("Product_Rating", f"count(*) AS count, {_avg(SAT)} AS avg_sat, {_avg('Return_Rate')} AS avg_ret"),
    "a16a_decision_hist": over_orders(hist_sql("Time_to_Decision", 20, "o")),
    "a16b_decision_line": over_orders(f"""SELECT DISTINCT CAST(Time_to_Decision AS DOUBLE) AS Time_to_Decision, round(s, 6) AS slope,
        round(i, 6) AS intercept, round(i + s * Time_to_Decision, 6) AS fitted FROM o,
        (SELECT regr_slope({SAT}, Time_to_Decision) AS s, regr_intercept({SAT}, Time_to_Decision) AS i FROM o)
        WHERE Time_to_Decision IS NOT NULL"""),
    "a16c_decision_by_intent": _by("Purchase_Intent", f"{_avg('Time_to_Decision')} AS avg_dec"),
    "a16c_decision_by_channel": _by("Purchase_Channel", f"{_avg('Time_to_Decision')} AS avg_dec"),
    "a17_weekday": _by("Purchase_DayOfWeek", f"{_DAY}, {REV} AS revenue, count(*) AS orders, {AOV} AS avg_amount"),
    "a17_quarter": _by("Purchase_Quarter", f"'Q' || Purchase_Quarter AS label, {REV} AS revenue, count(*) AS orders"),
    "a18_device_channel": _pivot_sql("Device_Used_for_Shopping", "Purchase_Channel", ["In-Store", "Mixed", "Online"], _money_cell()),
    "a19_engagement": _ordered("Engagement_with_Ads", bands.ENGAGEMENT,
        f"{AOV} AS aov, {_avg(FREQ)} AS avg_freq, round(100.0 * count(*) FILTER (WHERE Purchase_Intent = 'Impulsive') "
        f"/ count(*), 6)::DOUBLE AS avg_intent_imp, {_avg(SAT)} AS avg_sat"),
    "a20_shipping": _by("Shipping_Preference", f"{_avg(SAT)} AS avg_sat, {_avg('Return_Rate')} AS avg_ret, "
        f"{_avg('Time_to_Decision')} AS avg_dec, count(*) AS count"),
    "a21_education_channel": _pivot_sql("Education_Level", "Purchase_Channel", ["In-Store", "Mixed", "Online"], f"avg(@ {SAT} END)"),
    "a22_loyalty_bands": over_orders(f"""SELECT Loyalty_Group, {AOV} AS aov, {_avg(FREQ)} AS avg_freq, {_avg(SAT)} AS avg_sat,
        {_avg('Return_Rate')} AS avg_ret, {_avg('Discount_Used')} AS discount_rate,
        {_avg('Customer_Loyalty_Program_Member')} AS loyalty_mem_rate FROM (SELECT *, {_LOYAL} AS Loyalty_Group FROM o)
        WHERE Loyalty_Group IS NOT NULL GROUP BY 1"""),
    "a23_data_quality": over_orders(
        " UNION ALL ".join(f"SELECT 'missing' AS kind, '{c}' AS name, count(*) AS value FROM o WHERE {c} IS NULL"
                           for c in _MISSING)
        + " UNION ALL SELECT 'type', t, n FROM (VALUES ('string', 16), ('int', 14), ('double', 2), "
          "('timestamp_ntz', 1)) AS v(t, n)"),
}
