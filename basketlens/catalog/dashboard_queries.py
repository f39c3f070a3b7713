"""Dashboard and BI datasets."""

from __future__ import annotations

from basketlens.catalog.oracle_base import money_avg, money_sum, over_orders
from basketlens.catalog.rounding import rounded
from basketlens.plans import dashboard as d
from basketlens.sources.retail import first_orders, retail_orders

AMT, SAT, ID, CH, INC, GEN = (
    "Purchase_Amount", "Customer_Satisfaction", "Customer_ID", "Purchase_Channel", "Income_Level", "Gender",
)
# The filter choice of the registered dashboard queries; no income chosen means all.
CHOICE = {CH: ["Online", "In-Store"], INC: [], GEN: ["Female"]}
INTENTS = ["Planned", "Impulsive", "Need-based", "Wants-based"]


def _chosen(build, *columns):
    def run(spark, path):
        orders = retail_orders(spark, path, list(dict.fromkeys([CH, GEN, *columns])))
        return rounded(build(d.select_rows(orders, **{k: v for k, v in CHOICE.items() if v})))

    return run


def _all(build, *columns):
    return lambda spark, path: rounded(build(retail_orders(spark, path, list(columns))))


def w11_shared_frame(spark, path):
    """Several datasets served from one persisted filtered frame; their row counts."""
    with d.dashboard(retail_orders(spark, path), CHOICE[CH], CHOICE[INC], CHOICE[GEN]) as sets:
        rows = [(name, frame.count()) for name, frame in sorted(sets.items())]
    return spark.createDataFrame(rows, "dataset string, rows bigint")


# Filter choices of the cube's query: channels, incomes, genders.
CHOICES = [(CHOICE[CH], CHOICE[INC], CHOICE[GEN]), ([], [], []), (["Mixed"], ["Low", "High"], [])]


def w11_dataset_values(spark, path):
    """Every value of the eight datasets for three filter choices, from one cube; the first choice comes again at the end."""
    cube = d.DashboardCube(retail_orders(spark, path, [
        CH, INC, GEN, ID, "Age", AMT, SAT, "Time_of_Purchase", "Purchase_Category", "Payment_Method", "Frequency_of_Purchase"]))
    result = None
    for at, choice in enumerate([*CHOICES, CHOICES[0]]):
        for name, frame in cube.datasets(*choice).items():
            key = "''" if name == "kpi" else f"cast({frame.columns[0]} as string)"
            measures = [c for c in frame.columns if name == "kpi" or c != frame.columns[0]]
            cells = ", ".join(f"struct('{m}' as measure, round(cast({m} as double), 6) as value)" for m in measures)
            part = frame.selectExpr(f"{at} as choice", f"'{name}' as dataset", f"{key} as item", f"inline(array({cells}))")
            result = part if result is None else result.unionByName(part)
    return result


QUERIES = {
    "p_measures": _all(d.bi_measures, AMT, ID, "Return_Rate", "High_Satisfaction", "Discount_Used",
                       "Customer_Loyalty_Program_Member"),
    "p_cards": _all(d.bi_cards, AMT, ID, SAT, "Return_Rate", "Discount_Used"),
    "p_category_revenue": _all(lambda o: d.revenue_by(o, "Purchase_Category"), "Purchase_Category", AMT),
    "p_channel_count": _all(lambda o: d.count_by(o, CH), CH, ID),
    "p_slicers": _all(
        lambda o: d.kpi_row(d.select_rows(o, Gender=["Male"], Income_Level=["Low", "High"], Education_Level=["PhD"])),
        GEN, INC, "Education_Level", AMT, SAT),
    "p_location_count": _all(lambda o: d.count_by(o, "Location"), "Location", ID),
    "p_age_amount": _all(lambda o: o.select(ID, "Age", AMT, INC), ID, "Age", AMT, INC),
    "p_agegroup_gender_freq": _all(d.age_gender_frequency, "Age", GEN, "Frequency_of_Purchase"),
    "p_payment_count": _all(lambda o: d.count_by(o, "Payment_Method"), "Payment_Method", ID),
    "p_sensitivity_intent_matrix": _all(
        d.sensitivity_intent_matrix, "Discount_Sensitivity", "Purchase_Intent", SAT),
    "p_month_revenue": _all(lambda o: d.revenue_by(o, "Purchase_Month"), "Purchase_Month", AMT),
    "p_social_loyalty": _all(
        lambda o: d.mean_by(o, "Social_Media_Influence", "Brand_Loyalty", "avg_loyalty"),
        "Social_Media_Influence", "Brand_Loyalty"),
    "p_shipping_satisfaction": _all(
        lambda o: d.mean_by(o, "Shipping_Preference", SAT, "avg_satisfaction"), "Shipping_Preference", SAT),
    "p_member_split": _all(d.member_split, "Customer_Loyalty_Program_Member", ID),
    "p_channel_category_drill": _all(lambda o: d.channel_drill(o, "Online"), CH, "Purchase_Category", ID, AMT),
    "w01_options": _all(d.filter_options, CH, INC, GEN),
    "w02_filtered": _chosen(lambda o: o, ID, INC, "Age", AMT),
    "w03_kpi": _chosen(d.kpi_row, AMT, SAT),
    "w04_monthly": _chosen(d.by_month, "Time_of_Purchase", AMT, SAT),
    "w05_top_categories": _chosen(d.top_categories, "Purchase_Category", AMT),
    "w06_channel_revenue": _chosen(lambda o: d.revenue_by(o, CH), AMT),
    "w06_payment_revenue": _chosen(lambda o: d.revenue_by(o, "Payment_Method"), "Payment_Method", AMT),
    "w07_sample": _chosen(lambda o: d.scatter_sample(o, ["Age", AMT]), ID, "Age", AMT),
    "w08_category_combo": _chosen(
        lambda o: d.revenue_by(o, "Purchase_Category", Freq="Frequency_of_Purchase"),
        "Purchase_Category", AMT, "Frequency_of_Purchase"),
    "w09_income_combo": _chosen(lambda o: d.revenue_by(o, INC, CSAT=SAT), INC, AMT, SAT),
    "w10_preview": lambda spark, path: rounded(d.preview(first_orders(spark, path, d.PREVIEW_ROWS))),
    "w11_shared_frame": w11_shared_frame,
    "w11_dataset_values": w11_dataset_values,
}

REV = f"round({money_sum()}, 6)"
AOV = f"round({money_avg()}, 6)"
F_ = "f AS (SELECT * FROM o WHERE Purchase_Channel IN ('Online', 'In-Store') AND Gender = 'Female')"
HASH = "CAST('0x' || substr(md5(Customer_ID || '-42'), 1, 13) AS BIGINT)"


def _f(body):
    return over_orders(body, F_)


def _count(key):
    return over_orders(f"SELECT {key}, count(Customer_ID) AS count FROM o GROUP BY 1")


def _share(flag):
    return f"round(100.0 * count(*) FILTER (WHERE {flag} = 1) / count(*), 6)::DOUBLE"


def _revenue(source, key, extra="", keep=True):
    where = f"WHERE {key} IS NOT NULL" if keep else ""
    return f"SELECT {key}, {REV} AS Purchase_Amount{extra} FROM {source} {where} GROUP BY 1"


_KPI = f"SELECT count(*) AS n, {REV} AS revenue, {AOV} AS aov, round(avg({SAT}), 6) AS csat FROM"

def _dataset_values():
    parts, ctes = [], []
    for at, (channels, incomes, genders) in enumerate([*CHOICES, CHOICES[0]]):
        where = " AND ".join(
            ["TRUE"] + [f"{c} IN ({', '.join(repr(v) for v in values)})" for c, values in ((CH, channels), (INC, incomes), (GEN, genders)) if values])
        f = f"f{at}"
        ctes.append(f"{f} AS (SELECT * FROM o WHERE {where})")
        month = "strftime(date_trunc('month', Time_of_Purchase), '%Y-%m-%d') || ' 00:00:00'"
        sat, freq, top = f"avg({SAT})", "avg(Frequency_of_Purchase)", f"(SELECT Purchase_Category, {money_sum()} AS v FROM {f} WHERE Purchase_Category IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5)"
        sample = f"(SELECT * FROM {f} ORDER BY {HASH}, Customer_ID LIMIT 150)"
        parts += [f"SELECT {at} AS choice, 'kpi' AS dataset, '' AS item, '{m}' AS measure, CAST({v} AS DOUBLE) AS value FROM {f}"
                  for m, v in (("n", "count(*)"), ("revenue", money_sum()), ("aov", money_avg()), ("csat", sat))]
        for name, key, measures in (
            ("monthly", month, {"Purchase_Amount": money_sum(), "CSAT": sat}), ("channels", CH, {"Purchase_Amount": money_sum()}),
            ("payments", "Payment_Method", {"Purchase_Amount": money_sum()}), ("incomes", INC, {"Purchase_Amount": money_sum(), "CSAT": sat}),
            ("categories", "Purchase_Category", {"Purchase_Amount": money_sum(), "Freq": freq}),
        ):
            parts += [f"SELECT {at}, '{name}', {key}, '{m}', {v} FROM {f} WHERE {key} IS NOT NULL GROUP BY {key}" for m, v in measures.items()]
        parts.append(f"SELECT {at}, 'top_categories', Purchase_Category, 'Purchase_Amount', v FROM {top}")
        parts += [f"SELECT {at}, 'scatter', Customer_ID, '{m}', {m} FROM {sample}" for m in ("Age", AMT)]
    body = " UNION ALL ".join(parts)
    return over_orders(f"SELECT choice, dataset, item, measure, round(value, 6) AS value FROM ({body})", *ctes)


ORACLE = {
    "w11_dataset_values": _dataset_values(),
    "p_measures": over_orders(f"""SELECT {REV} AS total_revenue, {AOV} AS aov,
        round(CAST(sum(Return_Rate) AS DOUBLE) / count(*), 6) AS return_rate_pct,
        round(avg(High_Satisfaction), 6) AS high_satisfaction_pct, {_share('Discount_Used')} AS discount_usage_pct,
        {_share('Customer_Loyalty_Program_Member')} AS loyalty_member_pct FROM o"""),
    "p_cards": over_orders(f"""SELECT count(*) AS total_orders, {REV} AS total_revenue, {AOV} AS aov,
        round(avg({SAT}), 6) AS avg_satisfaction, round(avg(Return_Rate), 6) AS avg_return_rate,
        {_share('Discount_Used')} AS discount_usage_pct FROM o"""),
    "p_category_revenue": over_orders(_revenue("o", "Purchase_Category")),
    "p_channel_count": _count(CH),
    "p_slicers": over_orders(
        _KPI + " o WHERE Gender = 'Male' AND Income_Level IN ('Low', 'High') AND Education_Level = 'PhD'"),
    "p_location_count": _count("Location"),
    "p_age_amount": over_orders("SELECT Customer_ID, Age, Purchase_Amount, Income_Level FROM o"),
    "p_agegroup_gender_freq": over_orders("""SELECT CASE WHEN Age <= 25 THEN '18-25' WHEN Age <= 35 THEN '26-35'
        WHEN Age <= 45 THEN '36-45' WHEN Age <= 55 THEN '46-55' ELSE '55+' END AS Age_Group, Gender,
        round(avg(Frequency_of_Purchase), 6) AS avg_frequency FROM o WHERE Age > 18 AND Age <= 70 GROUP BY 1, 2"""),
    "p_payment_count": _count("Payment_Method"),
    "p_sensitivity_intent_matrix": over_orders(
        "SELECT Discount_Sensitivity, " + ", ".join(
            f"round(avg({SAT}) FILTER (WHERE Purchase_Intent = '{i}'), 6) AS \"{i}\"" for i in INTENTS)
        + " FROM o WHERE Discount_Sensitivity IS NOT NULL GROUP BY 1"),
    "p_month_revenue": over_orders(_revenue("o", "Purchase_Month")),
    "p_social_loyalty": over_orders(
        "SELECT Social_Media_Influence, round(avg(Brand_Loyalty), 6) AS avg_loyalty FROM o GROUP BY 1"),
    "p_shipping_satisfaction": over_orders(
        f"SELECT Shipping_Preference, round(avg({SAT}), 6) AS avg_satisfaction FROM o GROUP BY 1"),
    "p_member_split": over_orders("""SELECT CASE Customer_Loyalty_Program_Member WHEN 1 THEN 'Member'
        ELSE 'Non-Member' END AS Loyalty_Status, count(*) AS count FROM o GROUP BY 1"""),
    "p_channel_category_drill": over_orders(f"""SELECT Purchase_Category, count(*) AS count, {REV} AS total_revenue
        FROM o WHERE Purchase_Channel = 'Online' GROUP BY 1"""),
    "w01_options": over_orders(" UNION ".join(f"SELECT '{c}' AS filter, {c} AS option FROM o" for c in (CH, INC, GEN))),
    "w02_filtered": _f("SELECT Purchase_Channel, Gender, Customer_ID, Income_Level, Age, Purchase_Amount FROM f"),
    "w03_kpi": _f(_KPI + " f"),
    "w04_monthly": _f(f"""SELECT CAST(date_trunc('month', Time_of_Purchase) AS TIMESTAMP) AS Time_of_Purchase,
        {REV} AS Purchase_Amount, round(avg({SAT}), 6) AS CSAT FROM f GROUP BY 1"""),
    "w05_top_categories": _f(_revenue("f", "Purchase_Category") + " ORDER BY 2 DESC, 1 LIMIT 5"),
    "w06_channel_revenue": _f(_revenue("f", CH)),
    "w06_payment_revenue": _f(_revenue("f", "Payment_Method")),
    "w07_sample": _f(f"SELECT Age, Purchase_Amount FROM f ORDER BY {HASH}, Customer_ID LIMIT 150"),
    "w08_category_combo": _f(_revenue("f", "Purchase_Category", ", round(avg(Frequency_of_Purchase), 6) AS Freq")),
    "w09_income_combo": _f(_revenue("f", INC, f", round(avg({SAT}), 6) AS CSAT")),
    "w10_preview": over_orders(
        "SELECT * EXCLUDE (o_orderkey, Research_Hours), round(Research_Hours, 6) AS Research_Hours "
        "FROM o ORDER BY Customer_ID LIMIT 50"),
    "w11_shared_frame": _f("""SELECT 'kpi' AS dataset, CAST(1 AS BIGINT) AS rows
        UNION ALL SELECT 'monthly', count(DISTINCT date_trunc('month', Time_of_Purchase)) FROM f
        UNION ALL SELECT 'top_categories', least(5, count(DISTINCT Purchase_Category)) FROM f
        UNION ALL SELECT 'channels', count(DISTINCT Purchase_Channel) FROM f
        UNION ALL SELECT 'scatter', least(150, count(*)) FROM f
        UNION ALL SELECT 'payments', count(DISTINCT Payment_Method) FROM f
        UNION ALL SELECT 'categories', count(DISTINCT Purchase_Category) FROM f
        UNION ALL SELECT 'incomes', count(DISTINCT Income_Level) FROM f"""),
}
