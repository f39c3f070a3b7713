"""SQL building blocks for the oracle: the order view and the measures.

Written for DuckDB over the given tables, independently of the Spark plans.
"""

from __future__ import annotations

LINES = """lines AS (
  SELECT l_orderkey,
         count(*) AS n_lines,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS qty,
         CAST(sum(CAST(round(l_discount * 100) AS BIGINT)) AS BIGINT) AS disc_pct,
         max(l_discount) AS max_disc,
         count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret,
         min(p_type) AS ptype
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
  GROUP BY l_orderkey)"""

FREQ = "freq AS (SELECT o_custkey AS f_custkey, count(*) AS freq FROM orders GROUP BY o_custkey)"

TYPED = """typed AS (
  SELECT o_orderkey,
    CAST(o_orderkey AS VARCHAR) AS Customer_ID,
    CAST(18 + o_custkey % 53 AS INTEGER) AS Age,
    CASE o_custkey % 2 WHEN 0 THEN 'Female' ELSE 'Male' END AS Gender,
    CASE WHEN c_acctbal < 2500 THEN 'Low' WHEN c_acctbal < 6500 THEN 'Middle' ELSE 'High' END AS Income_Level,
    CASE (o_custkey * 3 + c_nationkey) % 4
      WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Divorced' WHEN 3 THEN 'Widowed' END AS Marital_Status,
    CASE (o_custkey + c_nationkey) % 5
      WHEN 0 THEN 'High School' WHEN 1 THEN 'Bachelor''s' WHEN 2 THEN 'Master''s'
      WHEN 3 THEN 'PhD' WHEN 4 THEN 'Other' END AS Education_Level,
    c_mktsegment AS Occupation,
    n_name AS Location,
    ptype AS Purchase_Category,
    o_totalprice AS Purchase_Amount,
    CAST(freq AS INTEGER) AS Frequency_of_Purchase,
    CASE o_orderstatus WHEN 'F' THEN 'Online' WHEN 'O' THEN 'In-Store' WHEN 'P' THEN 'Mixed' END AS Purchase_Channel,
    CAST(CASE WHEN n_lines > 5 THEN 5 ELSE n_lines END AS INTEGER) AS Brand_Loyalty,
    CAST(1 + (o_orderkey * 3) % 5 AS INTEGER) AS Product_Rating,
    CAST(qty AS DOUBLE) / (10 * n_lines) AS Research_Hours,
    CASE (o_orderkey + o_custkey) % 4
      WHEN 0 THEN 'None' WHEN 1 THEN 'Low' WHEN 2 THEN 'Medium' ELSE 'High' END AS Social_Media_Influence,
    CASE WHEN n_lines IS NULL THEN NULL WHEN disc_pct < 4 * n_lines THEN 'Not Sensitive'
      WHEN disc_pct < 6 * n_lines THEN 'Somewhat Sensitive' ELSE 'Very Sensitive' END AS Discount_Sensitivity,
    CAST(coalesce(n_ret, 0) AS INTEGER) AS Return_Rate,
    CAST(1 + (o_orderkey * 7 + o_custkey) % 10 AS INTEGER) AS Customer_Satisfaction,
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'High' WHEN '2' THEN 'High' WHEN '3' THEN 'Medium'
      WHEN '5' THEN 'Low' ELSE 'None' END AS Engagement_with_Ads,
    CASE o_custkey % 3 WHEN 0 THEN 'Smartphone' WHEN 1 THEN 'Tablet' ELSE 'Desktop' END AS Device_Used_for_Shopping,
    CASE (o_orderkey + c_nationkey) % 5 WHEN 0 THEN 'Credit Card' WHEN 1 THEN 'Debit Card' WHEN 2 THEN 'PayPal'
      WHEN 3 THEN 'Cash' WHEN 4 THEN 'Other' END AS Payment_Method,
    o_orderdate AS Time_of_Purchase,
    CASE WHEN max_disc >= 0.08 THEN 1 ELSE 0 END AS Discount_Used,
    CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS Customer_Loyalty_Program_Member,
    CASE (o_orderkey + 2 * o_custkey) % 4 WHEN 0 THEN 'Planned' WHEN 1 THEN 'Impulsive'
      WHEN 2 THEN 'Need-based' ELSE 'Wants-based' END AS Purchase_Intent,
    CASE o_orderkey % 3 WHEN 0 THEN 'Standard' WHEN 1 THEN 'Express' ELSE 'No Preference' END AS Shipping_Preference,
    CASE WHEN n_lines IS NOT NULL THEN CAST(1 + (o_orderkey * 11 + o_custkey) % 20 AS INTEGER) END AS Time_to_Decision
  FROM orders
  LEFT JOIN customer ON c_custkey = o_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN freq ON f_custkey = o_custkey
  LEFT JOIN lines ON l_orderkey = o_orderkey)"""

CALENDAR = """CAST(month(Time_of_Purchase) AS INTEGER) AS Purchase_Month,
    CAST(quarter(Time_of_Purchase) AS INTEGER) AS Purchase_Quarter,
    CAST(isodow(Time_of_Purchase) - 1 AS INTEGER) AS Purchase_DayOfWeek"""

FLAGS = """CASE WHEN Customer_Satisfaction >= 7 THEN 1 ELSE 0 END AS High_Satisfaction,
    CASE WHEN Brand_Loyalty >= 4 THEN 1 ELSE 0 END AS Is_Loyal"""

VIEW = f"""o AS (SELECT *, {CALENDAR}, {FLAGS} FROM typed)"""


def over_orders(body: str, *ctes: str, recursive: bool = False) -> str:
    """``body`` as a query over the order view ``o`` and further CTEs, which may refer to themselves if ``recursive``."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([LINES, FREQ, TYPED, VIEW, *ctes]) + "\n" + body


def money_sum(column: str = "Purchase_Amount") -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE)"


def money_avg(column: str = "Purchase_Amount") -> str:
    return f"{money_sum(column)} / count({column})"


def pct(flag: str) -> str:
    return f"round(100.0 * CAST(sum({flag}) AS DOUBLE) / count(*), 1)"


# Measure name -> SQL.
SQL = {
    "total_orders": "count(*)",
    "num_orders": "count(*)",
    "num_customers": "count(*)",
    "avg_order_value": f"round({money_avg()}, 2)",
    "aov": f"round({money_avg()}, 2)",
    "total_revenue": f"round({money_sum()}, 2)",
    "monthly_revenue": f"round({money_sum()}, 2)",
    "avg_satisfaction": "round(avg(Customer_Satisfaction), 2)",
    "avg_return_rate": "round(avg(Return_Rate), 2)",
    "avg_return_rate_3": "round(avg(Return_Rate), 3)",
    "avg_frequency": "round(avg(Frequency_of_Purchase), 1)",
    "avg_brand_loyalty": "round(avg(Brand_Loyalty), 2)",
    "avg_research_hours": "round(avg(Research_Hours), 2)",
    "avg_decision_time": "round(avg(Time_to_Decision), 1)",
    "total_discount_used": "CAST(sum(Discount_Used) AS BIGINT)",
    "discount_usage_pct": pct("Discount_Used"),
    "discount_pct": pct("Discount_Used"),
    "loyalty_member_pct": pct("Customer_Loyalty_Program_Member"),
    "Purchase_Quarter": "min(Purchase_Quarter)",
}


def grouped(keys: str, measures: str, tail: str = "", where: str = "") -> str:
    """One grouped report; ``keys`` and ``measures`` are blank-separated names or ``name=sql`` with ``;``."""
    key_items = [k.strip() for k in keys.split(";") if k.strip()]
    key_sql = [f"{k.split('=', 1)[1]} AS {k.split('=', 1)[0]}" if "=" in k.split("'")[0] else k for k in key_items]
    names = [m.removesuffix("_3") for m in measures.split()]
    measure_sql = [f"{SQL[m]} AS {n}" for m, n in zip(measures.split(), names)]
    group = f" GROUP BY {', '.join(str(i + 1) for i in range(len(key_sql)))}" if key_sql else ""
    where_sql = f" WHERE {where}" if where else ""
    return over_orders(f"SELECT {', '.join(key_sql + measure_sql)} FROM o{where_sql}{group} {tail}")


def listed(column: str, names: list[str]) -> str:
    """Name at the column's position, counted from 0."""
    return f"list_extract({names!r}, CAST({column} AS INTEGER) + 1)"


def stepped(column: str, steps: list[tuple[float, str]], rest: str) -> str:
    """Label of the first limit that the column does not exceed, else ``rest``."""
    arms = " ".join(f"WHEN {column} <= {limit} THEN '{name}'" for limit, name in steps)
    return f"CASE {arms} ELSE '{rest}' END"


def banded(column: str, edges: list[tuple[float, float, str]]) -> str:
    """Label of the band, open below and closed above; null outside."""
    arms = " ".join(f"WHEN {column} > {low} AND {column} <= {high} THEN '{name}'" for low, high, name in edges)
    return f"CASE {arms} END"
