"""Group tests, matching, lifetime value and insights."""

from __future__ import annotations

from pyspark.sql import functions as F

from basketlens.catalog.chart_queries import box_sql
from basketlens.catalog.oracle_base import money_avg, money_sum, over_orders
from basketlens.catalog.rounding import rounded
from basketlens.functions import probability
from basketlens.operators import matching, stats, value
from basketlens.session import materialise
from basketlens.sources.retail import retail_orders

ARM, OUT, ID, AMT, SAT = "Discount_Used", "Return_Rate", "Customer_ID", "Purchase_Amount", "Customer_Satisfaction"

# Scores both engines compute alike: one with heavy ties, one nearly without.
TIED_SCORE = "(Age - 18 + Brand_Loyalty) / 60.0D"
DENSE_SCORE = "Purchase_Amount / 1000000.0D"


def _arms(spark, path, *more):
    return retail_orders(spark, path, [ARM, OUT, *more])


def _scored(spark, path, score):
    rows = matching.complete_rows(_arms(spark, path, ID, AMT, *matching.CONFOUNDERS))
    return rows.withColumn("score", F.expr(score))


def _pairs(spark, path, score=TIED_SCORE):
    scored = materialise(_scored(spark, path, score).select(ID, ARM, OUT, "score"), "scores")
    return matching.matched_pairs(scored, "score")


def _propensity(spark, path):
    rows = materialise(matching.complete_rows(_arms(spark, path, ID, *matching.CONFOUNDERS)), "confounders")
    return matching.propensity_scores(rows)


def _fitted_pairs(spark, path):
    """Matches by the fitted score; rows and scores are written once, narrow, and read by every step."""
    scored = materialise(_propensity(spark, path).select(ID, ARM, OUT, "Propensity_Score"), "propensity")
    return matching.matched_pairs(scored, "Propensity_Score")


def t1_mannwhitney(spark, path):
    return rounded(stats.mann_whitney(_arms(spark, path), ARM, OUT))


def t1_mannwhitney_amount(spark, path):
    return rounded(stats.mann_whitney(_arms(spark, path, AMT), ARM, AMT))


def t2_ttest(spark, path):
    return rounded(stats.t_test(_arms(spark, path), ARM, OUT))


def t3_cohens_d(spark, path):
    return rounded(stats.cohens_d(_arms(spark, path), ARM, OUT))


def t4_ks(spark, path):
    return rounded(stats.normality(retail_orders(spark, path, [AMT]), AMT))


def j1_propensity(spark, path):
    return rounded(_propensity(spark, path).select(ID, ARM, "Propensity_Score"))


def j2_nearest_match(spark, path):
    return rounded(_pairs(spark, path).select(ID, "score", "control_id", "match_score", "distance"), 9)


def j2_nearest_match_dense(spark, path):
    return rounded(_pairs(spark, path, DENSE_SCORE).select(ID, "score", "control_id", "match_score", "distance"), 9)


def j3_matched_union(spark, path):
    return rounded(matching.matched_sample(_pairs(spark, path)), 9)


def j4_effect(spark, path):
    return rounded(matching.matched_effect(_pairs(spark, path)))


def j4_propensity_effect(spark, path):
    """The effect on pairs matched by the fitted score."""
    return rounded(matching.matched_effect(_fitted_pairs(spark, path)))


def j5_score_hist(spark, path):
    rows = materialise(_scored(spark, path, TIED_SCORE).select(ID, ARM, OUT, "score"), "scores")
    return rounded(matching.score_histograms(rows, materialise(matching.matched_pairs(rows, "score"), "pairs"), "score"))


def j2_propensity_match(spark, path):
    return rounded(_fitted_pairs(spark, path).select(ID, "score", "control_id", "match_score", "distance"), 6)


def j5_propensity_hist(spark, path):
    rows = materialise(_propensity(spark, path).select(ID, ARM, OUT, "Propensity_Score"), "propensity")
    pairs = materialise(matching.matched_pairs(rows, "Propensity_Score"), "pairs")
    return rounded(matching.score_histograms(rows, pairs, "Propensity_Score"))


VALUE = [AMT, "Frequency_of_Purchase", SAT]


def _valued(spark, path, *more):
    return value.lifetime_value(retail_orders(spark, path, [*VALUE, *more]))


def l1_clv(spark, path):
    return rounded(_valued(spark, path, ID).select(ID, "Churn_Rate", "CLV"))


def l2_mean(spark, path):
    return rounded(value.mean_value(_valued(spark, path)))


def l3_segment(spark, path):
    return rounded(value.value_segments(_valued(spark, path, ID)).select(ID, "CLV", "CLV_Segment"))


def l4_box(spark, path):
    return rounded(value.segment_box(value.value_segments(_valued(spark, path))))


def l5_high(spark, path):
    return value.high_value_size(value.value_segments(_valued(spark, path)))


def i1_best_channel(spark, path):
    return rounded(value.best_by_amount(retail_orders(spark, path, ["Purchase_Channel", AMT]), "Purchase_Channel"))


def i2_loyalty_effect(spark, path):
    return rounded(value.loyalty_effect(retail_orders(spark, path, ["Customer_Loyalty_Program_Member", SAT])))


def i3_best_influence(spark, path):
    orders = retail_orders(spark, path, ["Social_Media_Influence", AMT])
    return rounded(value.best_by_amount(orders, "Social_Media_Influence"))


def _insights(spark, path, pairs):
    orders = retail_orders(
        spark, path, ["Purchase_Channel", AMT, "Customer_Loyalty_Program_Member", SAT, "Social_Media_Influence"]
    )
    effect = matching.matched_effect(pairs)
    return value.insights(orders, effect, value.value_segments(_valued(spark, path)))


def i4_insights(spark, path):
    """The printed insights, with the effect on pairs matched by the fitted score."""
    return _insights(spark, path, _fitted_pairs(spark, path))


def i4_insights_tied(spark, path):
    """The same with a score that both engines compute alike."""
    return _insights(spark, path, _pairs(spark, path))


def i5_research_corr(spark, path):
    return rounded(value.research_correlation(retail_orders(spark, path, ["Research_Hours", SAT])))


def i5_best_category(spark, path):
    return rounded(value.best_category(retail_orders(spark, path, ["Purchase_Category", AMT])))


QUERIES = {
    f.__name__: f
    for f in [
        t1_mannwhitney, t1_mannwhitney_amount, t2_ttest, t3_cohens_d, t4_ks, j1_propensity, j2_nearest_match,
        j2_nearest_match_dense, j3_matched_union, j4_effect, j4_propensity_effect, j5_score_hist, j2_propensity_match, j5_propensity_hist, l1_clv, l2_mean,
        l3_segment, l4_box, l5_high, i1_best_channel, i2_loyalty_effect, i3_best_influence, i4_insights, i4_insights_tied,
        i5_research_corr, i5_best_category,
    ]
}

# Tail areas by Simpson's rule: 4000 steps over [start, start + width].
_STEPS = """(SELECT i, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(4001) r(i))"""


def _normal_tail(z):
    return f"""(SELECT least(1.0, 2 * sum(w * exp(-pow({z} + i * 0.003, 2) / 2)) * 0.001 / sqrt(2 * pi())) FROM {_STEPS})"""


def _student_tail(t, df):
    density = (f"exp(lgamma(({df} + 1) / 2.0) - lgamma({df} / 2.0) - 0.5 * ln({df} * pi()) "
               f"- ({df} + 1) / 2.0 * ln(1 + pow(abs({t}) + i * 0.003, 2) / {df}))")
    return f"(SELECT 2 * sum(w * {density}) * 0.001 FROM {_STEPS})"


def _rank_sql(column):
    return over_orders(
        f"""SELECT n_yes, n_no, round(mean_yes, 6) AS mean_yes, round(mean_no, 6) AS mean_no, u AS u_statistic,
        round(z, 6) AS z, round({_normal_tail('z')}, 6) AS p_value,
        CASE WHEN {_normal_tail('z')} < 0.05 THEN '{stats.RANK_VERDICT[0]}' ELSE '{stats.RANK_VERDICT[1]}' END AS verdict
        FROM (SELECT *, (greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5)
                 / sqrt(n1 * n0 / 12 * (n1 + n0 + 1 - ties / ((n1 + n0) * (n1 + n0 - 1)))) AS z FROM tests)""",
        f"x AS (SELECT Discount_Used AS g, CAST({column} AS DOUBLE) AS v FROM o WHERE {column} IS NOT NULL)",
        """ranks AS (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mid FROM x)""",
        """tests AS (SELECT count(*) FILTER (WHERE g = 1) AS n_yes, count(*) FILTER (WHERE g = 0) AS n_no,
            avg(v) FILTER (WHERE g = 1) AS mean_yes, avg(v) FILTER (WHERE g = 0) AS mean_no,
            CAST(n_yes AS DOUBLE) AS n1, CAST(n_no AS DOUBLE) AS n0,
            CAST(sum(mid) FILTER (WHERE g = 1) AS DOUBLE) - n1 * (n1 + 1) / 2 AS u,
            (SELECT sum(pow(t, 3) - t) FROM (SELECT CAST(count(*) AS DOUBLE) AS t FROM x GROUP BY v)) AS ties
            FROM ranks)""",
    )


def _normality_sql(column):
    # The normal's share by Simpson's rule over [0, |z|], 400 steps.
    share = """0.5 + sign(z) * abs(z) / 1200 / sqrt(2 * pi()) * list_sum(list_transform(range(401),
        lambda i: CASE WHEN i IN (0, 400) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-pow(z * i / 400, 2) / 2)))"""
    a, b, c, e, f, g = probability.SMALL
    arms = " ".join(f"WHEN far <= {limit} THEN least(1.0, greatest(0.0, {' + '.join(f'{t} * pow(far, {k})' for k, t in enumerate(terms))}))"
                    for limit, terms in probability.LARGE)
    return over_orders(
        f"""SELECT '{column}' AS variable, n, round(d, 6) AS ks_statistic, round(p, 6) AS p_value, p >= {probability.SIGNIFICANCE} AS normal
        FROM (SELECT *, CASE WHEN small <= 0.1 THEN small {arms} ELSE 0 END AS p FROM (
          SELECT *, exp({a} * s * s * (m + {b}) + {c} * s * sqrt(m + {b}) + {e} + {f} / sqrt(m) + {g} / m) AS small,
                 (sqrt(n) - 0.01 + 0.85 / sqrt(n)) * d AS far
          FROM (SELECT n, d, CASE WHEN n <= 100 THEN d ELSE d * pow(n / 100.0, 0.49) END AS s, least(n, 100) AS m FROM
            (SELECT any_value(n) AS n, max(greatest(upto / n - share, share - (upto - rows) / n)) AS d FROM
              (SELECT *, {share} AS share FROM
                (SELECT (x - mean) / sd AS z, rows, n, CAST(sum(rows) OVER (ORDER BY x) AS DOUBLE) AS upto FROM
                  (SELECT CAST({column} AS DOUBLE) AS x, count(*) AS rows FROM o WHERE {column} IS NOT NULL GROUP BY 1),
                  (SELECT count({column}) AS n, avg({column}) AS mean, stddev_samp({column}) AS sd FROM o)))))))""")


_MOMENTS = """m AS (SELECT count(*) FILTER (WHERE g = 1) AS n_yes, count(*) FILTER (WHERE g = 0) AS n_no,
    avg(v) FILTER (WHERE g = 1) AS mean_yes, avg(v) FILTER (WHERE g = 0) AS mean_no,
    sqrt(((n_yes - 1) * var_samp(v) FILTER (WHERE g = 1) + (n_no - 1) * var_samp(v) FILTER (WHERE g = 0))
         / (n_yes + n_no - 2)) AS sd FROM x)"""
_TEST = "tt AS (SELECT *, n_yes + n_no - 2 AS degrees, (mean_yes - mean_no) / (sd * sqrt(1.0 / n_yes + 1.0 / n_no)) AS t FROM m)"
_T_SELECT = f"""n_yes, n_no, round(mean_yes, 6) AS mean_yes, round(mean_no, 6) AS mean_no, degrees,
    round(t, 6) AS t_statistic, round({_student_tail('t', 'degrees')}, 6) AS p_value,
    CASE WHEN {_student_tail('t', 'degrees')} < 0.05 THEN '{stats.MEAN_VERDICT[0]}'
    ELSE '{stats.MEAN_VERDICT[1]}' END AS verdict"""
_ARMS = "x AS (SELECT Discount_Used AS g, Return_Rate AS v FROM o)"


def _solved(n: int, keep: str) -> str:
    """``d0`` to ``d<n-1>`` of a symmetric system ``a<i><j>`` (i <= j), ``b<i>`` in the table ``system``, by elimination row by row."""
    inner = "system"
    cell = lambda i, j: f"a{min(i, j)}{max(i, j)}"
    for p in range(n - 1):
        cells = []
        for i in range(n):
            below = i > p
            cells.append(f"b{i} - a{p}{i} / a{p}{p} * b{p} AS b{i}" if below else f"b{i}")
            cells += [f"a{i}{j} - a{p}{i} / a{p}{p} * a{p}{j} AS a{i}{j}" if below else f"a{i}{j}" for j in range(i, n)]
        inner = f"(SELECT {keep}, {', '.join(cells)} FROM {inner})"
    for i in reversed(range(n)):
        later = "".join(f" - {cell(i, j)} * d{j}" for j in range(i + 1, n))
        inner = f"(SELECT *, (b{i}{later}) / a{i}{i} AS d{i} FROM {inner})"
    return inner


_NEWTON_STEPS = 12
_X = ["1.0::DOUBLE", "x1", "x2", "x3"]
_W = [f"w{i}" for i in range(4)]
_LINE = " + ".join(f"{w} * {x}" for w, x in zip(_W, _X))
_SYSTEM = ", ".join(
    [f"sum(n * (p - y) * {x}){f' + w{i}' if i else ''} AS b{i}" for i, x in enumerate(_X)]
    + [f"sum(n * p * (1 - p) * {a} * {b}){' + 1' if i == j and i else ''} AS a{i}{j}"
       for i, a in enumerate(_X) for j, b in enumerate(_X) if i <= j])
# Rows of a cell share confounders and treatment; each step of the recursion is one Newton step over the cells.
_NEWTON = [
    """confounded AS (SELECT *, CAST(Age AS DOUBLE) AS x1, CAST(dense_rank() OVER (ORDER BY Income_Level) - 1 AS DOUBLE) AS x2,
        CAST(Brand_Loyalty AS DOUBLE) AS x3 FROM o WHERE Age IS NOT NULL AND Income_Level IS NOT NULL AND Brand_Loyalty IS NOT NULL
        AND Discount_Used IS NOT NULL AND Return_Rate IS NOT NULL)""",
    "cells AS (SELECT x1, x2, x3, CAST(Discount_Used AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n FROM confounded GROUP BY ALL)",
    f"""newton AS (SELECT 0 AS step, {', '.join(f'0.0::DOUBLE AS {w}' for w in _W)}
        UNION ALL SELECT step + 1, {', '.join(f'{w} - d{i}' for i, w in enumerate(_W))} FROM {_solved(4, 'step, ' + ', '.join(_W)).replace(
            'FROM system', f"FROM (SELECT step, {', '.join(_W)}, {_SYSTEM} FROM (SELECT *, 1 / (1 + exp(-({_LINE}))) AS p FROM newton, cells WHERE step < {_NEWTON_STEPS}) GROUP BY step, {', '.join(_W)})")})""",
    f"""r AS (SELECT c.*, 1 / (1 + exp(-({_LINE}))) AS score FROM confounded c, newton WHERE step = {_NEWTON_STEPS})""",
]


def _match_ctes(score):
    score = score.replace("D", "")
    return [f"""r AS (SELECT *, ({score})::DOUBLE AS score FROM o WHERE Brand_Loyalty IS NOT NULL)""", *_PAIRS]


_PAIRS = [
    """c AS (SELECT score AS cscore, min(Customer_ID) AS cid FROM r WHERE Discount_Used = 0 GROUP BY score)""",
    """both_sides AS (SELECT t.*, lo.cscore AS lo_score, lo.cid AS lo_id, hi.cscore AS hi_score, hi.cid AS hi_id
            FROM (SELECT * FROM r WHERE Discount_Used = 1) t
            ASOF LEFT JOIN c lo ON t.score >= lo.cscore ASOF LEFT JOIN c hi ON t.score <= hi.cscore)""",
    """pairs AS (SELECT b.Customer_ID, b.score, b.Return_Rate AS outcome,
            CASE WHEN lo_id IS NULL OR hi_score - score < score - lo_score THEN hi_id ELSE lo_id END AS control_id,
            CASE WHEN lo_id IS NULL OR hi_score - score < score - lo_score THEN hi_score ELSE lo_score END AS match_score
            FROM both_sides b)""",
    """full_pairs AS (SELECT pairs.*, oc.Return_Rate AS control_outcome FROM pairs
            JOIN o oc ON oc.Customer_ID = control_id)""",
]
_FITTED = [*_NEWTON, *_PAIRS]


def _match_sql(ctes, digits=9, **options):
    return over_orders(
        f"""SELECT Customer_ID, round(score, {digits}) AS score, control_id, round(match_score, {digits}) AS match_score,
        round(abs(score - match_score), {digits}) AS distance FROM pairs""", *ctes, **options)


def _effect_sql(ctes, **options):
    return over_orders(
        f"SELECT {_T_SELECT}, round(mean_yes - mean_no, 6) AS effect FROM tt", *ctes,
        """x AS (SELECT 1 AS g, outcome AS v FROM full_pairs UNION ALL SELECT 0, control_outcome FROM full_pairs)""",
        _MOMENTS, _TEST, **options)


def _histogram_sql(ctes, **options):
    return over_orders(
        """SELECT e.series, CAST(b.i AS INTEGER) AS bin, round(lo + b.i * w, 6) AS bin_start,
        round(lo + (b.i + 1) * w, 6) AS bin_end,
        (SELECT count(*) FROM series s WHERE s.series = e.series AND least(floor((s.score - lo) / w), 19) = b.i) AS count
        FROM (SELECT series, min(score) AS lo, (max(score) - min(score)) / 20 AS w FROM series GROUP BY series) e,
        range(20) b(i)""", *ctes, _SERIES, **options)


def _insights_sql(ctes, **options):
    return over_orders(
        f"""SELECT 1 AS position, printf({_text(value.CHANNEL_TEXT)}, Purchase_Channel, aov) AS insight
            FROM ({_best('Purchase_Channel', money_avg(), 'aov')})
        UNION ALL SELECT 2, printf({_text(value.LOYALTY_TEXT)}, {_LOYALTY}) FROM o
        UNION ALL SELECT 3, printf({_text(value.SOCIAL_TEXT)}, aov) FROM ({_best('Social_Media_Influence', money_avg(), 'aov')})
        UNION ALL SELECT 4, printf({_text(value.EFFECT_TEXT)}, e,
            CASE WHEN e > 0 THEN {_text(value.EFFECT_UP)} ELSE {_text(value.EFFECT_DOWN)} END)
            FROM (SELECT avg(outcome) - avg(control_outcome) AS e FROM full_pairs)
        UNION ALL SELECT 5, printf({_text(value.VALUE_TEXT)}, count(*)) FROM segmented WHERE CLV_Segment = 'High'""", *ctes, _VALUED, _SEGMENTED, **options)


_SERIES = """series AS (
    SELECT CASE Discount_Used WHEN 1 THEN 'before_treated' ELSE 'before_control' END AS series, score FROM r
    UNION ALL SELECT 'after_treated', score FROM pairs UNION ALL SELECT 'after_control', match_score FROM pairs)"""

CLV = """(Purchase_Amount * Frequency_of_Purchase /
    (CASE WHEN 1.0::DOUBLE - Customer_Satisfaction / 10.0::DOUBLE = 0 THEN 0.05::DOUBLE
     ELSE 1.0::DOUBLE - Customer_Satisfaction / 10.0::DOUBLE END))"""
_VALUED = f"valued AS (SELECT *, {CLV} AS CLV FROM o)"
_SEGMENTED = """segmented AS (SELECT *, CASE WHEN CLV <= a THEN 'Low' WHEN CLV <= b THEN 'Medium' ELSE 'High' END
    AS CLV_Segment FROM valued, (SELECT quantile_cont(CLV, 1.0 / 3) AS a, quantile_cont(CLV, 2.0 / 3) AS b FROM valued))"""


def _best(key, measure, name):
    return f"SELECT {key}, round({measure}, 6) AS {name} FROM o WHERE {key} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"


def _text(sentence: str) -> str:
    """A SQL literal."""
    return "'" + sentence.replace("'", "''") + "'"


_LOYALTY = f"""avg({SAT}) FILTER (WHERE Customer_Loyalty_Program_Member = 1)
    - avg({SAT}) FILTER (WHERE Customer_Loyalty_Program_Member = 0)"""

ORACLE = {
    "t1_mannwhitney": _rank_sql("Return_Rate"),
    "t1_mannwhitney_amount": _rank_sql("Purchase_Amount"),
    "t2_ttest": over_orders(f"SELECT {_T_SELECT} FROM tt", _ARMS, _MOMENTS, _TEST),
    "t3_cohens_d": over_orders(
        "SELECT n_yes, n_no, round((mean_yes - mean_no) / sd, 6) AS cohens_d FROM m", _ARMS, _MOMENTS),
    "j1_propensity": over_orders("SELECT Customer_ID, Discount_Used, round(score, 6) AS Propensity_Score FROM r", *_NEWTON, recursive=True),
    "t4_ks": _normality_sql(AMT),
    "j2_nearest_match": _match_sql(_match_ctes(TIED_SCORE)),
    "j2_nearest_match_dense": _match_sql(_match_ctes(DENSE_SCORE)),
    "j2_propensity_match": _match_sql(_FITTED, 6, recursive=True),
    "j3_matched_union": over_orders(
        """SELECT Customer_ID, 1 AS treated, round(score, 9) AS score, outcome FROM full_pairs
        UNION ALL SELECT control_id, 0, round(match_score, 9), control_outcome FROM full_pairs""",
        *_match_ctes(TIED_SCORE)),
    "j4_effect": _effect_sql(_match_ctes(TIED_SCORE)),
    "j4_propensity_effect": _effect_sql(_FITTED, recursive=True),
    "j5_score_hist": _histogram_sql(_match_ctes(TIED_SCORE)),
    "j5_propensity_hist": _histogram_sql(_FITTED, recursive=True),
    "l1_clv": over_orders(f"""SELECT Customer_ID, round(CLV, 6) AS CLV, round(CASE WHEN {SAT} = 10 THEN 0.05
        ELSE 1.0::DOUBLE - {SAT} / 10.0::DOUBLE END, 6)::DOUBLE AS Churn_Rate FROM valued""", _VALUED),
    "l2_mean": over_orders("SELECT round(avg(CLV), 6) AS mean_clv FROM valued", _VALUED),
    "l3_segment": over_orders("SELECT Customer_ID, round(CLV, 6) AS CLV, CLV_Segment FROM segmented", _VALUED, _SEGMENTED),
    "l4_box": over_orders(box_sql(AMT, "segmented", "CLV_Segment"), _VALUED, _SEGMENTED),
    "l5_high": over_orders("SELECT count(*) AS customers FROM segmented WHERE CLV_Segment = 'High'", _VALUED, _SEGMENTED),
    "i1_best_channel": over_orders(_best("Purchase_Channel", money_avg(), "aov")),
    "i2_loyalty_effect": over_orders(f"SELECT round({_LOYALTY}, 6) AS effect FROM o"),
    "i3_best_influence": over_orders(_best("Social_Media_Influence", money_avg(), "aov")),
    "i4_insights": _insights_sql(_FITTED, recursive=True),
    "i4_insights_tied": _insights_sql(_match_ctes(TIED_SCORE)),
    "i5_research_corr": over_orders(f"SELECT round(corr(Research_Hours, {SAT}), 6) AS r FROM o"),
    "i5_best_category": over_orders(_best("Purchase_Category", money_sum(), "total_revenue")),
}
