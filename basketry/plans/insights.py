"""Peak facts (C18), growth statements (C12, W4/F14), business insights (C10).

Every input here is already an aggregate with a bounded row count (months,
weekdays, categories, segments); facts are picked with top-1 sorts and the
sentences are built with ``format_string`` on 1-row frames, so nothing is
collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.rank import argmax, argmin, extreme_rows
from basketry.plans.segments import AT_RISK
from basketry.operators.scalar import combine


def peak_facts(monthly: DataFrame, revenue_by_category: DataFrame, quarterly: DataFrame,
               dash_weekday: DataFrame, dash_category: DataFrame, sizes: DataFrame,
               pref: DataFrame, pattern: DataFrame) -> DataFrame:
    """(fact, key, value) rows.  Weekday ties go to the earlier day of the week
    (``_pos``), other ties to the smallest key.  ``dash_category`` holds the
    per-category totals of the month x category table (rolled up exactly from
    the decimal amounts, not by re-adding rounded month sums)."""
    out = extreme_rows(monthly, [("peak_month", "revenue", ["year_month"], "year_month", True),
                                 ("slowest_month", "revenue", ["year_month"], "year_month", False)])
    pair = F.concat_ws(" / ", F.col("segment"), F.col("favorite_category"))
    for df, spec in [
        (revenue_by_category, ("top_category", "revenue", ["category"], "category", True)),
        (quarterly, ("peak_quarter", "revenue", ["year", "quarter"], "label", True)),
        (dash_weekday, ("peak_weekday", "revenue", ["_pos"], "weekday", True)),
        (dash_category, ("strongest_category", "revenue", ["category"], "category", True)),
        (sizes, ("largest_segment", "customers", ["segment"], "segment", True)),
        (pref, ("top_segment_category", "customers", ["segment", "favorite_category"], pair, True)),
        (pattern, ("busiest_purchase_day", "orders", ["_pos"], "weekday", True)),
    ]:
        out = out.unionByName(extreme_rows(df, [spec]))
    return out


def growth(series: DataFrame, label: str, period: str, value: str) -> DataFrame:
    """First-to-last change of an ordered series: 1 row with label, points,
    start/end values, direction (stable < 2 points, increased, fell, flat)
    and the change in percent (0 when the start is 0; a fall is positive)."""
    agg = series.where(F.col(value).isNotNull()).groupBy().agg(
        F.count(F.lit(1)).alias("points"),
        F.min_by(F.col(value).cast("double"), F.col(period)).alias("start_value"),
        F.max_by(F.col(value).cast("double"), F.col(period)).alias("end_value"))
    s, e = F.col("start_value"), F.col("end_value")
    direction = (F.when(F.col("points") < 2, "stable").when(e > s, "increased")
                  .when(e < s, "fell").otherwise("flat"))
    change = (F.when(F.col("points") < 2, F.lit(None).cast("double"))
               .when(s == 0, F.lit(0.0))
               .when(e > s, (e - s) / s * 100)
               .when(e < s, (s - e) / s * 100)
               .otherwise(F.lit(0.0)))
    return agg.select(F.lit(label).alias("label"), "points", "start_value", "end_value",
                      direction.alias("direction"), change.alias("change_pct"))


# Growth sentence templates (label, change %, start, end).
GROWTH_TEXT = {
    "stable": "%s is stable right now; keep monitoring and protect current conversion rates.",
    "increased": "%s increased by %s%% from %s to %s. Lean into the best-performing channels and protect that momentum.",
    "fell": "%s fell by %s%% from %s to %s. Review promotions, acquisition, and product availability to recover performance.",
    "flat": "%s stayed flat. Keep the current plan steady while tracking seasonality closely.",
}


def fixed(col, digits: int):
    """Fixed-point text with 0 or 1 digits, rounded as the reference rounds: on the exact binary value (0.35 is stored
    a little below and gives 0.3), ties to even.

    2 * 10^digits * x is taken without error: doubling is exact, and 20x = 16x + 4x is a sum of two exact terms
    whose rounding error is known.  Beyond 2^48 a double has no digits to round."""
    if digits not in (0, 1):
        raise ValueError("0 or 1 digits")
    c = (F.col(col) if isinstance(col, str) else col).cast("double")
    x = F.abs(c)
    if digits:
        p, q = x * 16.0, x * 4.0
        s = p + q
        err = (p - (s - (s - p))) + (q - (s - p))
    else:
        s, err = x * 2.0, F.lit(0.0)
    low = F.floor(s / 2.0)
    rest = s - low.cast("double") * 2.0
    up = (rest > 1.0) | ((rest == 1.0) & ((err > 0) | ((err == 0) & (low % 2 == 1))))
    n = low + F.when(up, 1).otherwise(0)
    text = n.cast("string") if not digits else F.concat(F.floor(n / 10).cast("string"), F.lit("."), (n % 10).cast("string"))
    sign = F.when((c < 0) | (c.cast("string") == "-0.0"), F.lit("-")).otherwise(F.lit(""))
    return F.when(x < float(2 ** 48), F.concat(sign, text)).when(c.isNotNull(), F.format_string(f"%.{digits}f", c))


def growth_statements(g: DataFrame) -> DataFrame:
    pct = fixed("change_pct", 1)
    start = F.format_number(F.col("start_value"), 0)
    end = F.format_number(F.col("end_value"), 0)
    text = (F.when(F.col("direction") == "stable", F.format_string(GROWTH_TEXT["stable"], F.col("label")))
             .when(F.col("direction") == "increased",
                   F.format_string(GROWTH_TEXT["increased"], F.col("label"), pct, start, end))
             .when(F.col("direction") == "fell",
                   F.format_string(GROWTH_TEXT["fell"], F.col("label"), pct, start, end))
             .otherwise(F.format_string(GROWTH_TEXT["flat"], F.col("label"))))
    return g.select("label", text.alias("text"))


# Insight sentence templates.
INSIGHT_TEXT = [
    "'%s' make up %s%% of customers but drive %s%% of revenue — prioritize retention "
    "(loyalty perks, early access) for this group.",
    "'At Risk / Inactive Customers' have an average recency of %s days since last purchase. "
    "Recommend win-back email/SMS campaigns with targeted discounts before they churn permanently.",
    "'%s' is the top revenue-generating category — ensure sufficient inventory and feature it in "
    "homepage promotions and paid campaigns.",
    "Revenue peaked in %s (%s) likely driven by festive/seasonal demand, while %s was the slowest (%s). "
    "Plan inventory and marketing spend around this seasonality.",
    "Overall return rate is %s%%. Investigate top-returned categories/products to reduce "
    "reverse-logistics costs and improve product-page accuracy.",
    "Price Sensitive Customers respond strongly to discounts — target them with coupon codes and flash "
    "sales rather than full-price promotions to improve conversion without eroding margin elsewhere.",
    "Personalize marketing using the %s-feature RFM + behavioral segmentation model: match campaign "
    "messaging, channel, and offer type to each segment's actual behavior instead of a "
    "one-size-fits-all blast.",
]


def insights(summary: DataFrame, revenue_by_category: DataFrame, monthly: DataFrame,
             kpis: DataFrame, n_features: int = 7) -> DataFrame:
    """(n, text): seven sentences from the segment summary, category ranking,
    monthly trend and KPIs."""
    hv = argmax(summary, "avg_monetary", "segment")
    risk = summary.where(F.col("segment") == AT_RISK).groupBy().agg(
        F.coalesce(F.first("avg_recency_days"), F.lit(0.0)).alias("r"))
    top = argmax(revenue_by_category, "revenue", "category")
    best = argmax(monthly, "revenue", "year_month").select(
        F.col("year_month").alias("bm"), F.col("revenue").alias("br"))
    worst = argmin(monthly, "revenue", "year_month").select(
        F.col("year_month").alias("wm"), F.col("revenue").alias("wr"))
    one = kpis.select("return_rate_overall")
    rows = [
        hv.select(F.format_string(INSIGHT_TEXT[0], "segment", F.col("pct_of_customers").cast("string"),
                                  F.col("pct_of_revenue").cast("string")).alias("text")),
        risk.select(F.format_string(INSIGHT_TEXT[1], fixed("r", 0)).alias("text")),
        top.select(F.format_string(INSIGHT_TEXT[2], "category").alias("text")),
        combine(best, worst).select(F.format_string(
            INSIGHT_TEXT[3], "bm", F.format_number("br", 0), "wm", F.format_number("wr", 0)).alias("text")),
        one.select(F.format_string(INSIGHT_TEXT[4], fixed(
            F.col("return_rate_overall") * 100, 1)).alias("text")),
        one.select(F.lit(INSIGHT_TEXT[5]).alias("text")),
        one.select(F.format_string(INSIGHT_TEXT[6], F.lit(str(n_features))).alias("text")),
    ]
    out = None
    for i, r in enumerate(rows, 1):
        r = r.select(F.lit(i).alias("n"), "text")
        out = r if out is None else out.unionByName(r)
    return out
