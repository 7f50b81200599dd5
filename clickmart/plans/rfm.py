"""Recency, frequency, monetary metrics, scores and segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import exact_ratio, month_diff
from clickmart.operators import ranking
from clickmart.storage import materialize


def metrics(session_sales: DataFrame, as_of: str) -> DataFrame:
    """Per customer, over session sales rows.

    A session over midnight has two rows and counts once.
    """
    last = F.max("date")
    first_device = F.min(F.struct("date", "session_id", "device_type"))
    return (
        session_sales.groupBy("user_id")
        .agg(
            F.datediff(F.lit(as_of).cast("date"), last).alias("recency_days"),
            F.count_distinct("session_id").alias("frequency"),
            F.sum("total_revenue").cast(S.TOTAL).alias("monetary"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("categories_purchased")))).alias(
                "categories"
            ),
            first_device["device_type"].alias("preferred_device"),
            F.min("date").alias("first_purchase"),
            last.alias("last_purchase"),
        )
        .withColumn("category_diversity", F.size("categories"))
        .withColumn("aov", exact_ratio(F.col("monetary"), F.col("frequency"), S.AVERAGE))
    )


def sale_metrics(sales: DataFrame, as_of: str) -> DataFrame:
    """The same core metrics over sales facts, where one sale id is one purchase."""
    last = F.max("date_key")
    return (
        sales.groupBy("user_id")
        .agg(
            F.datediff(F.lit(as_of).cast("date"), last).alias("recency_days"),
            F.count_distinct("sale_id").alias("frequency"),
            F.sum("total_amount").cast(S.TOTAL).alias("monetary"),
            F.min("date_key").alias("first_purchase"),
            last.alias("last_purchase"),
        )
        .withColumn("aov", exact_ratio(F.col("monetary"), F.col("frequency"), S.AVERAGE))
    )


# with best="high" the last bucket holds the best customers, with "low" the first
_ORDERS = {
    "high": {"recency_score": "desc", "frequency_score": "asc", "monetary_score": "asc"},
    "low": {"recency_score": "asc", "frequency_score": "desc", "monetary_score": "desc"},
}
_MEASURES = {
    "recency_score": "recency_days",
    "frequency_score": "frequency",
    "monetary_score": "monetary",
}


def scores(customer_metrics: DataFrame, best: str = "high", k: int = C.RFM_BUCKETS) -> DataFrame:
    """``ntile(k)`` of each metric, ties by user id, and their sum.

    The metrics are written once, since the ranking reads them three times.
    """
    orders = {score: (_MEASURES[score], way) for score, way in _ORDERS[best].items()}
    stored = materialize(customer_metrics.withColumn(
        "monetary", F.coalesce("monetary", F.lit(0)).cast(S.TOTAL)
    ), "metrics")
    scored = ranking.ntile(stored, k, "user_id", orders)
    total = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_score", total.cast("int"))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins; 5 is best."""
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when(f >= 4, "Loyal")
        .when((r <= 2) & ((f >= 3) | (m >= 3)), "At Risk")
        .when((r >= 4) & (f <= 2), "New")
        .when((r == 1) & (f <= 2) & (m <= 2), "Lost")
        .otherwise("Regular")
    )


def customer_segment(churn_days: int = 180) -> Column:
    return (
        F.when(F.col("recency_days") > churn_days, "Churned")
        .when((F.col("monetary_score") == 5) & (F.col("frequency_score") >= 4), "VIP")
        .when(F.col("frequency") == 1, "New")
        .otherwise("Returning")
    )


def segments(scored: DataFrame, churn_days: int = 180) -> DataFrame:
    """Both segments, for scores with 5 = best."""
    return scored.withColumns(
        {
            "rfm_segment": rfm_segment(
                F.col("recency_score"), F.col("frequency_score"), F.col("monetary_score")
            ),
            "customer_segment": customer_segment(churn_days),
        }
    )


def ltv_formula(customer_metrics: DataFrame, horizon_months: int = C.LTV_HORIZON_MONTHS) -> DataFrame:
    """Mean order value x purchases per active month x horizon.

    One division at the end keeps the value exact:
    monetary / frequency x frequency / months = monetary / months.
    """
    active = month_diff(F.col("first_purchase"), F.col("last_purchase")) + 1
    value = exact_ratio(
        F.col("monetary") * F.lit(horizon_months).cast("decimal(4,0)"),
        F.greatest(active, F.lit(1)).cast("decimal(10,0)"),
        S.TOTAL,
    )
    return customer_metrics.withColumn("active_months", active).withColumn("ltv_12m", value)
