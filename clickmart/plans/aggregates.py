"""Warehouse aggregates and BI views.

Measures are reduced to one row per key before any join, so a frequent key costs
one row, and two facts never multiply each other.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.scalar import exact_ratio, is_purchase, month_diff


def _total(column: str):
    return F.sum(column).cast(S.TOTAL)


def _average(column: str, result_type=S.AVERAGE):
    return exact_ratio(F.sum(column), F.count(column), result_type)


def daily_sales(sales: DataFrame, dates: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, orders, customers and mean sale line per day and category.

    Sales without a known date or product drop out.  Sales are joined once and collapse
    to one row per day, category, order and customer; both distinct counts are taken
    from these rows.
    """
    keys = ["date_key", "category"]
    collapsed = (
        sales.select("date_key", "product_id", "sale_id", "user_id", "total_amount")
        .join(dates.select("date_key"), "date_key")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy(*keys, "sale_id", "user_id")
        .agg(F.sum("total_amount").alias("amount"), F.count("total_amount").alias("lines"))
    )
    return collapsed.groupBy(*keys).agg(
        _total("amount").alias("total_revenue"),
        F.count_distinct("sale_id").alias("total_orders"),
        F.count_distinct("user_id").alias("unique_customers"),
        exact_ratio(F.sum("amount"), F.sum("lines"), S.AVERAGE).alias("avg_order_value"),
    )


def cohorts(sales: DataFrame) -> DataFrame:
    """Active customers, revenue and retention per first-purchase month and period.

    Sales collapse to one row per customer and month first; the first month and
    the distinct count then need no further pass over the sales.
    """
    monthly = (
        sales.withColumn("month", F.trunc("date_key", "MM"))
        .groupBy("user_id", "month")
        .agg(F.sum("total_amount").cast(S.TOTAL).alias("revenue"))
    )
    started = monthly.withColumn(
        "cohort_month", F.min("month").over(W.partitionBy("user_id"))
    )
    cohort = (
        started.withColumn("period", month_diff(F.col("cohort_month"), F.col("month")))
        .groupBy("cohort_month", "period")
        .agg(F.count(F.lit(1)).alias("active_customers"), _total("revenue").alias("revenue"))
    )
    initial = F.first("active_customers").over(W.partitionBy("cohort_month").orderBy("period"))
    return S.conform(
        cohort.withColumn(
            "retention_rate", exact_ratio(F.col("active_customers").cast("decimal(18,0)"), initial, S.RATE)
        ),
        S.AGGR_CUSTOMER_COHORT,
    )


def _sales_by_user(sales: DataFrame) -> DataFrame:
    return sales.groupBy("user_id").agg(
        F.count_distinct("sale_id").alias("total_orders"),
        _total("total_amount").alias("lifetime_spend"),
        F.max("date_key").alias("last_purchase_date"),
        F.count(F.lit(1)).alias("_sale_rows"),
    )


def _events_by_user(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(
        F.count_distinct("event_id").alias("total_events"),
        F.count(F.lit(1)).alias("_event_rows"),
    )


def _customer_join(customers: DataFrame, sales: DataFrame, events: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    return (
        customers.select("user_id", "customer_segment", "ltv_12m", "rfm_segment")
        .join(_sales_by_user(sales), "user_id", "left")
        .join(_events_by_user(events), "user_id", "left")
        .withColumn("total_orders", F.coalesce("total_orders", zero))
        .withColumn("total_events", F.coalesce("total_events", zero))
    )


_CUSTOMER_360 = (
    "user_id", "customer_segment", "ltv_12m", "rfm_segment", "total_orders",
    "lifetime_spend", "last_purchase_date", "total_events",
)


def customer_360(customers: DataFrame, sales: DataFrame, events: DataFrame) -> DataFrame:
    """Orders, spend, last purchase and events per customer."""
    return _customer_join(customers, sales, events).select(*_CUSTOMER_360)


def customer_360_literal(customers: DataFrame, sales: DataFrame, events: DataFrame) -> DataFrame:
    """The view as a join of both facts would give it: spend counts once per event.

    The product of rows is computed, not built.
    """
    joined = _customer_join(customers, sales, events)
    per_event = F.greatest(F.coalesce("_event_rows", F.lit(0)), F.lit(1)).cast("decimal(18,0)")
    return joined.withColumn(
        "lifetime_spend", (F.col("lifetime_spend") * per_event).cast(S.TOTAL)
    ).select(*_CUSTOMER_360)


def product_performance(products: DataFrame, sales: DataFrame) -> DataFrame:
    """Units, revenue, buyers and mean price per product; unsold products stay, with nulls."""
    sold = sales.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        _total("total_amount").alias("total_revenue"),
        F.count_distinct("user_id").alias("unique_buyers"),
        _average("unit_price").alias("avg_selling_price"),
    )
    return (
        products.select("product_id", "product_name", "category", "brand")
        .join(sold, "product_id", "left")
        .withColumn("unique_buyers", F.coalesce("unique_buyers", F.lit(0).cast("bigint")))
    )


def daily_category_metrics(curated: DataFrame) -> DataFrame:
    """Events, users, purchase revenue and mean purchase per date and category."""
    bought = is_purchase(F.col("event_type"))
    price = F.when(bought, F.col("price"))
    return S.conform(
        curated.groupBy("date", "category").agg(
            F.count(F.lit(1)).alias("event_count"),
            F.count_distinct("user_id").alias("unique_users"),
            F.sum(F.when(bought, F.col("price")).otherwise(0)).alias("revenue"),
            exact_ratio(F.sum(price), F.count(price), S.AVERAGE).alias("avg_order_value"),
        ),
        S.DAILY_CATEGORY_METRICS,
    )


def revenue_by_month(
    sales: DataFrame, dates: DataFrame, products: DataFrame, year: int | None = None
) -> DataFrame:
    """Revenue and buyers per year, month and category, ordered by month and revenue.

    A ``year`` filters the date dimension, which prunes a fact partitioned by date.
    """
    days = dates.select("date_key", "year", "month")
    if year is not None:
        days = days.filter(F.col("year") == year)
    return (
        sales.select("date_key", "product_id", "user_id", "total_amount")
        .join(days, "date_key")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("year", "month", "category")
        .agg(
            _total("total_amount").alias("revenue"),
            F.count_distinct("user_id").alias("unique_buyers"),
        )
        .orderBy("year", "month", F.desc("revenue"))
    )


def customer_activity(events: DataFrame, factor: str) -> DataFrame:
    """Event count, spend (0 for none) and the baseline value spend x ``factor``."""
    spend = F.coalesce(F.sum("price"), F.lit(0)).cast(S.TOTAL)
    return (
        events.groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("frequency"), spend.alias("monetary"))
        .withColumn(
            "predicted_ltv",
            (F.col("monetary") * F.lit(factor).cast("decimal(6,3)")).cast("decimal(38,3)"),
        )
    )


def create_views(
    customers: DataFrame, products: DataFrame, sales: DataFrame, events: DataFrame
) -> None:
    """Register both BI views for SQL users."""
    customer_360(customers, sales, events).createOrReplaceTempView("vw_customer_360")
    product_performance(products, sales).createOrReplaceTempView("vw_product_performance")
