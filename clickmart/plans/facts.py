"""Fact builders over curated events."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.scalar import is_purchase
from clickmart.operators.integrity import with_defaults

SALE_DEFAULTS = {"quantity": 1, "discount_amount": 0}


def total_amount(quantity: Column, unit_price: Column, discount: Column, tax: Column) -> Column:
    """quantity x price - discount + tax; discount and tax count 0 when null."""
    zero = F.lit(0).cast(S.PRICE)
    return (quantity * unit_price - F.coalesce(discount, zero) + F.coalesce(tax, zero)).cast(
        S.AMOUNT
    )


def fact_sales(curated: DataFrame) -> DataFrame:
    """One sale per purchase event: quantity 1, no discount, tax unknown."""
    sales = curated.filter(is_purchase(F.col("event_type"))).select(
        F.col("event_id").alias("sale_id"),
        "session_id",
        "user_id",
        "product_id",
        F.col("date").alias("date_key"),
        "hour",
        F.col("price").alias("unit_price"),
    )
    filled = with_defaults(sales, SALE_DEFAULTS)
    amount = total_amount(
        F.col("quantity").cast("int"),
        F.col("unit_price"),
        F.col("discount_amount").cast(S.PRICE),
        F.lit(None).cast(S.PRICE),
    )
    return S.conform(filled.withColumn("total_amount", amount), S.FACT_SALES)


def fact_user_events(curated: DataFrame) -> DataFrame:
    return S.conform(
        curated.withColumnsRenamed({"date": "date_key", "event_ts": "event_timestamp"}),
        S.FACT_USER_EVENTS,
    )
