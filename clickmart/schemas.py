"""Schemas of every zone.

Money columns keep the scale of the warehouse contract.  Sums are widened to 38
digits: at tens of terabytes a daily revenue no longer fits 14 digits, and an
overflow would fail the job.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
AMOUNT = T.DecimalType(12, 2)
TOTAL = T.DecimalType(38, 2)
AVERAGE = T.DecimalType(18, 2)
RATE = T.DecimalType(5, 4)
MARGIN = T.DecimalType(5, 2)

CORRUPT = "_corrupt"
# the original text of an event that has fields beyond the schema
PAYLOAD = "payload"


_TYPES = {
    "string": T.StringType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "array<string>": T.ArrayType(T.StringType()),
    "price": PRICE,
    "amount": AMOUNT,
    "total": TOTAL,
    "average": AVERAGE,
    "rate": RATE,
    "margin": MARGIN,
}


def _struct(columns: str) -> T.StructType:
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_EVENT = _struct(
    "event_id string, user_id string, session_id string, product_id string, "
    "event_type string, price string, timestamp bigint, category string, "
    "brand string, device_type string, ip_address string"
)

# written by the enrichment stream: the raw event plus place and lineage
ENRICHED_EVENT = T.StructType(
    RAW_EVENT.fields
    + _struct(
        "country string, city string, processed_ts timestamp, source string, payload string"
    ).fields
)

CURATED_EVENT = _struct(
    "event_id string, user_id string, client_session_id string, product_id string, "
    "event_type string, price price, event_ts timestamp, category string, "
    "brand string, device_type string, ip_address string, country string, city string, "
    "processed_ts timestamp, hour int, session_seq bigint, session_start timestamp, "
    "session_id string, date date"
)

SESSION_SALES = _struct(
    "session_id string, user_id string, total_revenue total, "
    "items_purchased bigint, categories_purchased array<string>, device_type string, date date"
)

CUSTOMER_LTV = _struct(
    "user_id string, recency_days int, frequency bigint, monetary total, "
    "rfm_score int, predicted_ltv_12m double, preferred_device string"
)

PRODUCT_RECOMMENDATIONS = _struct(
    "user_id string, recommended_product_id string, predicted_rating double"
)

DIM_CUSTOMER = _struct(
    "user_id string, first_seen date, last_seen date, registration_date date, "
    "customer_segment string, preferred_device string, country string, city string, "
    "ltv_12m total, recency_score smallint, frequency_score smallint, "
    "monetary_score smallint, rfm_segment string"
)

DIM_PRODUCT = _struct(
    "product_id string, product_name string, category string, subcategory string, "
    "brand string, price price, cost price, margin_pct margin, "
    "is_active boolean, created_date date"
)

DIM_DATE = _struct(
    "date_key date, year smallint, quarter smallint, month smallint, week smallint, "
    "day smallint, day_of_week string, is_weekend boolean, is_holiday boolean"
)

DIM_SESSION = _struct(
    "session_id string, user_id string, session_start timestamp, session_end timestamp, "
    "duration_secs int, page_views int, device_type string, browser string, traffic_source string"
)

# stored by the day a session starts
DIM_SESSION_STORED = T.StructType(DIM_SESSION.fields + _struct("start_date date").fields)

# state of the curated zone, stored by the day a session ends so far
SESSION_INTERVAL = _struct(
    "user_id string, session_start timestamp, last_ts timestamp, session_seq bigint, "
    "page_views bigint, first_id string, device_type string, last_date date"
)

FACT_SALES = _struct(
    "sale_id string, session_id string, user_id string, product_id string, date_key date, "
    "hour smallint, quantity int, unit_price price, total_amount amount, "
    "discount_amount price, tax_amount price, payment_method string"
)

FACT_USER_EVENTS = _struct(
    "event_id string, session_id string, user_id string, product_id string, date_key date, "
    "event_timestamp timestamp, event_type string, category string, brand string, "
    "device_type string"
)

AGGR_DAILY_SALES = _struct(
    "date_key date, category string, total_revenue total, total_orders bigint, "
    "unique_customers bigint, avg_order_value average"
)

AGGR_CUSTOMER_COHORT = _struct(
    "cohort_month date, period int, active_customers bigint, revenue total, "
    "retention_rate rate"
)

DAILY_CATEGORY_METRICS = _struct(
    "date date, category string, event_count bigint, unique_users bigint, "
    "revenue total, avg_order_value average"
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` on ``schema``: cast what is there, null for what is missing."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
