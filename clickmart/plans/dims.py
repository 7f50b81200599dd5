"""Dimension builders."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import event_order
from clickmart.operators import sessions


def dim_date(bounds: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Every day between ``first`` and ``last`` of a one-row table, with its attributes.

    ``holidays`` is an optional list of dates in ``date_key``.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col("first"), F.col("last"), F.expr("interval 1 day"))).alias(
            "date_key"
        )
    )
    if holidays is None:
        days = days.withColumn("is_holiday", F.lit(False))
    else:
        marked = holidays.select("date_key").distinct().withColumn("is_holiday", F.lit(True))
        days = days.join(marked, "date_key", "left").withColumn(
            "is_holiday", F.coalesce("is_holiday", F.lit(False))
        )
    d = F.col("date_key")
    return S.conform(
        days.withColumns(
            {
                "year": F.year(d),
                "quarter": F.quarter(d),
                "month": F.month(d),
                "week": F.weekofyear(d),
                "day": F.dayofmonth(d),
                "day_of_week": F.date_format(d, "EEEE"),
                "is_weekend": F.dayofweek(d).isin(1, 7),
            }
        ),
        S.DIM_DATE,
    )


def date_bounds(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.to_date(F.min(column)).alias("first"), F.to_date(F.max(column)).alias("last")
    )


def margin_pct(price: Column, cost: Column) -> Column:
    return F.try_divide((price - cost) * 100, price).cast(S.MARGIN)


def dim_product(products: DataFrame) -> DataFrame:
    """Product dimension from product attributes; margin where the cost is known."""
    with_defaults = S.conform(products, S.DIM_PRODUCT)
    return with_defaults.withColumns(
        {
            "margin_pct": F.coalesce(
                "margin_pct", margin_pct(F.col("price"), F.col("cost"))
            ),
            "is_active": F.coalesce("is_active", F.lit(True)),
        }
    )


# What is known per key so far.  Minima and maxima only, so states of overlapping
# periods merge to the same result in any order and however often.
_PRODUCT_STATE = {"latest": F.max, "priced": F.max, "created_date": F.min}
_USER_STATE = {"first_seen": F.min, "last_seen": F.max, "place": F.max}


def product_state(events: DataFrame) -> DataFrame:
    """Per product: latest attributes, latest priced event, first day."""
    priced = F.when(F.col("price").isNotNull(), F.struct("event_ts", "event_id", "price"))
    return (
        events.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.max(F.struct("event_ts", "event_id", "category", "brand")).alias("latest"),
            F.max(priced).alias("priced"),
            F.min("date").alias("created_date"),
        )
    )


def user_state(events: DataFrame) -> DataFrame:
    """Per user: first and last day, latest located place."""
    place = F.when(
        F.col("country").isNotNull(), F.struct("event_ts", "event_id", "country", "city")
    )
    return events.groupBy("user_id").agg(
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
        F.max(place).alias("place"),
    )


def _merge(old: DataFrame, new: DataFrame, key: str, parts) -> DataFrame:
    return old.unionByName(new).groupBy(key).agg(
        *[best(column).alias(column) for column, best in parts.items()]
    )


def merge_product_states(old: DataFrame, new: DataFrame) -> DataFrame:
    return _merge(old, new, "product_id", _PRODUCT_STATE)


def merge_user_states(old: DataFrame, new: DataFrame) -> DataFrame:
    return _merge(old, new, "user_id", _USER_STATE)


def products_of_state(state: DataFrame) -> DataFrame:
    return state.select(
        "product_id",
        F.col("latest.category").alias("category"),
        F.col("latest.brand").alias("brand"),
        F.col("priced.price").alias("price"),
        "created_date",
    )


def activity_of_state(state: DataFrame) -> DataFrame:
    return state.select(
        "user_id",
        "first_seen",
        "last_seen",
        F.col("place.country").alias("country"),
        F.col("place.city").alias("city"),
    )


def products_of_events(events: DataFrame) -> DataFrame:
    """Latest category, brand and price per product seen on the events."""
    return products_of_state(product_state(events))


def user_activity(events: DataFrame) -> DataFrame:
    """First and last day per user and the latest located place."""
    return activity_of_state(user_state(events))


def dim_session(events: DataFrame, gap_seconds: float | None = None) -> DataFrame:
    """Session rollup; browser and traffic source have no input and stay null."""
    rollup = (
        sessions.session_rollup(events)
        if gap_seconds is None
        else sessions.session_rollup(events, gap_seconds)
    )
    return S.conform(rollup, S.DIM_SESSION)


def sessions_of_curated(curated: DataFrame) -> DataFrame:
    """The same rollup from events that carry their session, with its start day."""
    views = F.count_if(F.col("event_type") == C.VIEW)
    seconds = F.unix_micros("session_end") - F.unix_micros("session_start")
    session = ["session_id", "user_id", "session_start"]
    # by hash: the device is a key, the first event of each a minimum of numbers
    parts = curated.groupBy(*session, "device_type").agg(
        F.max("event_ts").alias("_last"), views.alias("_views"),
        F.min(event_order(F.col("event_ts"), F.col("event_id"))).alias("_first"),
    )
    rollup = parts.groupBy(*session).agg(
        F.max("_last").alias("session_end"),
        F.sum("_views").cast("int").alias("page_views"),
        F.min(F.struct("_first", "device_type"))["device_type"].alias("device_type"),
    )
    return S.conform(
        rollup.withColumns(
            {
                "duration_secs": F.floor(seconds / 1_000_000).cast("int"),
                "start_date": F.to_date("session_start"),
            }
        ),
        S.DIM_SESSION_STORED,
    )


def sessions_of_intervals(intervals: DataFrame) -> DataFrame:
    """The same rollup from the stored session intervals; no event is read."""
    seconds = F.unix_micros("last_ts") - F.unix_micros("session_start")
    return S.conform(
        intervals.withColumns(
            {
                "session_id": sessions.session_id(),
                "session_end": F.col("last_ts"),
                "duration_secs": F.floor(seconds / 1_000_000).cast("int"),
                "start_date": F.to_date("session_start"),
            }
        ),
        S.DIM_SESSION_STORED,
    )


def dim_customer(activity: DataFrame, scored: DataFrame, ltv: DataFrame) -> DataFrame:
    """All users seen, with scores and value where they bought something.

    ``scored`` has the score and segment columns, ``ltv`` has ``user_id, ltv_12m``.
    """
    joined = activity.join(scored, "user_id", "left").join(ltv, "user_id", "left")
    return S.conform(
        joined.withColumn(
            "customer_segment", F.coalesce("customer_segment", F.lit("New"))
        ),
        S.DIM_CUSTOMER,
    )


def dim_date_between(spark: SparkSession, first: str, last: str) -> DataFrame:
    """A date dimension over fixed bounds."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return dim_date(bounds)
