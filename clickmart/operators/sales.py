"""Purchases per session."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import event_order, is_purchase
from clickmart.operators import sessions


def _purchase_aggs():
    bought = is_purchase(F.col("event_type"))
    order = event_order(F.col("event_ts"), F.col("event_id"))
    return [
        F.sum(F.when(bought, F.col("price"))).alias("_revenue"),
        F.count_if(bought).alias("_items"),
        F.min(F.when(bought, order)).alias("_first"),
    ]


def _of_purchases(events: DataFrame) -> DataFrame:
    """``events`` with ``_category`` and ``_device``, null unless something was bought.

    As keys they keep the aggregation of events on numbers, which Spark does by hash; other events
    of a cell stay one row.
    """
    bought = is_purchase(F.col("event_type"))
    return events.withColumns({
        "_category": F.when(bought, F.col("category")), "_device": F.when(bought, F.col("device_type")),
    })


def _collected() -> list:
    """Measures of a session from rows per category and device."""
    first = F.when(F.col("_first").isNotNull(), F.struct("_first", "_device"))
    return [
        F.sum("_revenue").cast(S.TOTAL).alias("total_revenue"),
        F.sum("_items").alias("items_purchased"),
        F.collect_set("_category").alias("_categories"),
        F.min(first)["_device"].alias("device_type"),
    ]


def session_sales(
    events: DataFrame,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Revenue, item count, categories and first device per (session, user, date).

    One scan: the purchase measures ride on the session cells, so no event is
    shuffled unaggregated.
    """
    rows = sessions.cells(
        _of_purchases(events), gap_seconds, _purchase_aggs(), keys=["date", "_category", "_device"]
    )
    numbered = sessions.number_sessions(rows, gap_seconds, carry).filter(F.col("_items") > 0)
    return _finish(
        numbered.groupBy("user_id", "session_seq", "session_start", "date")
        .agg(*_collected())
        .withColumn("session_id", sessions.session_id())
    )


def sales_of_sessions(curated: DataFrame) -> DataFrame:
    """The same result from events that already carry their session."""
    session = ["session_id", "user_id", "date"]
    rows = (
        _of_purchases(curated.filter(is_purchase(F.col("event_type"))))
        .groupBy(*session, "_category", "_device")
        .agg(*_purchase_aggs())
    )
    return _finish(rows.groupBy(*session).agg(*_collected()))


def _finish(df: DataFrame) -> DataFrame:
    categories = F.sort_array("_categories")
    return S.conform(df.withColumn("categories_purchased", categories), S.SESSION_SALES)
