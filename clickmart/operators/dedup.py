"""Duplicate removal."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# the event hash repeats for two events of one user in one millisecond
EVENT_KEY = ("event_id", "event_type", "product_id")


def dedup(df: DataFrame, keys=EVENT_KEY, order_by=("event_ts",)) -> DataFrame:
    """One row per key, the first by ``order_by`` (ties by the remaining columns).

    A minimum over a struct, so copies collapse before the shuffle even when one
    key holds much of the data.
    """
    order = list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.min(F.struct(*order, *rest)).alias("_first")
    values = {c: F.col(f"_first.{c}").alias(c) for c in [*order, *rest]}
    return df.groupBy(*keys).agg(packed).select(
        *[values.get(c, F.col(c)) for c in df.columns]
    )
