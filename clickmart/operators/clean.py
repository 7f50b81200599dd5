"""Raw events to typed events."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions import scalar

REQUIRED = ("user_id", "event_type", "event_ts")
CARRIED = ("country", "city", "processed_ts")


def drop_incomplete(df: DataFrame, required=REQUIRED) -> DataFrame:
    return df.dropna(subset=[c for c in required if c in df.columns])


def clean(raw: DataFrame) -> DataFrame:
    """Typed columns, event time, date and hour; rows without user, type or time go.

    A price that is no number becomes null and does not stop the job.
    """
    ids = [F.col(c).cast("string").alias(c) for c in ("event_id", "user_id")]
    typed = raw.select(
        *ids,
        F.col("session_id").cast("string").alias("client_session_id"),
        F.col("product_id").cast("string").alias("product_id"),
        "event_type",
        F.col("price").try_cast(S.PRICE).alias("price"),
        scalar.event_time(F.col("timestamp")).alias("event_ts"),
        "category",
        "brand",
        "device_type",
        "ip_address",
        *[F.col(c) for c in CARRIED if c in raw.columns],
    )
    return drop_incomplete(
        typed.withColumn("date", F.to_date("event_ts")).withColumn("hour", F.hour("event_ts"))
    )
