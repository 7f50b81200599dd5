"""Stateless enrichment of raw events, for batches and streams alike."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import event_hash
from clickmart.operators import geo


def enrich(raw: DataFrame, places: geo.Places, source: str = C.STREAM_SOURCE) -> DataFrame:
    """Place from the address, hashed event id, processing time, lineage.

    Unreadable lines are left to the reject sink; a payload with fields beyond the
    schema travels along as text.
    """
    if S.CORRUPT in raw.columns:
        raw = raw.filter(F.col(S.CORRUPT).isNull())
    if S.PAYLOAD not in raw.columns:
        raw = raw.withColumn(S.PAYLOAD, F.lit(None).cast("string"))
    located = geo.locate(
        raw.withColumn("ip_address", F.coalesce("ip_address", F.lit(""))), places
    )
    return located.withColumns(
        {
            "event_id": event_hash(F.col("user_id"), F.col("timestamp")),
            "processed_ts": F.current_timestamp(),
            "source": F.lit(source),
        }
    ).select(*S.ENRICHED_EVENT.names)


def json_lines(df: DataFrame) -> DataFrame:
    """Each row as one JSON text in ``value``."""
    return df.select(F.to_json(F.struct("*")).alias("value"))
