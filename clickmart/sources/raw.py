"""Raw zone readers, batch and stream."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart import schemas as S


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(S.CORRUPT, T.StringType())])


def _lines(text: DataFrame, schema: T.StructType) -> DataFrame:
    return decode(text.filter(F.trim("value") != ""), "value", schema=schema)


def read_raw(spark: SparkSession, path: str, schema: T.StructType = S.ENRICHED_EVENT) -> DataFrame:
    """JSON lines with a fixed schema; unreadable lines land in ``_corrupt``.

    Every line is parsed with the whole schema, so the same lines are unreadable
    whichever columns a query uses.  Hive-style ``year=/month=/day=`` folders
    become columns, and a filter on them prunes files.
    """
    return _lines(spark.read.text(path), schema)


def read_files(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType = S.ENRICHED_EVENT
) -> DataFrame:
    """The same of listed files, which may be none."""
    text = spark.read.text(list(paths)) if paths else spark.createDataFrame([], "value string")
    return _lines(text.select("value"), schema)


def stream_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType = S.RAW_EVENT,
    max_files: int | None = None,
    max_bytes: int | str | None = None,
) -> DataFrame:
    """The same reader as a file stream; a batch takes up to so many files or bytes."""
    reader = spark.readStream.schema("value string")
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(path), schema)


def stream_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int | None = None
) -> DataFrame:
    """Broker stream from the latest offset; the payload column is ``data``."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "latest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select(F.col("value").cast("string").alias("data"))


def decode(
    records: DataFrame,
    data: str = "data",
    encoded: bool = False,
    schema: T.StructType = S.RAW_EVENT,
) -> DataFrame:
    """JSON payload text, optionally base64, to event columns; other columns stay.

    Broken base64 or JSON leaves the event columns null and the text in ``_corrupt``.
    A payload with fields that ``schema`` lacks is kept as text in ``payload``.
    The parse stands behind a generator, so a later filter does not repeat it.
    """
    text = F.col(data)
    if encoded:
        text = F.try_to_binary(text, F.lit("base64")).cast("string")
    others = [c for c in records.columns if c != data]
    parsed = F.from_json(
        F.col("_text"), _with_corrupt(schema),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT},
    )
    known = F.array(*[F.lit(f.name) for f in schema])
    unknown = F.size(F.array_except(F.json_object_keys("_text"), known)) > 0
    rows = (
        records.select(F.col(data).alias("_data"), text.alias("_text"), *others)
        .select("_data", "_text", *others, F.explode(F.array(parsed)).alias("_e"))
        .withColumn("_bad", F.coalesce(F.col(f"_e.{S.CORRUPT}"), F.when(F.col("_e").isNull(), F.col("_data"))))
    )
    kept = F.when(F.col("_bad").isNull() & unknown, F.col("_text"))
    if S.PAYLOAD in schema.names:  # delivered before: the first payload is the original
        kept = F.coalesce(F.col(f"_e.{S.PAYLOAD}"), kept)
    fields = [f for f in schema.names if f != S.PAYLOAD]
    return rows.select(
        *[F.col(f"_e.{name}").alias(name) for name in fields],
        kept.alias(S.PAYLOAD), F.col("_bad").alias(S.CORRUPT), *others,
    )


def accepted(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(S.CORRUPT).isNull()).drop(S.CORRUPT)


def rejected(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col(S.CORRUPT).isNotNull())


def rejects(raw: DataFrame) -> DataFrame:
    """Lines that are no event, as they came, and why."""
    return rejected(raw).select(F.col(S.CORRUPT).alias("line"), F.lit("unreadable").alias("reason"))


def from_mapping(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Rename foreign columns to the raw event schema.

    ``mapping`` gives, per raw column, a source column name or an expression;
    columns it leaves out are null.
    """
    renamed = df.select(
        *[
            (F.col(src) if isinstance(src, str) else src).alias(name)
            for name, src in mapping.items()
        ]
    )
    return S.conform(renamed, S.RAW_EVENT)


def read_mapped_csv(
    spark: SparkSession, path: str, mapping: Mapping[str, str | Column]
) -> DataFrame:
    return from_mapping(spark.read.option("header", True).csv(path), mapping)


# public click-stream CSV layout: foreign column per raw column
CSV_MAPPING: dict[str, str | Column] = {
    "event_type": "event_type",
    "product_id": "product_id",
    "category": "category_id",
    "brand": "brand",
    "user_id": "user_id",
    "price": "price",
}


def csv_mapping() -> dict[str, str | Column]:
    """``CSV_MAPPING`` plus the text time converted to epoch milliseconds."""
    stamp = F.try_to_timestamp(
        F.regexp_replace("event_time", r" UTC$", ""), F.lit("yyyy-MM-dd HH:mm:ss")
    )
    return {**CSV_MAPPING, "timestamp": F.unix_millis(stamp)}
