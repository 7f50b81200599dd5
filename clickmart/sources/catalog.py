"""Databases and external tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickmart import schemas as S
from clickmart.storage import path_exists

# table -> (schema, format, partition columns, folder)
TABLES = {
    "raw_events": (S.ENRICHED_EVENT, "json", ("year", "month", "day"), "raw/events"),
    "curated_events": (S.CURATED_EVENT, "parquet", ("date",), "curated/events"),
    "curated_sales": (S.SESSION_SALES, "parquet", ("date",), "curated/sales"),
    "customer_ltv": (
        S.CUSTOMER_LTV, "parquet", ("preferred_device",), "features/customer_ltv",
    ),
    "product_recommendations": (
        S.PRODUCT_RECOMMENDATIONS, "parquet", (), "features/recommendations",
    ),
    "daily_category_metrics": (
        S.DAILY_CATEGORY_METRICS, "parquet", ("date",), "mv/daily_category",
    ),
    "aggr_daily_sales": (
        S.AGGR_DAILY_SALES, "parquet", ("date_key",), "warehouse/aggr_daily_sales",
    ),
    "aggr_customer_cohort": (
        S.AGGR_CUSTOMER_COHORT, "parquet", ("cohort_month",), "warehouse/aggr_customer_cohort",
    ),
    "fact_sales": (S.FACT_SALES, "parquet", ("date_key",), "warehouse/fact_sales"),
    "fact_user_events": (
        S.FACT_USER_EVENTS, "parquet", ("date_key",), "warehouse/fact_user_events",
    ),
    "dim_customer": (S.DIM_CUSTOMER, "parquet", (), "warehouse/dim_customer"),
    "dim_product": (S.DIM_PRODUCT, "parquet", (), "warehouse/dim_product"),
    "dim_date": (S.DIM_DATE, "parquet", (), "warehouse/dim_date"),
    "dim_session": (S.DIM_SESSION_STORED, "parquet", ("start_date",), "warehouse/dim_session"),
}


def _columns(schema: T.StructType, partitions) -> str:
    fields = {f.name: f.dataType.simpleString() for f in schema}
    ordered = [c for c in fields if c not in partitions] + list(partitions)
    return ", ".join(f"`{c}` {fields.get(c, 'int')}" for c in ordered)


def create_database(
    spark: SparkSession, database: str, location: str, use: bool = True
) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    if use:
        spark.sql(f"USE {database}")


def create_table(spark: SparkSession, database: str, name: str, location: str) -> None:
    """External table over files that may already exist; finds their partitions."""
    schema, fmt, partitions, _ = TABLES[name]
    clause = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{name} ({_columns(schema, partitions)}) "
        f"USING {fmt} {clause} LOCATION '{location}'"
    )
    if partitions and path_exists(spark, location):
        recover(spark, f"{database}.{name}")


def register(spark: SparkSession, database: str, location: str) -> None:
    """Database and all tables, each in its folder below ``location``."""
    create_database(spark, database, f"{location}/database")
    for name, (_, _, _, folder) in TABLES.items():
        create_table(spark, database, name, f"{location}/{folder}")


def recover(spark: SparkSession, table: str) -> None:
    """Pick up partition folders written past the catalog, drop vanished ones."""
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)


def discover(
    spark: SparkSession, database: str, name: str, path: str, fmt: str = "json",
    sampling_ratio: float | None = None,
) -> T.StructType:
    """Infer schema and partitions of a folder and register it as a table.

    Every JSON line takes part in the inference, so no field or type is missed.  A
    ``sampling_ratio`` trades that for speed: fields that the sample lacks are then
    not in the table.
    """
    reader = spark.read
    if sampling_ratio is not None and fmt == "json":
        reader = reader.option("samplingRatio", sampling_ratio)
    found = reader.format(fmt).load(path)
    partitions = _partition_columns(found, path)
    columns = _columns(found.schema, partitions)
    clause = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in partitions)})" if partitions else ""
    spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    spark.sql(
        f"CREATE TABLE {database}.{name} ({columns}) USING {fmt} {clause} LOCATION '{path}'"
    )
    if partitions:
        recover(spark, f"{database}.{name}")
    return found.schema


def _partition_columns(found: DataFrame, path: str) -> list[str]:
    """Names of the nested ``name=value`` folders of all files below ``path``."""
    root = path.rstrip("/").rsplit("/", 1)[-1]
    seen = set()
    for file in found.inputFiles():
        folders = file.split("/")[:-1]
        last = len(folders) - 1 - folders[::-1].index(root) if root in folders else -1
        seen.add(tuple(f.split("=", 1)[0] for f in folders[last + 1 :] if "=" in f))
    if len(seen) > 1:
        raise ValueError(f"folders below {path} are partitioned differently: {sorted(seen)}")
    return list(seen.pop()) if seen else []


def merge_schema(spark: SparkSession, path: str, addition: DataFrame, partition_by=()) -> DataFrame:
    """Append rows whose columns may be new; returns the table with all columns ever seen."""
    addition.write.mode("append").partitionBy(*partition_by).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)
