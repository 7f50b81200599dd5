"""Partitioned tables on storage.

The partition overwrite mode is set per write: a static overwrite of a table the
same plan reads would delete the files first.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart.storage import materialize, path_exists, remove_path

COMPRESSION = "snappy"


def balanced(df: DataFrame, partition_by: Sequence[str], sort_by: Sequence[str] = ()) -> DataFrame:
    """Few, evenly sized files per partition value.

    A rebalance keeps one date together when it is small and splits it when it is
    large; a plain repartition would send a whole date to one task.
    """
    even = df.hint("rebalance", *partition_by)
    return even.sortWithinPartitions(*partition_by, *sort_by)


def write_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace exactly the partitions ``df`` has rows for; a rerun changes nothing."""
    (
        balanced(df, partition_by, sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", COMPRESSION)
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole feature table."""
    if partition_by:
        df = balanced(df, partition_by)
    writer = df.write.mode("overwrite").option("compression", COMPRESSION)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(
    df: DataFrame, table: str, path: str, buckets: int, key: str,
    partition_by: Sequence[str] = (), sort_by: Sequence[str] = (),
) -> None:
    """Catalog table bucketed by ``key``: joins and groupings on it need no shuffle.

    Spark reads a bucket in one task, so this is for keys none of which dominates.
    """
    even = df.hint("rebalance", buckets, key)
    writer = even.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(*(sort_by or [key])).saveAsTable(table)


def replace_window(existing: DataFrame, recomputed: DataFrame, in_window: Column) -> DataFrame:
    """Delete the rows in the window, insert the recomputed ones."""
    keep = existing.filter(~F.coalesce(in_window, F.lit(False)))
    return keep.unionByName(recomputed.filter(in_window))


def replace_partitions(
    spark: SparkSession, path: str, df: DataFrame, column: str, values: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """Replace the partitions named by ``values``; those that got no row are removed.

    ``df`` may read the table itself.
    """
    place_partitions(spark, path, materialize(df, "partitions"), column, values, sort_by)


def place_partitions(
    spark: SparkSession, path: str, fresh: DataFrame, column: str, values: Sequence[str], sort_by: Sequence[str] = ()
) -> None:
    """The same of rows that lie written elsewhere, without a further copy."""
    write_partitions(fresh, path, [column], sort_by)
    present = {str(r[0]) for r in fresh.select(column).distinct().collect()}
    for value in sorted(set(values) - present):
        remove_path(spark, f"{path}/{column}={value}")


def refresh_window(
    spark: SparkSession, path: str, recomputed: DataFrame, column: str, window: Column
) -> list:
    """The same on storage, for a table partitioned by the date ``column``.

    Writes the recomputed partitions in the window, then drops partitions in
    it that got no row.  Returns the dropped partition values.
    """
    had = _values(spark.read.parquet(path), column, window) if path_exists(spark, path) else set()
    # computed once: the rows are written and their partition values listed
    fresh = materialize(recomputed.filter(window), "window")
    write_partitions(fresh, path, [column])
    # dynamic overwrite leaves partitions alone that got no row
    emptied = sorted(had - _values(fresh, column, window))
    for value in emptied:
        remove_path(spark, f"{path}/{column}={value}")
    return emptied


def _values(df: DataFrame, column: str, window: Column) -> set:
    """Distinct partition values in the window: at most one per day or month."""
    return {r[0] for r in df.filter(window).select(column).distinct().collect()}
