"""Helpers the text operators share."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import storage

#: words are maximal runs of characters other than space, tab, LF, VT, FF, CR
BREAKS = " \t\n\x0b\x0c\r"
BREAK = r"[\x20\x09-\x0D]+"
NON_BREAK = r"[^\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: drop the shuffle files of a query when it ends
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _write(df: DataFrame, path: str, codec: str) -> None:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` once in the shared folder and return the written table.

    Its shuffle files are dropped with the write, so the disk holds those of one step and
    not of all.
    """
    path = storage.scratch_path(df.sparkSession, label)
    _write(df, path, codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``build``, written; the tables it wrote on the way are removed."""
    path = storage.scratch_path(spark, label)
    with storage.scratch_scope(spark):
        df = build()
        _write(df, path, "snappy")
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """Array of words; empty for null, empty and blank texts."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BREAK), "")


def word_count(text: Column) -> Column:
    """Number of words as long; 0 for null."""
    trimmed = F.btrim(text, F.lit(BREAKS))
    count = F.when(trimmed != "", F.size(F.split(trimmed, BREAK))).otherwise(0)
    return F.coalesce(count, F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def uniform(*columns: Column) -> Column:
    """A double in [0, 1) drawn by a hash of ``columns``; nulls are left out."""
    digits = F.substring(F.md5(F.concat_ws("|", *columns)), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(16**13))


def local_order(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """Rows sorted within their partition, numbered by (partition, row) in ``name``."""
    return df.sortWithinPartitions(*order).withColumn(name, F.monotonically_increasing_id())


def part_of(at: Column) -> Column:
    return F.shiftright(at, _ROW_BITS)


def row_of(at: Column) -> Column:
    return at.bitwiseAND(F.lit(2**_ROW_BITS - 1))


def _numbered(written: DataFrame, name: str) -> DataFrame:
    """Gapless numbers from 0 for a written table with ``_at`` (partition, row).

    The offsets of the partitions, one row for each, make their broadcast bounded.
    """
    counts = written.groupBy(part_of(F.col("_at")).alias("_part")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    return (
        written.withColumn("_part", part_of(F.col("_at")))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + row_of(F.col("_at")))
        .drop("_part", "_before", "_at")
    )


def positions(df: DataFrame, order: Sequence, name: str, label: str) -> DataFrame:
    """``df`` written in global order with gapless positions from 0 in ``name``."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order)
    return _numbered(materialize(local_order(ranged, order, "_at"), label), name)


def numbered(df: DataFrame, name: str, label: str) -> DataFrame:
    """``df`` written as it comes with gapless numbers from 0 in ``name``."""
    return _numbered(materialize(df.withColumn("_at", F.monotonically_increasing_id()), label), name)
