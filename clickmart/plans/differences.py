"""Aggregates kept up to date by signed differences.

A change is a row with ``sign``: 1 for what is new, -1 for what is withdrawn; a correction is both.  Stored is
one row per group and members (user, order) with the number of rows behind it and their sums.  A member leaves
its group when the last of its rows goes, so distinct counts survive corrections and withdrawals, and sums
don't drift.  Only the partitions of the changed groups are read and written.

A run writes the new contents of its partitions first and then replaces them, so one that was cut off is
repeated without adding anything twice.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.scalar import exact_ratio, is_purchase
from clickmart.sinks import tables
from clickmart.storage import path_exists, remove_path


@dataclass(frozen=True)
class Definition:
    """An aggregate over ``keys`` (the first one a date) and ``members``; partitions are days or months of the date."""

    keys: Sequence[str]
    members: Sequence[str]
    sums: Mapping[str, Callable[[], Column]]
    finish: Callable[[DataFrame], DataFrame]
    months: bool = False

    def parts(self, df: DataFrame) -> DataFrame:
        """``df`` with ``part``, the partition of its rows."""
        day = F.col(self.keys[0])
        return df.withColumn("part", F.trunc(day, "MM") if self.months else day)


def _known_sum(name: str, count: str) -> Column:
    """A sum that is null when none of its rows has a value."""
    return F.when(F.sum(count) > 0, F.sum(name))


def _category_metrics(stored: DataFrame) -> DataFrame:
    return S.conform(
        stored.groupBy("date", "category").agg(
            F.sum("_rows").alias("event_count"), F.count(F.lit(1)).alias("unique_users"),
            _known_sum("revenue", "valued").alias("revenue"),
            exact_ratio(F.sum("revenue"), F.sum("sold"), S.AVERAGE).alias("avg_order_value"),
        ),
        S.DAILY_CATEGORY_METRICS,
    )


def _daily_sales(stored: DataFrame) -> DataFrame:
    return S.conform(
        stored.groupBy("date_key", "category").agg(
            _known_sum("amount", "lines").alias("total_revenue"), F.count_distinct("sale_id").alias("total_orders"),
            F.count_distinct("user_id").alias("unique_customers"),
            exact_ratio(F.sum("amount"), F.sum("lines"), S.AVERAGE).alias("avg_order_value"),
        ),
        S.AGGR_DAILY_SALES,
    )


def _bought(value: Column) -> Column:
    return F.when(is_purchase(F.col("event_type")), value).otherwise(0)


#: over curated events
CATEGORY_METRICS = Definition(
    ("date", "category"), ("user_id",),
    {
        "revenue": lambda: _bought(F.coalesce("price", F.lit(0))),
        "valued": lambda: (~is_purchase(F.col("event_type")) | F.col("price").isNotNull()).cast("bigint"),
        "sold": lambda: _bought(F.col("price").isNotNull().cast("bigint")),
    },
    _category_metrics,
)
#: over sales with their category
DAILY_SALES = Definition(
    ("date_key", "category"), ("sale_id", "user_id"),
    {
        "amount": lambda: F.coalesce("total_amount", F.lit(0)),
        "lines": lambda: F.col("total_amount").isNotNull().cast("bigint"),
    },
    _daily_sales,
    months=True,
)


class Maintained:
    """A stored aggregate: ``rows`` per group and members, and the ``view``."""

    def __init__(self, spark: SparkSession, root: str, what: Definition):
        self.spark, self.root, self.what = spark, root, what

    def _ended(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.root}/{name}/_SUCCESS")

    def _merged(self, changes: DataFrame, touched: list) -> DataFrame:
        """New contents of the partitions ``touched`` by ``changes``."""
        group = ["part", *self.what.keys, *self.what.members]
        sums = [F.sum(F.col("sign") * expr()).alias(name) for name, expr in self.what.sums.items()]
        delta = changes.groupBy(*group).agg(F.sum(F.col("sign").cast("bigint")).alias("_rows"), *sums)
        path = f"{self.root}/rows"
        if not path_exists(self.spark, path):
            return delta.filter("_rows != 0")
        stored = self.spark.read.parquet(path).filter(F.col("part").isin(touched))
        both = stored.select(*delta.columns).unionByName(delta)
        total = both.groupBy(*group).agg(F.sum("_rows").alias("_rows"), *[F.sum(n).alias(n) for n in self.what.sums])
        # below zero: something was withdrawn that had never come
        return total.filter("_rows != 0")

    def apply(self, changes: DataFrame, run: str) -> list[str]:
        """Take in ``changes``; returns the changed partitions.  A run is applied once."""
        if self._ended(f"runs/{run}"):
            return []
        plan = f"{self.root}/plans/{run}"
        if not self._ended(f"plans/{run}/parts"):
            changes = self.what.parts(changes)
            touched = [r.part for r in changes.select("part").distinct().collect()]
            merged = self._merged(changes, touched)
            below = F.raise_error(F.concat(F.lit("withdrawn but unknown: "), F.to_json(F.struct(*merged.columns))))
            checked = merged.withColumn("_rows", F.when(F.col("_rows") < 0, below.cast("bigint")).otherwise(F.col("_rows")))
            checked.write.mode("overwrite").parquet(f"{plan}/rows")
            names = self.spark.createDataFrame([(t and str(t),) for t in touched], "part string").coalesce(1)
            names.write.mode("overwrite").parquet(f"{plan}/parts")
        fresh = self.spark.read.parquet(f"{plan}/rows")
        parts = sorted(r.part for r in self.spark.read.schema("part string").parquet(f"{plan}/parts").collect())
        # the plan's rows lie written: they are placed as they are
        tables.place_partitions(self.spark, f"{self.root}/rows", fresh, "part", parts)
        view = self.what.parts(self.what.finish(fresh))
        tables.replace_partitions(self.spark, f"{self.root}/view", view, "part", parts)
        self.spark.createDataFrame([(run,)], "run string").write.mode("overwrite").parquet(f"{self.root}/runs/{run}")
        remove_path(self.spark, plan)
        return parts

    def view(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/view").drop("part")


def changes(added: DataFrame, withdrawn: DataFrame | None = None) -> DataFrame:
    """Rows that came and rows that went, with their sign."""
    rows = added.withColumn("sign", F.lit(1))
    return rows if withdrawn is None else rows.unionByName(withdrawn.withColumn("sign", F.lit(-1)))
