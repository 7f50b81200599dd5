"""Cohorts as mergeable state: a refresh reads the new sales and the state, never the sales before them.

State, below one folder:

* ``users/<run>``: number and first purchase month of every customer, a minimum;
* ``months/run=<run>``: revenue per customer and month of that run's sales, read again only for customers whose first
  month moves;
* ``active/run=<run>``: the customers of that run by month, as bitmaps over their numbers; bitmaps of several runs
  are or-ed;
* ``revenue/run=<run>``: signed revenue per cohort and month; a customer whose first month moves takes
  away there and adds here;
* ``cells/<run>``: active customers per cohort and month.  Only cells of the run's months, and of cohorts
  that customers left or joined, are counted again: the bitmap of the cohort's members and that of the month.

Every run writes folders of its own name and the cells last, so a run that was cut off is simply repeated.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.functions.scalar import exact_ratio, month_diff
from clickmart.operators import ranking
from clickmart.storage import list_names, materialize, path_exists

_USERS = "user_id string, no bigint, first_month date"
_MONTHS = "no bigint, month date, revenue decimal(38,2)"
_ACTIVE = "month date, bucket bigint, bits binary"
_REVENUE = "cohort_month date, month date, revenue decimal(38,2)"
_CELLS = "cohort_month date, month date, active bigint"


def _bits(df: DataFrame, *keys: str) -> DataFrame:
    """The customers ``no`` of every group as bitmaps, one per bucket of numbers."""
    bucket = F.bitmap_bucket_number("no").alias("bucket")
    return df.groupBy(*keys, bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("no")).alias("bits"))


class CohortState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def _runs(self) -> list[str]:
        """Runs that ended, in the order of their names."""
        return [n for n in list_names(self.spark, f"{self.root}/cells") if path_exists(self.spark, f"{self.root}/cells/{n}/_SUCCESS")]

    def _newest(self, name: str, schema: str, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/{runs[-1]}")

    def _all(self, name: str, schema: str, runs: list[str]) -> DataFrame:
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{name}/run={r}" for r in runs])

    def _write(self, df: DataFrame, path: str, schema: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.root}/{path}")
        return self.spark.read.schema(schema).parquet(f"{self.root}/{path}")

    def update(self, sales: DataFrame, run: str) -> None:
        """Take in new ``sales`` (user_id, date_key, total_amount); ``run`` sorts behind earlier runs."""
        runs = self._runs()
        if run in runs:
            return
        batch = materialize(
            sales.groupBy("user_id", F.trunc("date_key", "MM").alias("month")).agg(F.sum("total_amount").alias("revenue")),
            "cohort-batch",
        )
        old = self._newest("users", _USERS, runs)
        firsts = batch.groupBy(F.col("user_id").alias("own_id")).agg(F.min("month").alias("own_month"))
        same = F.col("user_id").eqNullSafe(F.col("own_id"))
        met = old.join(firsts, same, "left")
        # customers seen for the first time are numbered on
        new = firsts.join(old, same, "left_anti").withColumnsRenamed({"own_id": "user_id"})
        base = (old.agg(F.max("no")).first()[0] if runs else None)
        numbers = ranking.integer_ids(new.select(F.col("user_id").alias("new_id")), "new_id", "i")
        fresh = new.join(numbers, F.col("user_id").eqNullSafe(F.col("new_id"))).select(
            "user_id", (F.col("i") + (0 if base is None else base + 1)).cast("bigint").alias("no"),
            F.col("own_month").alias("first_month"),
        )
        users = self._write(
            met.select("user_id", "no", F.least("first_month", "own_month").alias("first_month")).unionByName(fresh),
            f"users/{run}", _USERS,
        )
        moved = materialize(
            met.filter(F.col("own_month") < F.col("first_month")).select(
                "no", F.col("first_month").alias("was"), F.col("own_month").alias("now")
            ),
            "cohort-moved",
        )
        known = users.withColumnRenamed("user_id", "own_id")
        numbered = batch.join(known, same).select("no", "first_month", "month", "revenue")
        months = self._write(numbered.select("no", "month", "revenue"), f"months/run={run}", _MONTHS)
        self._write(_bits(months, "month"), f"active/run={run}", _ACTIVE)
        before = self._all("months", _MONTHS, runs).join(moved, "no")
        changes = [
            numbered.select(F.col("first_month").alias("cohort_month"), "month", "revenue"),
            before.select(F.col("was").alias("cohort_month"), "month", (-F.col("revenue")).alias("revenue")),
            before.select(F.col("now").alias("cohort_month"), "month", "revenue"),
        ]
        signed = changes[0].unionByName(changes[1]).unionByName(changes[2])
        self._write(
            signed.groupBy("cohort_month", "month").agg(F.sum("revenue").cast(S.TOTAL).alias("revenue")),
            f"revenue/run={run}", _REVENUE,
        )
        self._count(run, runs, users, months, moved)

    def _count(self, run: str, runs: list[str], users: DataFrame, months: DataFrame, moved: DataFrame) -> None:
        """Write the cells: those that the run can't have changed as they were, the others counted."""
        # at most one row per month of the history
        own = [r.month for r in months.select("month").distinct().collect()]
        left = {c for r in moved.select("was", "now").distinct().collect() for c in (r.was, r.now)}
        changed = F.col("month").isin(own) | F.col("cohort_month").isin(sorted(left))
        kept = self._newest("cells", _CELLS, runs).filter(~changed)
        active = self._all("active", _ACTIVE, [*runs, run])
        if not left:
            active = active.filter(F.col("month").isin(own))
        active = active.groupBy("month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        members = _bits(users.withColumnRenamed("first_month", "cohort_month"), "cohort_month")
        pairs = members.withColumnRenamed("bits", "own").join(active, "bucket").filter(
            (F.col("month") >= F.col("cohort_month")) & changed
        )
        both = (
            pairs.select("cohort_month", "month", "bucket", F.explode(F.array("own", "bits")).alias("bits"))
            .groupBy("cohort_month", "month", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
        )
        counted = both.groupBy("cohort_month", "month").agg(F.sum(F.bitmap_count("bits")).alias("active"))
        self._write(kept.unionByName(counted.filter("active > 0")), f"cells/{run}", _CELLS)

    def cohorts(self) -> DataFrame:
        """Active customers, revenue and retention per first-purchase month and period."""
        runs = self._runs()
        cells = self._newest("cells", _CELLS, runs)
        sums = self._all("revenue", _REVENUE, runs).groupBy("cohort_month", "month").agg(
            F.sum("revenue").cast(S.TOTAL).alias("revenue")
        )
        initial = F.first("active").over(W.partitionBy("cohort_month").orderBy("month"))
        return S.conform(
            cells.join(sums, ["cohort_month", "month"], "left").withColumns({
                "period": month_diff(F.col("cohort_month"), F.col("month")),
                "active_customers": F.col("active"),
                "retention_rate": exact_ratio(F.col("active").cast("decimal(18,0)"), initial, S.RATE),
            }),
            S.AGGR_CUSTOMER_COHORT,
        )
