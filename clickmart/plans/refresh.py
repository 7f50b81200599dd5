"""Refresh of the aggregate tables for a given day."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart.plans import aggregates
from clickmart.sinks import tables


def _day(as_of: str) -> Column:
    return F.lit(as_of).cast("date")


def daily_cutoff(as_of: str, days: int = C.DAILY_REFRESH_DAYS) -> Column:
    return F.date_sub(_day(as_of), days)


def cohort_cutoff(as_of: str, months: int = C.COHORT_REFRESH_MONTHS) -> Column:
    return F.trunc(F.add_months(_day(as_of), -months), "MM")


def refresh_daily(
    existing: DataFrame, sales: DataFrame, dates: DataFrame, products: DataFrame, as_of: str
) -> DataFrame:
    """Daily sales with the days from ``as_of`` - 2 on recomputed."""
    window = F.col("date_key") >= daily_cutoff(as_of)
    # filtered before the aggregation: only the window's partitions are scanned
    fresh = aggregates.daily_sales(sales.filter(window), dates, products)
    return tables.replace_window(existing, fresh, window)


def refresh_cohorts(existing: DataFrame, sales: DataFrame, as_of: str) -> DataFrame:
    """Cohorts of the last six months recomputed, older ones kept once."""
    window = F.col("cohort_month") >= cohort_cutoff(as_of)
    return tables.replace_window(existing, aggregates.cohorts(sales), window)


@dataclass(frozen=True)
class AggregatePaths:
    daily_sales: str
    customer_cohort: str


def refresh(
    spark: SparkSession,
    as_of: str,
    sales: DataFrame,
    dates: DataFrame,
    products: DataFrame,
    paths: AggregatePaths,
    days: Sequence[str] = (),
    cohorts: DataFrame | None = None,
) -> None:
    """Bring both stored aggregates up to date; running it twice changes nothing.

    ``days`` are days before the windows whose sales were changed as well; ``cohorts`` are up to date
    cohorts, without which they are computed from all sales.
    """
    window = in_days("date_key", days) | (F.col("date_key") >= daily_cutoff(as_of))
    tables.refresh_window(
        spark, paths.daily_sales, aggregates.daily_sales(sales.filter(window), dates, products),
        "date_key", window,
    )
    if cohorts is not None:
        every = F.col("cohort_month").isNotNull()
        tables.refresh_window(spark, paths.customer_cohort, cohorts, "cohort_month", every)
        return
    cohort = cohort_cutoff(as_of)
    if days:
        cohort = F.least(cohort, F.trunc(_day(min(days)), "MM"))
    tables.refresh_window(
        spark, paths.customer_cohort, aggregates.cohorts(sales), "cohort_month", F.col("cohort_month") >= cohort
    )


def in_days(column: str, days: Sequence[str]) -> Column:
    """A filter on a date column that prunes partitions."""
    return F.col(column).isin([_day(d) for d in days]) if days else F.lit(False)


def refresh_category_metrics(
    spark: SparkSession, path: str, curated: DataFrame, days: Sequence[str]
) -> None:
    """Materialized daily category metrics, recomputed for the dates that changed."""
    changed = in_days("date", days)
    tables.refresh_window(
        spark, path, aggregates.daily_category_metrics(curated.filter(changed)), "date", changed
    )
