"""Headline queries on local cores; prints one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed
rounds.  One round warms the JVM; every round begins at another query of the list, so
none is always the first.  Each query reports its median.  ``BENCH_QUERIES`` (comma
separated, or ``all``) replaces the headline list.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from clickmart import session  # noqa: E402
from clickmart.operators import enrich, sessions  # noqa: E402
from clickmart.plans import aggregates, dims  # noqa: E402
from clickmart.queries import queries  # noqa: E402
from clickmart.sources import fixtures  # noqa: E402
from clickmart.storage import materialize, scratch_path  # noqa: E402

COPIES = 10

HEADLINE = [
    "clean_events",
    "enrich_events",
    "sessionize_events",
    "session_sales",
    "dim_session",
    "fact_sales_orders",
    "daily_sales",
    "cohort_retention",
    "customer_360",
    "product_performance",
    "revenue_by_category_month",
    "daily_category_metrics",
    "rfm_scores_high",
    "rfm_scores_orders",
    "ltv_formula",
    "interactions",
    "als_recommendations",
    "embedding_similarity_topk",
    "stream_enrich",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    """Seconds of one run, plan building included."""
    start = time.perf_counter()
    run(make())
    return time.perf_counter() - start


def rounds(makers: dict, runs: int, warm: int = 1) -> dict:
    """Median seconds by name over ``runs`` rounds after ``warm`` others."""
    names, measured = list(makers), {name: [] for name in makers}
    for i in range(warm + runs):
        shift = i % len(names)
        for name in names[shift:] + names[:shift]:
            seconds = timed(makers[name])
            if i >= warm:
                measured[name].append(seconds)
    return {name: round(statistics.median(times), 3) for name, times in measured.items()}


def stored_star(spark, sf_dir) -> dict:
    """Warehouse queries over stored star tables, as a warehouse holds them."""
    sold = materialize(fixtures.fact_sales(spark, sf_dir), "bench-sales")
    orders = fixtures.table(spark, sf_dir, "orders")
    dates = materialize(dims.dim_date(dims.date_bounds(orders, "o_orderdate")), "bench-dates")
    products = materialize(dims.dim_product(fixtures.product_source(spark, sf_dir)), "bench-products")
    return {
        "star_daily_sales": lambda: aggregates.daily_sales(sold, dates, products),
        "star_cohort_retention": lambda: aggregates.cohorts(sold),
        "star_product_performance": lambda: aggregates.product_performance(products, sold),
        "star_revenue_by_category_month": lambda: aggregates.revenue_by_month(sold, dates, products),
    }


def size_against_json(spark, sf_dir) -> float:
    """Share of the raw JSON size that the curated Parquet table saves."""
    def folder_bytes(path: str) -> int:
        return sum(os.path.getsize(f.removeprefix("file:")) for f in spark.read.format("binaryFile")
                   .load(path).select("path").toPandas()["path"])

    raw, curated = scratch_path(spark, "bench-json"), scratch_path(spark, "bench-parquet")
    enrich.json_lines(fixtures.raw_events(spark, sf_dir)).write.text(raw)
    sessions.sessionize(fixtures.clean_events(spark, sf_dir)).coalesce(4).write.option(
        "compression", "snappy"
    ).parquet(curated)
    return round(1 - folder_bytes(curated) / folder_bytes(raw), 3)


def replicated_events(spark, sf_dir):
    """The events under ten times as many user ids, written once."""
    copy = F.explode(F.sequence(F.lit(1), F.lit(COPIES))).alias("copy")
    events = fixtures.clean_events(spark, sf_dir).select("*", copy)
    return materialize(
        events.withColumn("user_id", F.concat_ws("_", "user_id", "copy")).drop("copy"), "replicated"
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    wanted = os.environ.get("BENCH_QUERIES")
    available = queries()
    names = list(available) if wanted == "all" else wanted.split(",") if wanted else HEADLINE
    spark = session.build(
        "clickmart-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = rounds(
        {name: (lambda name=name: available[name](spark, sf_dir)) for name in names}, runs
    )
    events = fixtures.table(spark, sf_dir, "events").count()
    result = {
        "metric": "headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "spark": spark.version,
    }
    if not wanted:
        many = replicated_events(spark, sf_dir)
        seconds = rounds({"many": lambda: sessions.sessionize(many)}, runs, warm=1)["many"]
        rate = COPIES * events / seconds
        result["sessionize_replicated"] = {
            "events": COPIES * events,
            "sec": seconds,
            "events_per_sec": round(rate),
            "events_per_sec_per_core": round(rate / int(cpus)),
        }
        result["stored_star"] = rounds(stored_star(spark, sf_dir), runs, warm=1)
        result["saved_against_json"] = size_against_json(spark, sf_dir)
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
