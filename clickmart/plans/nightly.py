"""The daily run: raw files to curated tables, warehouse, features.

Every step replaces whole partitions or merges minima and maxima, so a rerun for
the same date leaves the same tables.  ``curation`` brings the curated zone up to date; the
warehouse follows in the days and sessions that it has changed.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators import integrity
from clickmart.plans import curation, dims, facts, ltv, recommend, refresh, rfm
from clickmart.plans.cohort_state import CohortState
from clickmart.plans.curation import curate, prune_states  # noqa: F401
from clickmart.plans.layout import Layout
from clickmart.sinks import tables
from clickmart.storage import list_names, materialize, path_exists, scratch_scope


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def _merged_state(spark: SparkSession, path: str, new: DataFrame, merge, as_of: str) -> DataFrame:
    """Merge ``new`` into the newest state of a day up to ``as_of``; one folder per day.

    A write that fails leaves the states before it as they were.
    """
    done = [d for d in list_names(spark, path) if d <= as_of and path_exists(spark, f"{path}/{d}/_SUCCESS")]
    if done:
        new = merge(spark.read.parquet(f"{path}/{done[-1]}"), new)
    # a rerun reads the folder it replaces
    tables.write_table(materialize(new, "state"), f"{path}/{as_of}")
    return spark.read.parquet(f"{path}/{as_of}")


def _load_sessions(spark: SparkSession, layout: Layout, plan: curation.Plan) -> None:
    """Replace the sessions a run has changed, in the partitions of the days they begin."""
    path = layout.path("warehouse/dim_session")
    fresh, gone = dims.sessions_of_intervals(plan.came), dims.sessions_of_intervals(plan.went)
    both = fresh.unionByName(gone)
    starts = sorted(str(r[0]) for r in both.select("start_date").distinct().collect())
    if path_exists(spark, path):
        stored = spark.read.schema(S.DIM_SESSION_STORED).parquet(path).filter(refresh.in_days("start_date", starts))
        kept = stored.join(both.select("session_id"), "session_id", "left_anti")
        fresh = kept.select(*S.DIM_SESSION_STORED.names).unionByName(fresh)
    tables.replace_partitions(spark, path, fresh, "start_date", starts)


def _write_facts(spark: SparkSession, layout: Layout, recent: DataFrame, as_of: str) -> None:
    """Facts of the changed days; rows that break a constraint go to ``quarantine``, the counts to ``quality``."""
    parents = {
        name: layout.read(spark, f"warehouse/{name}", schema)
        for name, schema in (
            ("dim_customer", S.DIM_CUSTOMER), ("dim_product", S.DIM_PRODUCT), ("dim_date", S.DIM_DATE)
        )
    }
    for name, build, order in (
        ("fact_sales", facts.fact_sales, "user_id"),
        ("fact_user_events", facts.fact_user_events, "event_type"),
    ):
        counts = integrity.write_checked(
            build(recent), name, parents,
            lambda df: tables.write_partitions(df, layout.path(f"warehouse/{name}"), ["date_key"], [order]),
            lambda df: tables.write_table(df, layout.path(f"quarantine/{as_of}/{name}")),
        )
        tables.write_table(counts, layout.path(f"quality/{as_of}/check={name}"))


def build_warehouse(spark: SparkSession, layout: Layout, as_of: str) -> None:
    """Star schema and aggregates, after the runs of ``curate`` that it has not taken in yet."""
    plans = curation.unloaded(spark, layout)
    days = sorted({d for plan in plans for d in plan.days})
    upto = F.col("date") <= _day(as_of)
    events = layout.read(spark, "curated/events", S.CURATED_EVENT).filter(upto)
    recent = events.filter(refresh.in_days("date", days))

    for plan in plans:
        _load_sessions(spark, layout, plan)

    users = _merged_state(
        spark, layout.path("state/users"), dims.user_state(recent),
        dims.merge_user_states, as_of,
    )
    items = _merged_state(
        spark, layout.path("state/products"), dims.product_state(recent),
        dims.merge_product_states, as_of,
    )
    sold = layout.read(spark, "curated/sales", S.SESSION_SALES).filter(upto)
    scored = rfm.segments(rfm.scores(rfm.metrics(sold, as_of)))
    value = rfm.ltv_formula(scored).select("user_id", "ltv_12m")
    customers = dims.dim_customer(dims.activity_of_state(users), scored, value)
    tables.write_table(customers, layout.path("warehouse/dim_customer"))
    tables.write_table(
        dims.dim_product(dims.products_of_state(items)), layout.path("warehouse/dim_product")
    )
    seen = users.agg(F.min("first_seen").alias("first"), F.max("last_seen").alias("last"))
    tables.write_table(dims.dim_date(seen), layout.path("warehouse/dim_date"))

    _write_facts(spark, layout, recent, as_of)
    state = CohortState(spark, layout.path("state/cohorts"))
    for plan in plans:
        state.update(facts.fact_sales(plan.rows), plan.name)
    refresh.refresh(
        spark,
        as_of,
        layout.read(spark, "warehouse/fact_sales", S.FACT_SALES),
        layout.read(spark, "warehouse/dim_date", S.DIM_DATE),
        layout.read(spark, "warehouse/dim_product", S.DIM_PRODUCT),
        refresh.AggregatePaths(
            layout.path("warehouse/aggr_daily_sales"),
            layout.path("warehouse/aggr_customer_cohort"),
        ),
        days,
        state.cohorts(),
    )
    refresh.refresh_category_metrics(spark, layout.path("mv/daily_category"), events, days)
    stored = {
        name: spark.read.parquet(layout.path(f"warehouse/{name}")) for name in integrity.DECLARED
    }
    tables.write_table(integrity.keys_report(stored), layout.path(f"quality/{as_of}/check=keys"))
    curation.loaded(plans)


def build_features(spark: SparkSession, layout: Layout, as_of: str) -> None:
    """Customer value, recommendations, item vectors and similar items."""
    upto = F.col("date") <= _day(as_of)
    sold = layout.read(spark, "curated/sales", S.SESSION_SALES).filter(upto)
    events = layout.read(spark, "curated/events", S.CURATED_EVENT).filter(upto)

    tables.write_table(
        ltv.same_period_ltv(sold, as_of), layout.path("features/customer_ltv"),
        ["preferred_device"],
    )
    recommender = recommend.fit(recommend.interactions(events))
    for name, df in {
        "recommendations": recommender.top(),
        "item_vectors": recommender.item_vectors(),
        "item_similarity": recommender.similar_items(),
    }.items():
        tables.write_table(df, layout.path(f"features/{name}"))


def run(
    spark: SparkSession, raw_path: str, layout: Layout, as_of: str, since: str | None = None,
    late_days: int | None = None,
) -> None:
    """The whole run for one date; any scheduler may call it."""
    with scratch_scope(spark):
        curate(spark, raw_path, layout, as_of, since, late_days=late_days)
        build_warehouse(spark, layout, as_of)
        build_features(spark, layout, as_of)
