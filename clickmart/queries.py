"""The registered queries: every operator over the whole given tables.

Results are plain values (numbers, text, booleans), so that other engines can be
compared: money and rates as double, dates as text, timestamps as epoch
microseconds, arrays as joined text.
"""

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.operators import (
    clean, dedup, enrich, geo, integrity, sales, sessions, similarity,
)
from clickmart.plans import aggregates, curation, differences, dims, facts, ltv, moments, recommend, refresh, rfm
from clickmart.plans.cohort_state import CohortState
from clickmart.plans.layout import Layout
from clickmart.sinks import tables
from clickmart.sources import catalog, fixtures, raw
from clickmart.storage import materialize, scratch_path
from clickmart.streaming import delivery, ingest, live

Query = Callable[[SparkSession, str], DataFrame]

_registry: dict[str, Query] = {}


def _plain_column(field: T.StructField):
    c = F.col(field.name)
    kind = field.dataType
    if isinstance(kind, T.DecimalType):
        c = c.cast("double")
    elif isinstance(kind, T.DateType):
        c = c.cast("string")
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        c = c.cast("bigint")
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        c = F.array_join(c, ",")
    return c.alias("event_date" if field.name == "date" else field.name)


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[_plain_column(f) for f in df.schema])


def _query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(spark, sf_dir))

    _registry[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_registry)


def _curated(spark, sf_dir):
    return sessions.sessionize(fixtures.clean_events(spark, sf_dir))


def _segments(spark):
    return geo.segments(geo.ranges(fixtures.geo_table(spark)))


def _orders_star(spark, sf_dir):
    """Sales facts with their date and product dimensions."""
    orders = fixtures.table(spark, sf_dir, "orders")
    return (
        fixtures.fact_sales(spark, sf_dir),
        dims.dim_date(dims.date_bounds(orders, "o_orderdate")),
        dims.dim_product(fixtures.product_source(spark, sf_dir)),
    )


def _stored_sales(spark, sf_dir):
    """Sales facts as a stored table: order lines and orders are read once."""
    return materialize(fixtures.fact_sales(spark, sf_dir), "fact-sales")


def _order_customers(spark, sf_dir, sold):
    """Customer dimension over sales facts."""
    scored = rfm.segments(rfm.scores(rfm.sale_metrics(sold, fixtures.SALES_AS_OF)))
    days = scored.select(
        "user_id",
        F.col("first_purchase").alias("first_seen"),
        F.col("last_purchase").alias("last_seen"),
    )
    activity = fixtures.customer_profile(spark, sf_dir).join(days, "user_id", "left")
    return dims.dim_customer(activity, scored, rfm.ltv_formula(scored).select("user_id", "ltv_12m"))


# --- cleaning, sources -------------------------------------------------------


@_query
def clean_events(spark, sf_dir):
    return fixtures.clean_events(spark, sf_dir)


@_query
def decode_events(spark, sf_dir):
    """Base64 JSON payloads decoded, unreadable ones rejected, then cleaned."""
    text = enrich.json_lines(fixtures.raw_events(spark, sf_dir)).select(
        F.base64(F.col("value").cast("binary")).alias("data")
    )
    return clean.clean(raw.accepted(raw.decode(text, encoded=True)))


@_query
def json_scan(spark, sf_dir):
    """Raw events written as JSON lines per day and read back with the fixed schema."""
    path = scratch_path(spark, "raw-json")
    day = F.timestamp_millis("timestamp")
    days = {"year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day)}
    fixtures.raw_events(spark, sf_dir).withColumns(days).write.partitionBy(*days).json(path)
    return clean.clean(raw.accepted(raw.read_raw(spark, path, S.RAW_EVENT)))


@_query
def mapped_events(spark, sf_dir):
    """A foreign column layout mapped to the raw event schema."""
    foreign = fixtures.raw_events(spark, sf_dir).select(
        F.date_format(F.timestamp_millis("timestamp"), "yyyy-MM-dd HH:mm:ss' UTC'").alias(
            "event_time"
        ),
        "event_type", "product_id", F.col("category").alias("category_id"), "brand", "user_id",
        "price",
    )
    return clean.clean(raw.from_mapping(foreign, raw.csv_mapping())).select(
        "user_id", "product_id", "event_type", "price", "event_ts", "category", "brand", "hour"
    )


@_query
def dedup_events(spark, sf_dir):
    """Every event delivered twice, kept once."""
    events = fixtures.clean_events(spark, sf_dir)
    return dedup.dedup(events.unionByName(events)).select(
        "event_id", "event_type", "product_id", "user_id", "event_ts", "price"
    )


@_query
def enrich_events(spark, sf_dir):
    located = enrich.enrich(
        fixtures.raw_events(spark, sf_dir), _segments(spark).stored()
    )
    return located.drop("processed_ts", "session_id", "price", "payload")


@_query
def discover_events(spark, sf_dir):
    """A table discovered from JSON lines; few of them have a coupon."""
    path = scratch_path(spark, "discovered")
    events = fixtures.clean_events(spark, sf_dir).select("event_id", "price", "date")
    coupon = F.when(F.col("event_id").cast("bigint") % 331 == 7, F.concat(F.lit("c"), "event_id"))
    events.withColumn("coupon", coupon).write.partitionBy("date").json(f"{path}/events")
    database = "clickmart_" + path.rsplit("-", 1)[1]
    catalog.create_database(spark, database, f"{path}/database", use=False)
    catalog.discover(spark, database, "found", f"{path}/events")
    return spark.table(f"{database}.found").select(
        F.col("event_id").cast("string").alias("event_id"), "coupon",
        F.col("price").cast("double").alias("price"), F.col("date").cast("string").alias("day"),
    )


def _odd_lines(spark, sf_dir):
    """Raw events as JSON lines: some with a field beyond the schema, some cut off."""
    events = fixtures.raw_events(spark, sf_dir).withColumn(
        "coupon", F.when(F.col("event_id").cast("bigint") % 10 == 3, F.concat(F.lit("c"), "event_id"))
    )
    line = F.to_json(F.struct(*events.columns))
    cut = F.col("event_id").cast("bigint") % 100 == 5
    return events.select(F.when(cut, F.substring(line, 1, 40)).otherwise(line).alias("data"))


@_query
def enrich_keeps_fields(spark, sf_dir):
    """Fields that the schema lacks reach the enriched event."""
    decoded = raw.decode(_odd_lines(spark, sf_dir))
    located = enrich.enrich(decoded, _segments(spark).stored())
    return located.select(
        "user_id", "timestamp", F.get_json_object("payload", "$.coupon").alias("coupon")
    )


@_query
def rejected_lines(spark, sf_dir):
    return raw.rejects(raw.decode(_odd_lines(spark, sf_dir))).groupBy("line", "reason").agg(
        F.count(F.lit(1)).alias("n")
    )


def _late_lake(spark, sf_dir):
    """All events, delivered up to six days late or early; each run sees what came by its day."""
    path, root = scratch_path(spark, "late-raw"), scratch_path(spark, "late-lake")
    shift = (F.col("event_id").cast("bigint") % 13 - 6).cast("int")
    day = F.to_date(F.timestamp_millis("timestamp"))
    first, last = F.lit("2024-01-01").cast("date"), F.lit(fixtures.EVENTS_AS_OF).cast("date")
    delivered = F.greatest(first, F.least(last, F.date_add(day, shift)))
    fields = {"year": "yyyy", "month": "MM", "day": "dd"}
    events = fixtures.raw_events(spark, sf_dir)
    layout, before = Layout(root), None
    for as_of in ("2024-01-04", "2024-01-17", fixtures.EVENTS_AS_OF):
        came = delivered <= F.lit(as_of).cast("date")
        if before:
            came &= delivered > F.lit(before).cast("date")
        events.filter(came).withColumns(
            {k: F.date_format(delivered, f) for k, f in fields.items()}
        ).write.mode("append").partitionBy(*fields).json(path)
        curation.curate(spark, path, layout, as_of, None if before else "2024-01-01")
        before = as_of
    return layout


def _late_events(spark, sf_dir):
    return _late_lake(spark, sf_dir).read(spark, "curated/events", S.CURATED_EVENT)


@_query
def late_events(spark, sf_dir):
    """Start of the session of every event, after runs that met events late or early."""
    return _late_events(spark, sf_dir).select("event_id", "user_id", "session_start")


@_query
def late_events_all(spark, sf_dir):
    """Every event of the table after runs that met it late or early."""
    return _late_events(spark, sf_dir).select("event_id", "user_id", "session_seq", "session_id")


@_query
def late_sessions(spark, sf_dir):
    """The session dimension from the stored intervals that the same runs have merged."""
    intervals = _late_lake(spark, sf_dir).read(spark, curation.INTERVALS, S.SESSION_INTERVAL)
    return dims.sessions_of_intervals(intervals).drop("browser", "traffic_source", "start_date")


# --- sessions ----------------------------------------------------------------


@_query
def sessionize_events(spark, sf_dir):
    return _curated(spark, sf_dir).select(
        "event_id", "user_id", "event_type", "event_ts", "session_seq", "session_start",
        "session_id",
    )


@_query
def sessionize_incremental(spark, sf_dir):
    """Two runs, the second one continuing the sessions the first one left open."""
    events = fixtures.clean_events(spark, sf_dir)
    half = F.lit("2024-01-15").cast("date")
    first, second = events.filter(F.col("date") < half), events.filter(F.col("date") >= half)
    state = materialize(sessions.last_sessions(first), "session-state")
    both = sessions.sessionize(first).unionByName(sessions.sessionize(second, carry=state))
    return both.select(
        "event_id", "user_id", "event_type", "event_ts", "session_seq", "session_start",
        "session_id",
    )


@_query
def session_windows(spark, sf_dir):
    return sessions.session_windows(fixtures.clean_events(spark, sf_dir))


@_query
def session_sales(spark, sf_dir):
    return sales.session_sales(fixtures.clean_events(spark, sf_dir))


@_query
def curated_sales_table(spark, sf_dir):
    """Curated events written by date, sales computed from the written partitions."""
    path = scratch_path(spark, "curated")
    tables.write_partitions(
        S.conform(_curated(spark, sf_dir), S.CURATED_EVENT), path, ["date"], ["user_id"]
    )
    written = spark.read.schema(S.CURATED_EVENT).parquet(path)
    return sales.sales_of_sessions(written)


@_query
def catalog_sales_scan(spark, sf_dir):
    """Session sales written by date and read back as an external catalog table."""
    path = scratch_path(spark, "catalog")
    tables.write_partitions(
        sales.session_sales(fixtures.clean_events(spark, sf_dir)), f"{path}/sales", ["date"]
    )
    database = "clickmart_" + path.rsplit("-", 1)[1]
    catalog.create_database(spark, database, f"{path}/database", use=False)
    catalog.create_table(spark, database, "curated_sales", f"{path}/sales")
    return spark.table(f"{database}.curated_sales")


@_query
def merged_schema_sales(spark, sf_dir):
    """Rows with an additional column appended to a table; all columns come back."""
    rows = sales.session_sales(fixtures.clean_events(spark, sf_dir)).select(
        "session_id", "user_id", "total_revenue"
    )
    path = scratch_path(spark, "merged")
    big = F.col("total_revenue") >= 50
    rows.filter(~big).write.parquet(path)
    return catalog.merge_schema(spark, path, rows.filter(big).withColumn("tier", F.lit("big")))


# --- dimensions and facts ----------------------------------------------------


@_query
def dim_date(spark, sf_dir):
    return dims.dim_date(
        dims.date_bounds(fixtures.table(spark, sf_dir, "orders"), "o_orderdate")
    )


@_query
def dim_product(spark, sf_dir):
    return dims.dim_product(fixtures.product_source(spark, sf_dir)).drop(
        "subcategory", "cost", "margin_pct", "created_date"
    )


@_query
def dim_product_events(spark, sf_dir):
    events = fixtures.clean_events(spark, sf_dir)
    return dims.dim_product(dims.products_of_events(events)).select(
        "product_id", "category", "brand", "price", "is_active", "created_date"
    )


@_query
def product_margin(spark, sf_dir):
    """Margins for a cost derived from the part size."""
    cost = (F.col("price") * (F.col("p_size") + 20) / 100).cast(S.PRICE)
    part = fixtures.table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), "p_size"
    )
    products = fixtures.product_source(spark, sf_dir).join(part, "product_id")
    return dims.dim_product(products.withColumn("cost", cost)).select(
        "product_id", "price", "cost", "margin_pct"
    )


@_query
def dim_session(spark, sf_dir):
    return dims.dim_session(fixtures.clean_events(spark, sf_dir)).drop("browser", "traffic_source")


@_query
def user_activity(spark, sf_dir):
    events = geo.locate(fixtures.clean_events(spark, sf_dir), _segments(spark))
    return dims.user_activity(events)


@_query
def dim_customer(spark, sf_dir):
    events = geo.locate(fixtures.clean_events(spark, sf_dir), _segments(spark).stored())
    sold = sales.session_sales(events)
    scored = rfm.segments(rfm.scores(rfm.metrics(sold, fixtures.EVENTS_AS_OF)))
    value = rfm.ltv_formula(scored).select("user_id", "ltv_12m")
    return dims.dim_customer(dims.user_activity(events), scored, value).drop("registration_date")


@_query
def fact_sales(spark, sf_dir):
    return facts.fact_sales(_curated(spark, sf_dir)).drop("tax_amount", "payment_method")


@_query
def fact_sales_orders(spark, sf_dir):
    return fixtures.fact_sales(spark, sf_dir).drop("hour", "payment_method")


@_query
def fact_user_events(spark, sf_dir):
    return facts.fact_user_events(_curated(spark, sf_dir))


# --- aggregates and views ----------------------------------------------------


@_query
def daily_sales(spark, sf_dir):
    return aggregates.daily_sales(*_orders_star(spark, sf_dir))


@_query
def daily_sales_refresh(spark, sf_dir):
    """Old rows altered, the window recomputed: altered rows survive outside of it only."""
    _, dates, products = _orders_star(spark, sf_dir)
    sold = _stored_sales(spark, sf_dir)
    stale = aggregates.daily_sales(sold, dates, products).withColumn(
        "total_orders", F.col("total_orders") + 1000
    )
    return refresh.refresh_daily(stale, sold, dates, products, fixtures.SALES_AS_OF)


@_query
def cohort_retention(spark, sf_dir):
    return aggregates.cohorts(fixtures.fact_sales(spark, sf_dir))


@_query
def cohort_refresh(spark, sf_dir):
    sold = fixtures.fact_sales(spark, sf_dir)
    stale = aggregates.cohorts(sold).withColumn(
        "active_customers", F.col("active_customers") + 1000
    )
    # a cut-off in the middle of the history, so that both sides hold rows
    return refresh.refresh_cohorts(stale, sold, "1996-03-15")


@_query
def cohort_state(spark, sf_dir):
    """All sales in three runs, each of which brings earlier first months for some customers."""
    sold = _stored_sales(spark, sf_dir)
    state = CohortState(spark, scratch_path(spark, "cohort-state"))
    for n in (2, 0, 1):
        state.update(sold.filter(F.pmod(F.xxhash64("sale_id"), F.lit(3)) == n), f"run-{(n + 1) % 3}")
    return state.cohorts()


def _wrong_first(df: DataFrame, key: str, wrong: dict) -> tuple[DataFrame, DataFrame]:
    """Rows as they came first, some of them wrong; and the corrections."""
    odd = F.pmod(F.xxhash64(key), F.lit(7)) == 0
    bad = df.filter(odd).withColumns(wrong)
    return df.filter(~odd).unionByName(bad), differences.changes(df.filter(odd), bad)


@_query
def category_metrics_by_differences(spark, sf_dir):
    """Every seventh event came with a wrong user and price and is corrected by differences."""
    events = fixtures.clean_events(spark, sf_dir).select("event_id", "date", "category", "user_id", "event_type", "price")
    wrong = {"user_id": F.concat("user_id", F.lit("?")), "price": (F.col("price") + 1).cast(S.PRICE)}
    first, corrections = _wrong_first(events, "event_id", wrong)
    kept = differences.Maintained(spark, scratch_path(spark, "metrics"), differences.CATEGORY_METRICS)
    kept.apply(differences.changes(first), "1")
    kept.apply(corrections, "2")
    return S.conform(kept.view(), S.DAILY_CATEGORY_METRICS)


@_query
def daily_sales_by_differences(spark, sf_dir):
    """Every seventh order came on the wrong day, with half its amount, and is corrected by differences."""
    sold, dates, products = _orders_star(spark, sf_dir)
    rows = sold.join(dates.select("date_key"), "date_key").join(products.select("product_id", "category"), "product_id")
    rows = rows.select("date_key", "category", "sale_id", "user_id", "total_amount")
    wrong = {"date_key": F.date_add("date_key", 1), "total_amount": (F.col("total_amount") / 2).cast(S.AMOUNT)}
    first, corrections = _wrong_first(materialize(rows, "sales"), "sale_id", wrong)
    kept = differences.Maintained(spark, scratch_path(spark, "daily"), differences.DAILY_SALES)
    kept.apply(differences.changes(first), "1")
    kept.apply(corrections, "2")
    return S.conform(kept.view(), S.AGGR_DAILY_SALES)


@_query
def customer_360(spark, sf_dir):
    sold = _stored_sales(spark, sf_dir)
    return aggregates.customer_360(
        _order_customers(spark, sf_dir, sold), sold, fixtures.clean_events(spark, sf_dir)
    )


@_query
def customer_360_literal(spark, sf_dir):
    sold = _stored_sales(spark, sf_dir)
    return aggregates.customer_360_literal(
        _order_customers(spark, sf_dir, sold), sold, fixtures.clean_events(spark, sf_dir)
    )


@_query
def product_performance(spark, sf_dir):
    sold, _, products = _orders_star(spark, sf_dir)
    return aggregates.product_performance(products, sold)


@_query
def daily_category_metrics(spark, sf_dir):
    return aggregates.daily_category_metrics(fixtures.clean_events(spark, sf_dir))


@_query
def category_metrics_refresh(spark, sf_dir):
    """The stored metrics, altered, then recomputed for the dates that changed."""
    events = fixtures.clean_events(spark, sf_dir)
    path = scratch_path(spark, "mv")
    stale = aggregates.daily_category_metrics(events).withColumn(
        "event_count", F.col("event_count") + 1000
    )
    tables.write_partitions(stale, path, ["date"])
    changed = [f"2024-01-{d}" for d in range(20, 31)]
    refresh.refresh_category_metrics(spark, path, events, changed)
    return spark.read.schema(S.DAILY_CATEGORY_METRICS).parquet(path)


@_query
def revenue_by_category_month(spark, sf_dir):
    return aggregates.revenue_by_month(*_orders_star(spark, sf_dir))


@_query
def revenue_by_category_month_of_year(spark, sf_dir):
    return aggregates.revenue_by_month(*_orders_star(spark, sf_dir), year=1998)


@_query
def customer_activity(spark, sf_dir):
    return aggregates.customer_activity(
        fixtures.clean_events(spark, sf_dir), C.BASELINE_LTV_FACTOR
    )


@_query
def constraints_on_write(spark, sf_dir):
    """Violations of every constraint of the sales facts, some of which are broken, counted by the write."""
    _, dates, products = _orders_star(spark, sf_dir)
    key = F.col("sale_id").cast("bigint")
    sold = fixtures.fact_sales(spark, sf_dir).withColumns({
        "user_id": F.when(key % 11 == 3, F.lit("nobody")).otherwise(F.col("user_id")),
        "unit_price": F.when(key % 13 != 5, F.col("unit_price")),
    })
    parents = {"dim_customer": fixtures.customer_profile(spark, sf_dir), "dim_product": products, "dim_date": dates}
    kept, refused = scratch_path(spark, "kept-sales"), scratch_path(spark, "refused-sales")
    counts = integrity.write_checked(
        sold, "fact_sales", parents, lambda df: tables.write_table(df, kept), lambda df: tables.write_table(df, refused)
    )
    rows = [("rows", kept), ("quarantined", refused)]
    sizes = [
        spark.read.parquet(path).agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit("fact_sales").alias("table_name"), F.lit(kind).alias("check_kind"), F.lit("").alias("column_name"),
            "violations",
        ) for kind, path in rows
    ]
    return integrity.report([counts, *sizes])


@_query
def integrity_report(spark, sf_dir):
    _, dates, products = _orders_star(spark, sf_dir)
    sold = _stored_sales(spark, sf_dir)
    customers = fixtures.customer_profile(spark, sf_dir)
    return integrity.report(
        [
            integrity.primary_key(sold, "fact_sales", ["sale_id"]),
            integrity.primary_key(customers, "dim_customer", ["user_id"]),
            integrity.primary_key(products, "dim_product", ["product_id"]),
            integrity.primary_key(dates, "dim_date", ["date_key"]),
            integrity.foreign_key(sold, "fact_sales", "user_id", customers, "user_id"),
            integrity.foreign_key(sold, "fact_sales", "product_id", products, "product_id"),
            integrity.foreign_key(sold, "fact_sales", "date_key", dates, "date_key"),
            integrity.not_null(
                sold, "fact_sales",
                ["session_id", "user_id", "product_id", "date_key", "unit_price", "total_amount",
                 "payment_method"],
            ),
        ]
    )


# --- customer value ----------------------------------------------------------


def _metrics(spark, sf_dir):
    sold = sales.session_sales(fixtures.clean_events(spark, sf_dir))
    return rfm.metrics(sold, fixtures.EVENTS_AS_OF)


_SCORES = ["user_id", "recency_score", "frequency_score", "monetary_score", "rfm_score"]


@_query
def rfm_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir)


@_query
def rfm_scores_high(spark, sf_dir):
    return rfm.scores(_metrics(spark, sf_dir)).select(*_SCORES)


@_query
def rfm_scores_low(spark, sf_dir):
    return rfm.scores(_metrics(spark, sf_dir), best="low").select(*_SCORES)


@_query
def rfm_scores_orders(spark, sf_dir):
    """Scores over the order tables."""
    metrics = rfm.sale_metrics(fixtures.fact_sales(spark, sf_dir), fixtures.SALES_AS_OF)
    return rfm.scores(metrics).select(*_SCORES)


@_query
def rfm_segments(spark, sf_dir):
    return rfm.segments(rfm.scores(_metrics(spark, sf_dir))).select(
        "user_id", "rfm_score", "rfm_segment", "customer_segment"
    )


@_query
def ltv_formula(spark, sf_dir):
    metrics = rfm.sale_metrics(fixtures.fact_sales(spark, sf_dir), fixtures.SALES_AS_OF)
    return rfm.ltv_formula(metrics).select("user_id", "aov", "active_months", "ltv_12m")


@_query
def ltv_regression(spark, sf_dir):
    return ltv.predict_ltv(
        fixtures.order_session_sales(spark, sf_dir), fixtures.SALES_AS_OF
    ).predictions


_SPENT = ("monetary", "frequency")


def _spending(spark, sf_dir):
    return materialize(moments.spending(fixtures.fact_sales(spark, sf_dir), "1998-01-01"), "spending")


def _moment_fit(customers):
    """Moments per first day of two halves of the customers, stored, merged and solved."""
    half = F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0
    states = [
        materialize(moments.moments(customers.filter(part), _SPENT, ["first_day"]), "moments") for part in (half, ~half)
    ]
    days = moments.merged(states, _SPENT, ["first_day"])
    return moments.solve(moments.merged([days], _SPENT), _SPENT)


@_query
def ltv_moments(spark, sf_dir):
    """Coefficients, intercept and R squared to seven digits."""
    fit = _moment_fit(_spending(spark, sf_dir))
    values = [*zip(fit.features, fit.coefficients, strict=True), ("intercept", fit.intercept), ("r2", fit.r2)]
    return spark.createDataFrame([(n, v, fit.n) for n, v in values], "name string, v double, customers long").select(
        "name", F.format_string("%.6e", "v").alias("value"), "customers"
    )


@_query
def ltv_moment_scores(spark, sf_dir):
    """Every customer's predicted spend."""
    customers = _spending(spark, sf_dir)
    return moments.score(customers, _moment_fit(customers)).select(
        "user_id", F.format_string("%.6e", "prediction").alias("prediction")
    )


@_query
def revenue_by_category_month_pruned(spark, sf_dir):
    """The year's view over a fact stored by day: the year of the dimension prunes the fact's partitions."""
    sold, dates, products = _orders_star(spark, sf_dir)
    path = scratch_path(spark, "fact-by-day")
    tables.write_partitions(sold.select("date_key", "product_id", "user_id", "total_amount"), path, ["date_key"])
    stored = spark.read.parquet(path)
    return aggregates.revenue_by_month(stored, materialize(dates, "dates"), products, year=1998)


@_query
def ltv_same_period(spark, sf_dir):
    return ltv.same_period_ltv(
        sales.session_sales(fixtures.clean_events(spark, sf_dir)), fixtures.EVENTS_AS_OF
    ).withColumn("predicted_ltv_12m", F.round("predicted_ltv_12m", 2))


# --- recommendations ---------------------------------------------------------


@_query
def interactions(spark, sf_dir):
    return recommend.interactions(fixtures.clean_events(spark, sf_dir))


def _recommender(spark, sf_dir):
    return recommend.fit(recommend.interactions(fixtures.clean_events(spark, sf_dir)))


@_query
def als_recommendations(spark, sf_dir):
    return _recommender(spark, sf_dir).top()


@_query
def als_recommendations_unseen(spark, sf_dir):
    return _recommender(spark, sf_dir).top(exclude_seen=True)


@_query
def item_vectors(spark, sf_dir):
    return _recommender(spark, sf_dir).item_vectors().drop("vec")


@_query
def item_similarity(spark, sf_dir):
    return _recommender(spark, sf_dir).similar_items()


# learned values have no twin in SQL; what holds for any right value has one


def _recommendation_check(top: DataFrame) -> DataFrame:
    """Per user: recommended products, all of them different, by falling rating."""
    place = W.partitionBy("user_id").orderBy(F.desc("predicted_rating"))
    return (
        top.withColumn("before", F.lag("predicted_rating").over(place))
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("recommended"),
            F.count_distinct("recommended_product_id").alias("products"),
            F.bool_and(F.col("predicted_rating") >= 0).alias("not_negative"),
            F.count(F.when(F.isnan("predicted_rating") | F.col("predicted_rating").isNull(), 1)).alias("not_rated"),
        )
    )


@_query
def als_recommendations_check(spark, sf_dir):
    return _recommendation_check(_recommender(spark, sf_dir).top())


@_query
def als_unseen_check(spark, sf_dir):
    """The same among unseen products, and how many of them the user has seen (none)."""
    rated = materialize(recommend.interactions(fixtures.clean_events(spark, sf_dir)), "rated")
    top = materialize(recommend.fit(rated).top(exclude_seen=True), "unseen")
    seen = rated.select("user_id", F.col("product_id").alias("recommended_product_id"), F.lit(1).alias("hit"))
    hits = top.join(seen, ["user_id", "recommended_product_id"]).groupBy("user_id").agg(F.sum("hit").alias("seen"))
    return _recommendation_check(top).join(hits, "user_id", "left").withColumn(
        "seen", F.coalesce("seen", F.lit(0))
    )


@_query
def als_optimality_check(spark, sf_dir):
    """Per user: rated products, and whether its factors are the best for the item factors."""
    return _recommender(spark, sf_dir).optimality().select(
        "user_id", "ratings", (F.col("off") < 0.001).alias("best")
    )


def _stored_table(spark, name: str, df: DataFrame) -> DataFrame:
    """``df`` written as the nightly run does and read back as the external table of the catalog."""
    path = scratch_path(spark, name)
    tables.write_table(df, f"{path}/{name}", list(catalog.TABLES[name][2]))
    database = "clickmart_" + path.rsplit("-", 1)[1]
    catalog.create_database(spark, database, f"{path}/database", use=False)
    catalog.create_table(spark, database, name, f"{path}/{name}")
    return spark.table(f"{database}.{name}")


@_query
def customer_ltv_table(spark, sf_dir):
    """Customer values by device, written and read back as an external table."""
    sold = sales.session_sales(fixtures.clean_events(spark, sf_dir))
    stored = _stored_table(spark, "customer_ltv", ltv.same_period_ltv(sold, fixtures.EVENTS_AS_OF))
    return stored.withColumn("predicted_ltv_12m", F.round("predicted_ltv_12m", 2))


@_query
def recommendations_table(spark, sf_dir):
    """Recommendations written, read back as an external table and checked."""
    return _recommendation_check(_stored_table(spark, "product_recommendations", _recommender(spark, sf_dir).top()))


@_query
def item_vectors_table(spark, sf_dir):
    """Item vectors written and read back: length of each, whether it is finite, and still that of the model."""
    vectors = _recommender(spark, sf_dir).item_vectors()
    path = scratch_path(spark, "item-vectors")
    tables.write_table(vectors, path)
    stored = spark.read.parquet(path).select("product_id", F.col("features").alias("kept"), vector_to_array("vec").alias("vec"))
    finite = F.forall("kept", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    same = (F.col("kept") == F.col("features")) & F.forall(
        F.zip_with("vec", "kept", lambda a, b: a == b.cast("double")), lambda x: x
    )
    return stored.join(vectors.drop("vec"), "product_id").select(
        "product_id", F.size("kept").alias("length"), finite.alias("finite"), same.alias("same")
    )


@_query
def item_vectors_check(spark, sf_dir):
    """Per product: length of its vector, and whether all parts are finite."""
    finite = F.forall("features", lambda x: ~F.isnan(x) & (F.abs(x) < float("inf")))
    return _recommender(spark, sf_dir).item_vectors().select(
        "product_id", F.size("features").alias("length"), finite.alias("finite")
    )


@_query
def item_similarity_check(spark, sf_dir):
    """Per product: neighbours, ranked from 1 by falling similarity, none of them itself."""
    similar = _recommender(spark, sf_dir).similar_items()
    before = F.lag("similarity").over(W.partitionBy("item_id").orderBy("rank"))
    falling = F.coalesce(F.col("similarity") <= F.col("before"), F.lit(True))
    return similar.withColumn("before", before).groupBy("item_id").agg(
        F.count(F.lit(1)).alias("neighbours"),
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.bool_and(falling).alias("falling"),
        F.bool_or(F.col("item_id") == F.col("similar_id")).alias("itself"),
    )


@_query
def ltv_regression_check(spark, sf_dir):
    """Per feature: customers in training, and whether the residuals are orthogonal to it.

    That holds for a least squares fit and for no other line.
    """
    sold = fixtures.order_session_sales(spark, sf_dir)
    train = materialize(
        ltv.training_set(sold, fixtures.SALES_AS_OF, C.LTV_HORIZON_MONTHS), "ltv-set"
    )
    model, r2, rmse = ltv.fit(train)
    fitted = model.transform(ltv.assemble(train).filter(ltv.in_training()))
    rest = F.col("label") - F.col("prediction")
    x = F.coalesce(F.col("value"), F.lit(0.0))
    values = F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in (*ltv.FEATURES, "intercept")
    ])
    sums = (
        fitted.withColumn("intercept", F.lit(1.0))
        .select("label", "prediction", F.inline(values))
        .groupBy("feature")
        .agg(
            (F.abs(F.sum(rest * x)) <= 1e-6 * F.sum(F.abs(F.col("label") * x)) + 1e-6).alias("orthogonal"),
        )
    )
    finite = all(abs(v) < float("inf") for v in (r2, rmse))
    return sums.withColumns(
        {"customers": F.lit(train.count()).cast("bigint"), "finite": F.lit(finite and rmse >= 0)}
    )


@_query
def embedding_similarity_topk(spark, sf_dir):
    items = fixtures.table(spark, sf_dir, "embeddings")
    return similarity.cosine_topk(items, C.TOP_K, "vec_id", "embedding").withColumn(
        "similarity", F.round("similarity", 6)
    )


# --- streams -----------------------------------------------------------------


def _drain(spark, rows: DataFrame, label: str) -> DataFrame:
    """Run a stream to the end of its input; return what it wrote."""
    path = scratch_path(spark, label)
    ingest.table_sink(rows, path, scratch_path(spark, f"{label}-state")).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


@_query
def stream_enrich(spark, sf_dir):
    events = fixtures.stream_events(spark, sf_dir)
    located = enrich.enrich(events, _segments(spark).stored())
    return _drain(spark, located, "enriched").drop(
        "processed_ts", "session_id", "price", "payload"
    )


@_query
def stream_raw_delivery(spark, sf_dir):
    """Enriched events delivered as JSON lines by day, then cleaned from the raw zone."""
    located = enrich.enrich(
        fixtures.stream_events(spark, sf_dir), _segments(spark).stored()
    )
    path = scratch_path(spark, "delivered")
    ingest.raw_sink(
        located, path, scratch_path(spark, "delivered-state"), interval=None
    ).awaitTermination()
    return clean.clean(raw.accepted(raw.read_raw(spark, path))).select(
        "event_id", "user_id", "event_type", "product_id", "price", "event_ts", "country", "city"
    )


@_query
def stream_delivery_exactly_once(spark, sf_dir):
    """Delivered in batches; the stream fails behind a written batch, goes on, and old batches are merged."""
    source, path, state = (scratch_path(spark, n) for n in ("lines", "batches", "batches-state"))
    enrich.json_lines(fixtures.raw_events(spark, sf_dir)).repartition(6).write.text(source)
    places = _segments(spark).stored()

    def run(after_write=None):
        rows = raw.accepted(raw.stream_raw(spark, source, max_files=2))
        return delivery.deliver(enrich.enrich(rows, places), path, state, None, after_write)

    def fail(number):
        if number == 1:
            raise RuntimeError("stopped behind the write of a batch")

    try:
        run(fail).awaitTermination()
    except StreamingQueryException:
        pass
    run().awaitTermination()
    delivery.merge(spark, path)
    return clean.clean(raw.accepted(delivery.delivered(spark, path))).select(
        "event_id", "user_id", "event_type", "product_id", "price", "event_ts", "country", "city"
    )


@_query
def stream_record_count(spark, sf_dir):
    """Records of a stream over twenty batches, and those that reached the raw zone."""
    source, path = scratch_path(spark, "lines"), scratch_path(spark, "counted")
    lines = enrich.json_lines(fixtures.raw_events(spark, sf_dir))
    lines.repartition(20).write.text(source)
    rows = raw.accepted(raw.stream_raw(spark, source, max_files=1))
    located = enrich.enrich(rows, _segments(spark).stored())
    query = ingest.raw_sink(located, path, scratch_path(spark, "counted-state"), interval=None)
    counted = ingest.count_until_done(query)
    return spark.read.text(path).agg(F.count(F.lit(1)).alias("delivered")).select(
        F.lit(counted).cast("bigint").alias("records"), "delivered"
    )


def _stream_clean(spark, sf_dir):
    return clean.clean(fixtures.stream_events(spark, sf_dir))


@_query
def stream_dedup(spark, sf_dir):
    events = _stream_clean(spark, sf_dir)
    once = ingest.dedup_stream(events.unionByName(_stream_clean(spark, sf_dir)))
    return _drain(
        spark,
        once.select("event_id", "event_type", "product_id", "user_id", "event_ts", "price"),
        "dedup",
    )


@_query
def stream_live_sessions(spark, sf_dir):
    """Sessions shown early and corrected in several batches; their final versions, one hour before the last event."""
    for key, value in live.STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        source, path, state = (scratch_path(spark, n) for n in ("live-lines", "live", "live-state"))
        every = fixtures.raw_events(spark, sf_dir)
        third = F.ntile(3).over(W.orderBy("day"))
        days = every.select(F.to_date(F.timestamp_millis("timestamp")).alias("day")).distinct().withColumn("third", third)
        placed = every.withColumn("day", F.to_date(F.timestamp_millis("timestamp"))).join(days, "day")
        for n in (1, 2, 3):
            lines = placed.filter(F.col("third") == n).drop("day", "third")
            enrich.json_lines(lines).write.mode("append").text(source)
            events = clean.clean(raw.accepted(raw.stream_raw(spark, source)))
            ingest.table_sink(live.live_sessions(events, delay="1 hour"), path, state).awaitTermination()
        versions = spark.read.parquet(path)
    finally:
        for key in live.STATE_STORE:
            spark.conf.unset(key)
    return versions.filter("final").drop("version", "replaces", "final")


@_query
def stream_sessions(spark, sf_dir):
    """Sessions that are final one hour before the last event."""
    return _drain(
        spark, ingest.session_stream(_stream_clean(spark, sf_dir), delay="1 hour"), "sessions"
    )
