"""Facts, dimensions, aggregates, refreshes, constraints."""

from datetime import date

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.plans import aggregates, dims, facts, refresh, rfm
from clickmart.operators import integrity
from clickmart.sinks import tables
from clickmart.sources import fixtures

DEMO = [
    ("E001", "U001", "purchase", 129.99, "Electronics", "Sony", "mobile"),
    ("E002", "U002", "view", None, "Sports", "Nike", "desktop"),
    ("E003", "U001", "click", None, "Electronics", "Sony", "mobile"),
    ("E004", "U003", "purchase", 89.99, "Sports", "Nike", "tablet"),
    ("E005", "U002", "cart_add", None, "Home", "Keurig", "desktop"),
    ("E006", "U001", "purchase", 79.99, "Home", "Keurig", "mobile"),
]


@pytest.fixture
def demo(spark):
    df = spark.createDataFrame(
        DEMO,
        "event_id string, user_id string, event_type string, price double, category string, "
        "brand string, device_type string",
    )
    return df.withColumn("price", F.col("price").cast("decimal(10,2)"))


def _sales(spark, rows):
    df = spark.createDataFrame(
        rows, "sale_id string, user_id string, product_id string, date_key string, total_amount int"
    )
    return df.withColumns(
        {"date_key": F.to_date("date_key"), "total_amount": F.col("total_amount").cast("decimal(12,2)"),
         "unit_price": F.col("total_amount").cast("decimal(10,2)"), "quantity": F.lit(1)}
    )


def test_customer_activity_golden(demo):
    rows = {r.user_id: (r.frequency, str(r.monetary), str(r.predicted_ltv))
            for r in aggregates.customer_activity(demo, "1.5").collect()}
    assert rows == {
        "U001": (3, "209.98", "314.970"), "U002": (2, "0.00", "0.000"),
        "U003": (1, "89.99", "134.985"),
    }


def test_month_boundary_is_one_period(spark):
    sales = _sales(spark, [("1", "a", "p", "2024-01-31", 10), ("2", "a", "p", "2024-02-01", 5),
                           ("3", "b", "p", "2024-01-05", 1)])
    rows = {(str(r.cohort_month), r.period): (r.active_customers, float(r.revenue), str(r.retention_rate))
            for r in aggregates.cohorts(sales).collect()}
    assert rows == {("2024-01-01", 0): (2, 11.0, "1.0000"), ("2024-01-01", 1): (1, 5.0, "0.5000")}


def test_customer_360_does_not_multiply(spark):
    customers = spark.createDataFrame(
        [("a", "VIP", "Loyal"), ("b", "New", None), ("c", "New", None)],
        "user_id string, customer_segment string, rfm_segment string",
    ).withColumn("ltv_12m", F.lit(1).cast(S.TOTAL))
    sales = _sales(spark, [("1", "a", "p", "2024-01-01", 10), ("2", "a", "p", "2024-01-02", 5),
                           ("3", "b", "p", "2024-01-02", 7)])
    events = spark.createDataFrame([("a", f"e{i}") for i in range(4)], "user_id string, event_id string")
    rows = {r.user_id: (r.total_orders, r.lifetime_spend and float(r.lifetime_spend), r.total_events)
            for r in aggregates.customer_360(customers, sales, events).collect()}
    assert rows == {"a": (2, 15.0, 4), "b": (1, 7.0, 0), "c": (0, None, 0)}
    literal = aggregates.customer_360_literal(customers, sales, events)
    # the textbook join of both facts
    joined = (
        customers.join(sales, "user_id", "left").join(events, "user_id", "left").groupBy("user_id")
        .agg(F.sum("total_amount").alias("spend"), F.count_distinct("sale_id").alias("orders"))
    )
    want = {r.user_id: (r.spend, r.orders) for r in joined.collect()}
    assert {r.user_id: (r.lifetime_spend, r.total_orders) for r in literal.collect()} == want


def test_unsold_products_and_unknown_products(spark):
    products = spark.createDataFrame(
        [("p", "P", "x", "b"), ("q", "Q", None, "b")],
        "product_id string, product_name string, category string, brand string",
    )
    sales = _sales(spark, [("1", "a", "p", "2024-01-01", 10), ("2", "a", "gone", "2024-01-01", 5)])
    rows = {r.product_id: (r.units_sold, r.unique_buyers)
            for r in aggregates.product_performance(products, sales).collect()}
    assert rows == {"p": (1, 1), "q": (None, 0)}
    dates = dims.dim_date_between(spark, "2024-01-01", "2024-01-02")
    assert aggregates.daily_sales(sales, dates, products).first().total_orders == 1
    # a null category is a group of its own
    null_sales = _sales(spark, [("1", "a", "q", "2024-01-01", 10), ("2", "b", "q", "2024-01-01", 5)])
    row = aggregates.daily_sales(null_sales, dates, products).collect()
    assert [(r.category, r.total_orders, r.unique_customers) for r in row] == [(None, 2, 2)]


def test_dim_date(spark):
    holidays = spark.createDataFrame([(date(2024, 1, 1),)], "date_key date")
    bounds = dims.date_bounds(spark.createDataFrame([("2024-01-06",), ("2024-01-01",)], "d string"), "d")
    rows = dims.dim_date(bounds, holidays).orderBy("date_key").collect()
    assert [r.day for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r.is_holiday for r in rows] == [True] + [False] * 5
    assert (rows[5].day_of_week, rows[5].is_weekend, rows[0].is_weekend) == ("Saturday", True, False)


def test_margin_and_defaults(spark):
    df = spark.createDataFrame([("p", 80.0, 60.0), ("q", 80.0, None), ("r", 0.0, 1.0)],
                               "product_id string, price double, cost double")
    rows = {r.product_id: (r.margin_pct, r.is_active) for r in dims.dim_product(df).collect()}
    assert {k: (str(m), a) for k, (m, a) in rows.items()} == {
        "p": ("25.00", True), "q": ("None", True), "r": ("None", True)
    }


def test_fact_sales_contract(spark, sf):
    from clickmart.operators import sessions

    sales = facts.fact_sales(sessions.sessionize(fixtures.clean_events(spark, sf)))
    assert sales.schema.names == S.FACT_SALES.names
    row = sales.first()
    assert row.quantity == 1 and row.discount_amount == 0 and row.total_amount == row.unit_price
    amount = facts.total_amount(
        F.lit(3), F.lit("2.50").cast(S.PRICE), F.lit("0.50").cast(S.PRICE), F.lit(None).cast(S.PRICE)
    )
    assert str(spark.range(1).select(amount).first()[0]) == "7.00"


def test_state_merge_is_idempotent(spark, sf):
    events = fixtures.clean_events(spark, sf).withColumns(
        {"country": F.lit("US"), "city": F.col("hour").cast("string")}
    )
    first, second = events.filter("date < '2024-01-20'"), events.filter("date >= '2024-01-10'")
    for state, merge, show in (
        (dims.user_state, dims.merge_user_states, dims.activity_of_state),
        (dims.product_state, dims.merge_product_states, dims.products_of_state),
    ):
        merged = merge(merge(state(first), state(second)), state(second))
        whole = show(state(events))
        assert show(merged).exceptAll(whole).count() == 0 and merged.count() == whole.count()


def test_session_dimension_both_ways(spark, sf):
    from clickmart.operators import sessions

    events = fixtures.clean_events(spark, sf)
    stored = dims.sessions_of_curated(sessions.sessionize(events)).drop("start_date")
    direct = dims.dim_session(events)
    assert stored.count() == direct.count() and stored.exceptAll(direct).count() == 0


def test_refresh_on_storage(spark, tmp_path):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-03", 3)],
                                "d string, n int").withColumn("d", F.to_date("d"))
    tables.write_partitions(old, path, ["d"])
    new = spark.createDataFrame([("2024-01-01", 10), ("2024-01-02", 20)], "d string, n int").withColumn(
        "d", F.to_date("d")
    )
    for _ in range(2):
        tables.refresh_window(spark, path, new, "d", F.col("d") >= F.lit("2024-01-02").cast("date"))
        rows = sorted((str(r.d), r.n) for r in spark.read.parquet(path).collect())
        assert rows == [("2024-01-01", 1), ("2024-01-02", 20)]


def test_cohort_refresh_keeps_keys_unique(spark, sf):
    sales = fixtures.fact_sales(spark, sf)
    cohorts = aggregates.cohorts(sales)
    once = refresh.refresh_cohorts(cohorts, sales, "1998-05-31")
    twice = refresh.refresh_cohorts(once, sales, "1998-05-31")
    key = ["cohort_month", "period"]
    assert twice.count() == twice.select(*key).distinct().count() == cohorts.count()
    assert twice.exceptAll(cohorts).count() == 0
    assert cohorts.filter("period = 0 AND retention_rate <> 1").count() == 0


def test_integrity(spark):
    sales = spark.createDataFrame([("1", "a"), ("1", "b"), ("2", "z"), ("3", None)], "sale_id string, user_id string")
    users = spark.createDataFrame([("a",), ("b",)], "user_id string")
    report = integrity.report([
        integrity.primary_key(sales, "s", ["sale_id"]),
        integrity.foreign_key(sales, "s", "user_id", users, "user_id"),
        integrity.not_null(sales, "s", ["sale_id", "user_id"]),
    ])
    assert {(r.check_kind, r.column_name): r.violations for r in report.collect()} == {
        ("primary_key", "sale_id"): 1, ("foreign_key", "user_id"): 1,
        ("not_null", "sale_id"): 0, ("not_null", "user_id"): 1,
    }
    filled = integrity.with_defaults(
        spark.createDataFrame([(None,), (5,)], "quantity int"), {"quantity": 1, "kind": "x"}
    )
    assert [tuple(r) for r in filled.collect()] == [(1, "x"), (5, "x")]


def test_broken_rows_are_quarantined_with_their_reasons(spark, tmp_path):
    from pyspark.sql import types as T

    sales = fixtures.fact_sales(spark, "/root/testdata/sf0.001").limit(3).withColumn("place", F.row_number().over(
        W.orderBy("sale_id", "product_id")
    ))
    bad = sales.withColumns({
        "user_id": F.when(F.col("place") == 1, F.lit("nobody")).otherwise(F.col("user_id")),
        "unit_price": F.when(F.col("place") != 1, F.col("unit_price")),
    }).drop("place")
    users = bad.filter("user_id != 'nobody'").select("user_id")
    out = {}
    report = integrity.write_checked(
        bad, "fact_sales", {"dim_customer": users}, lambda df: out.update(kept=df.collect()), lambda df: out.update(refused=df.collect())
    )
    assert isinstance(report.schema, T.StructType) and len(out["kept"]) == 2
    assert [r.reason for r in out["refused"]] == ["not_null unit_price, foreign_key user_id"]
    found = {(r.check_kind, r.column_name): r.violations for r in report.collect()}
    assert found["foreign_key", "user_id"] == found["not_null", "unit_price"] == found["refused", ""] == 1


def test_segment_rules(spark):
    rows = [((5, 5, 5), "Champions"), ((1, 5, 1), "Loyal"), ((2, 3, 1), "At Risk"), ((5, 1, 1), "New"),
            ((1, 1, 1), "Lost"), ((3, 3, 3), "Regular")]
    df = spark.createDataFrame([r for r, _ in rows], "r int, f int, m int")
    got = df.select(rfm.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()
    assert [r.s for r in got] == [s for _, s in rows]


def test_midnight_session_counts_once(spark):
    rows = [("s1", "a", 10.0, ["x"], "2024-01-01", "mobile"), ("s1", "a", 5.0, ["y", "x"], "2024-01-02", "tablet"),
            ("s2", "a", 1.0, ["z"], "2024-01-03", "tablet")]
    sold = spark.createDataFrame(
        rows, "session_id string, user_id string, total_revenue double, categories_purchased array<string>, "
        "date string, device_type string"
    ).withColumns({"date": F.to_date("date"), "total_revenue": F.col("total_revenue").cast(S.TOTAL)})
    row = rfm.metrics(sold, "2024-01-31").first()
    assert (row.frequency, float(row.monetary), row.recency_days) == (2, 16.0, 28)
    assert row.categories == ["x", "y", "z"] and row.category_diversity == 3
    assert row.preferred_device == "mobile" and str(row.aov) == "8.00"


def test_bucketed_facts_join_without_shuffle(spark, tmp_path):
    from conftest import plan

    sales = _sales(spark, [(str(i), f"u{i % 9}", "p", "2024-01-01", i) for i in range(100)])
    for name in ("sales_b", "events_b"):
        tables.write_bucketed(sales, name, str(tmp_path / name), 4, "user_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_user = spark.table("sales_b").groupBy("user_id").agg(F.sum("total_amount"))
        joined = per_user.join(spark.table("events_b"), "user_id")
        assert joined.count() == 100
        assert "Exchange" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("sales_b", "events_b"):
            spark.sql(f"DROP TABLE {name}")


def test_one_large_date_is_split_on_write(spark, tmp_path):
    """Rebalanced writing does not send a whole date to one task."""
    path = str(tmp_path / "t")
    df = spark.range(300_000).select(F.lit("2024-01-01").alias("d"), F.sha2(F.col("id").cast("string"), 512).alias("x"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        tables.write_partitions(df, path, ["d"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() > 1
    assert spark.read.parquet(path).count() == 300_000


def _scans(df, table):
    """Scans of one file in the plan that ran, shared stages once."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    return len([line for line in final.splitlines() if "FileScan" in line and f"{table}.parquet" in line])


def test_daily_sales_reads_the_facts_once(spark, sf):
    from clickmart.plans import aggregates, dims
    from clickmart.sources import fixtures

    sold = fixtures.fact_sales(spark, sf)
    dates = dims.dim_date(dims.date_bounds(fixtures.table(spark, sf, "orders"), "o_orderdate"))
    products = dims.dim_product(fixtures.product_source(spark, sf))
    assert _scans(aggregates.daily_sales(sold, dates, products), "lineitem") == 1


@pytest.mark.parametrize("name", ["customer_360", "integrity_report", "daily_sales_refresh"])
def test_order_lines_are_stored_once(spark, sf, name, monkeypatch):
    """The plan of the result reads the stored facts; only the store reads the lines."""
    from clickmart import queries

    stored = []
    keep = queries.materialize
    monkeypatch.setattr(queries, "materialize", lambda df, label: stored.append(label) or keep(df, label))
    df = queries.queries()[name](spark, sf)
    assert stored.count("fact-sales") == 1 and _scans(df, "lineitem") == 0
