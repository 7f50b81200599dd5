"""Sessions: golden rows, edges, properties, and the same result as a plain window."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart.operators import sales, sessions
from clickmart.plans import dims
from clickmart.sources import fixtures
from conftest import plan

T0 = datetime(2024, 1, 1)


def events_of(spark, rows):
    """Rows of (user, seconds[, type, price, category, device])."""
    full = []
    for i, (user, seconds, *more) in enumerate(rows):
        kind, price, category, device = more or ("view", None, "c", "mobile")
        at = T0 + timedelta(seconds=seconds)
        full.append((f"e{i:04}", user, kind, price, category, device, at))
    schema = (
        "event_id string, user_id string, event_type string, price double, category string, "
        "device_type string, event_ts timestamp"
    )
    return (
        spark.createDataFrame(full, schema)
        .withColumn("price", F.col("price").cast("decimal(10,2)"))
        .withColumn("date", F.to_date("event_ts"))
    )


def reference(events, gap):
    """The textbook form: lag and running sum per user."""
    w = W.partitionBy("user_id").orderBy("event_ts")
    delta = F.unix_micros("event_ts") - F.lag(F.unix_micros("event_ts")).over(w)
    new = F.when(delta.isNull() | (delta > int(gap * 1_000_000)), 1).otherwise(0)
    return events.withColumn("_n", new).withColumn("session_seq", F.sum("_n").over(w)).drop("_n")


def seqs(df):
    return sorted((r.event_id, r.session_seq) for r in df.select("event_id", "session_seq").collect())


# user, second, session with a 30 s gap, session with an 1800 s gap
GOLDEN = [
    ("U001", 1000, 1, 1),
    ("U001", 1100, 2, 1),
    ("U001", 4000, 3, 2),
    ("U002", 2000, 1, 1),
    ("U002", 2100, 2, 1),
]


@pytest.mark.parametrize("gap, column", [(30, 2), (1800, 3)])
def test_golden_rows(spark, gap, column):
    events = events_of(spark, [(r[0], r[1]) for r in GOLDEN])
    assert [s for _, s in seqs(sessions.sessionize(events, gap))] == [r[column] for r in GOLDEN]


def test_gap_is_exact(spark):
    events = events_of(spark, [("a", 0), ("a", 1800), ("b", 0), ("b", 1800.001), ("c", 0), ("c", 0)])
    assert [s for _, s in seqs(sessions.sessionize(events))] == [1, 1, 1, 2, 1, 1]


def test_times_before_the_epoch(spark):
    base = -(T0 - datetime(1970, 1, 1)).total_seconds()
    events = events_of(spark, [("a", base - 1700), ("a", base + 200), ("a", base + 1900)])
    assert seqs(sessions.sessionize(events)) == seqs(reference(events, 1800))


def test_session_ids_are_unique_and_name_the_start(spark):
    events = events_of(spark, [("a", 0), ("a", 5000), ("b", 0)])
    rows = sessions.sessionize(events).select("session_id").distinct().collect()
    start = int((T0 - datetime(1970, 1, 1)).total_seconds()) * 1000
    assert sorted(r[0] for r in rows) == [f"a-{start}", f"a-{start + 5_000_000}", f"b-{start}"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("abc"), st.integers(0, 400).map(lambda s: s / 2)),
        min_size=1, max_size=40,
    ),
    st.sampled_from([1, 7, 30]),
)
def test_same_as_window_form(spark, rows, gap):
    events = events_of(spark, rows)
    assert seqs(sessions.sessionize(events, gap)) == seqs(reference(events, gap))


@pytest.mark.parametrize("split", [90, 130, 3000])
def test_runs_continue_open_sessions(spark, split):
    rows = [("a", s) for s in (0, 100, 110, 125, 140, 5000)] + [("b", 50), ("c", 4000)]
    events = events_of(spark, rows)
    cut = F.col("event_ts") < F.lit(T0 + timedelta(seconds=split))
    first, second = events.filter(cut), events.filter(~cut)
    state = sessions.last_sessions(first, 30)
    both = sessions.sessionize(first, 30).unionByName(sessions.sessionize(second, 30, state))
    assert seqs(both) == seqs(sessions.sessionize(events, 30))
    whole = {tuple(r) for r in sessions.last_sessions(events, 30).collect()}
    assert {tuple(r) for r in sessions.last_sessions(second, 30, state).collect()} == whole


def test_session_sales_over_midnight(spark):
    day = 86400
    events = events_of(
        spark,
        [
            ("a", day - 100, "purchase", 10.0, "x", "mobile"),
            ("a", day + 100, "purchase", 20.0, "y", "tablet"),
            ("a", day + 200, "purchase", 5.0, "x", "tablet"),
            ("a", day + 300, "view", None, "z", "tablet"),
            ("b", 0, "view", None, "x", "mobile"),
        ],
    )
    rows = sorted(
        (str(r.date), float(r.total_revenue), r.items_purchased, r.categories_purchased, r.device_type)
        for r in sales.session_sales(events).collect()
    )
    assert rows == [
        ("2024-01-01", 10.0, 1, ["x"], "mobile"),
        ("2024-01-02", 25.0, 2, ["x", "y"], "tablet"),
    ]
    assert sales.session_sales(events).select("session_id").distinct().count() == 1
    via_events = sales.sales_of_sessions(sessions.sessionize(events))
    assert via_events.exceptAll(sales.session_sales(events)).count() == 0


def test_two_ways_to_session_sales_agree(spark, sf):
    events = fixtures.clean_events(spark, sf)
    one, two = sales.session_sales(events), sales.sales_of_sessions(sessions.sessionize(events))
    assert one.count() == two.count() == 200
    assert one.exceptAll(two).count() == 0


def test_session_window_form_agrees(spark, sf):
    events = fixtures.clean_events(spark, sf)
    built_in = sessions.session_windows(events).select("user_id", "session_start", "session_end")
    rollup = sessions.session_rollup(events).select("user_id", "session_start", "session_end")
    assert built_in.count() == 946
    assert built_in.exceptAll(rollup).count() == 0


def test_a_heavy_user_is_not_gathered(spark):
    """A third of all events in one cell of one user: the window sees one row of it."""
    n = 30_000
    quiet = spark.range(2 * n).select(
        F.concat(F.lit("u"), F.col("id") % 5000).alias("user_id"),
        F.timestamp_millis(F.col("id") * 7001 % 2_000_000_000).alias("event_ts"),
    )
    heavy = spark.range(n).select(
        F.lit("bot").alias("user_id"), F.timestamp_millis(F.col("id") % 1000).alias("event_ts")
    )
    events = quiet.unionByName(heavy)
    cells = sessions.cells(events)
    assert cells.filter("user_id = 'bot'").count() == 1
    done = sessions.sessionize(events)
    assert done.count() == 3 * n
    assert done.filter("user_id = 'bot'").select("session_id").distinct().count() == 1


def test_no_event_is_shuffled_for_session_sales(spark, sf):
    """Both exchanges lie above a partial aggregation, none is global."""
    text = plan(sales.session_sales(fixtures.clean_events(spark, sf)))
    assert "SinglePartition" not in text
    assert text.count("Exchange hashpartitioning") == 2
    below_first_exchange = text[text.rindex("Exchange hashpartitioning"):]
    assert "partial_sum" in below_first_exchange


@pytest.mark.parametrize("build", [
    sales.session_sales, dims.dim_session, lambda e: sales.sales_of_sessions(sessions.sessionize(e)),
    lambda e: dims.sessions_of_curated(sessions.sessionize(e)),
])
def test_events_are_aggregated_by_hash(spark, sf, build):
    """Sorted or object aggregation only reads rows that were aggregated before."""
    lines = plan(build(fixtures.clean_events(spark, sf))).splitlines()
    first = {}
    for depth, line in ((len(line) - len(line.lstrip(" :+-*()0123456789")), line) for line in lines):
        if "Aggregate(" in line:
            first[depth] = line
    deepest = max(first)
    assert "HashAggregate" in first[deepest] and "Object" not in first[deepest]
    assert sum("SortAggregate" in line or "ObjectHashAggregate" in line for line in lines) <= 2


def test_the_first_device_among_ties(spark):
    """Same time: the smaller id decides; missing ids and devices come first and last."""
    rows = [("u", 0, "b", "web"), ("u", 0, "a", "app"), ("v", 5, "10", "x"), ("v", 5, "9", "y"), ("w", 1, "q", None)]
    events = spark.createDataFrame(
        [(u, i, d, datetime(2024, 1, 1, 0, 0, t), "purchase", "c", "p") for u, t, i, d in rows],
        "user_id string, event_id string, device_type string, event_ts timestamp, event_type string, category string, product_id string",
    ).withColumns({"date": F.to_date("event_ts"), "price": F.lit(1).cast("decimal(10,2)")})
    want = {"u": "app", "v": "x", "w": None}
    assert {r.user_id: r.device_type for r in sales.session_sales(events).collect()} == want
    assert {r.user_id: r.device_type for r in dims.dim_session(events).collect()} == want


def test_a_heavy_cell_is_split_in_the_join(spark):
    """With sizes scaled down, adaptive execution splits the partition of the heavy cell."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    events = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "bot").otherwise(F.concat(F.lit("u"), F.col("id") % 3000)).alias("user_id"),
        F.timestamp_millis(F.when(F.col("id") % 3 == 0, F.col("id") % 1000).otherwise(F.col("id") * 7001)).alias("event_ts"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        done = sessions.sessionize(events)
        assert len(done.collect()) == 60_000
        assert "skew=true" in plan(done)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)

