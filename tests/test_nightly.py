"""The daily run: days one by one give the tables of one load; reruns change nothing."""

import pytest
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart import storage
from clickmart.operators import clean, geo, sales, sessions
from clickmart.plans import aggregates, curation, dims, facts, nightly
from clickmart.sources import catalog, fixtures

DAYS = ["2024-01-03", "2024-01-04"]


@pytest.fixture(scope="module")
def raw_path(spark, tmp_path_factory):
    """Enriched raw events, delivered on the day they happened, in json folders."""
    path = str(tmp_path_factory.mktemp("raw") / "events")
    from conftest import SF

    segments = geo.segments(geo.ranges(fixtures.geo_table(spark)))
    day = F.timestamp_millis("timestamp")
    rows = geo.locate(fixtures.raw_events(spark, SF), segments).withColumns(
        {"processed_ts": day, "source": F.lit("test"), "year": F.date_format(day, "yyyy"),
         "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    )
    rows.filter(F.to_date(day) <= DAYS[-1]).write.partitionBy("year", "month", "day").json(path)
    return path


def _expected(spark, sf):
    events = clean.clean(fixtures.raw_events(spark, sf)).filter(F.col("date") <= DAYS[-1])
    return events


def _same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


@pytest.fixture(scope="module")
def lake(spark, raw_path, tmp_path_factory):
    """First load up to the first day, then day by day, the last day twice."""
    layout = nightly.Layout(str(tmp_path_factory.mktemp("lake")))
    since = "2024-01-01"
    for as_of in DAYS:
        nightly.curate(spark, raw_path, layout, as_of, since)
        nightly.build_warehouse(spark, layout, as_of)
        since = None
    nightly.run(spark, raw_path, layout, DAYS[-1])
    return layout


def test_scratch_is_removed(spark, lake):
    root = storage.scratch_path(spark, "x").rsplit("/", 1)[0]
    with storage.scratch_scope(spark):
        path = storage.scratch_path(spark, "inner")
        spark.range(3).write.parquet(path)
        assert storage.path_exists(spark, path)
    assert not storage.path_exists(spark, path)
    assert not [n for n in storage.list_names(spark, root) if n.startswith("scope-")]


def test_old_states_are_pruned(spark, tmp_path):
    layout = nightly.Layout(str(tmp_path))
    for n in range(4):
        spark.range(1).write.parquet(layout.path(f"{curation.LAST}/{n}"))
    nightly.prune_states(spark, layout)
    assert storage.list_names(spark, layout.path(curation.LAST)) == ["2", "3"]


def test_events_and_sales(spark, sf, lake):
    events = _expected(spark, sf)
    want = sessions.sessionize(events).select("event_id", "session_id", "session_seq")
    got = lake.read(spark, "curated/events", S.CURATED_EVENT)
    assert _same(got.select("event_id", "session_id", "session_seq"), want)
    assert got.filter("country IS NULL").count() == 0
    assert _same(lake.read(spark, "curated/sales", S.SESSION_SALES), sales.session_sales(events))


def test_warehouse(spark, sf, lake):
    events = _expected(spark, sf)
    curated = sessions.sessionize(events)
    fact = lake.read(spark, "warehouse/fact_sales", S.FACT_SALES)
    assert _same(fact, facts.fact_sales(curated))
    assert lake.read(spark, "warehouse/fact_user_events", S.FACT_USER_EVENTS).count() == events.count()
    assert _same(
        lake.read(spark, "warehouse/dim_session", S.DIM_SESSION_STORED).select(*S.DIM_SESSION.names),
        dims.dim_session(events),
    )
    customers = lake.read(spark, "warehouse/dim_customer", S.DIM_CUSTOMER)
    assert customers.count() == events.select("user_id").distinct().count()
    products = lake.read(spark, "warehouse/dim_product", S.DIM_PRODUCT)
    assert _same(
        products.select("product_id", "category", "price", "created_date"),
        dims.dim_product(dims.products_of_events(events)).select(
            "product_id", "category", "price", "created_date"
        ),
    )
    dates = dims.dim_date(dims.date_bounds(events, "date"))
    assert _same(lake.read(spark, "warehouse/dim_date", S.DIM_DATE), dates)
    assert _same(
        lake.read(spark, "warehouse/aggr_daily_sales", S.AGGR_DAILY_SALES),
        aggregates.daily_sales(fact, dates, products),
    )
    assert _same(
        lake.read(spark, "warehouse/aggr_customer_cohort", S.AGGR_CUSTOMER_COHORT),
        aggregates.cohorts(fact),
    )
    assert _same(
        lake.read(spark, "mv/daily_category", S.DAILY_CATEGORY_METRICS),
        aggregates.daily_category_metrics(events),
    )


def test_the_run_reports_every_constraint(spark, lake):
    from clickmart.operators import integrity

    rows = spark.read.parquet(lake.path(f"quality/{DAYS[-1]}")).collect()
    found = {(r.table_name, r.check_kind, r.column_name): r.violations for r in rows}
    for table, declared in integrity.DECLARED.items():
        assert (table, "primary_key", ",".join(declared.key)) in found
        assert all((table, "not_null", c) in found for c in declared.not_null)
        assert all((table, "foreign_key", c) in found for c in declared.parents or {})
    assert not any(found.values())
    assert not storage.list_names(spark, lake.path("quarantine"))


def test_features(spark, lake):
    buyers = lake.read(spark, "curated/sales", S.SESSION_SALES).select("user_id").distinct().count()
    assert spark.read.parquet(lake.path("features/customer_ltv")).count() == buyers
    recs = lake.read(spark, "features/recommendations", S.PRODUCT_RECOMMENDATIONS)
    assert recs.groupBy("user_id").count().agg(F.max("count")).first()[0] == 10
    assert spark.read.parquet(lake.path("features/item_similarity")).count() > 0


def test_files_are_read_once(spark, raw_path, lake, tmp_path):
    everything = curation.new_files(spark, raw_path, nightly.Layout(str(tmp_path)))
    since = curation.new_files(spark, raw_path, nightly.Layout(str(tmp_path)), DAYS[-1])
    assert 0 < since.count() < everything.count()
    assert all("day=04" in r.path for r in since.collect())
    assert curation.new_files(spark, raw_path, lake).count() == 0


def test_catalog(spark, lake, raw_path):
    before = spark.catalog.currentDatabase()
    try:
        catalog.register(spark, "clickmart_test", lake.root)
        assert spark.table("clickmart_test.curated_sales").count() == lake.read(
            spark, "curated/sales", S.SESSION_SALES
        ).count()
        pruned = spark.table("clickmart_test.curated_events").filter(f"date = DATE '{DAYS[0]}'")
        assert pruned.count() > 0
        assert "PartitionFilters: []" not in pruned._jdf.queryExecution().executedPlan().toString()
        assert spark.table("clickmart_test.dim_customer").count() > 0
        schema = catalog.discover(spark, "clickmart_test", "found", raw_path)
        assert {"user_id", "year", "month", "day"} <= set(schema.names)
        assert spark.table("clickmart_test.found").count() == lake.read(
            spark, "curated/events", S.CURATED_EVENT
        ).count()
        assert spark.table("clickmart_test.found").filter("day = 4").count() > 0
    finally:
        spark.sql(f"USE {before}")
        spark.sql("DROP DATABASE IF EXISTS clickmart_test CASCADE")


def test_merge_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", 1)], "k string, n int").write.parquet(path)
    both = catalog.merge_schema(spark, path, spark.createDataFrame([("b", "x")], "k string, note string"))
    assert sorted((r.k, r.n, r.note) for r in both.collect()) == [("a", 1, None), ("b", None, "x")]


def test_views(spark, lake):
    aggregates.create_views(
        lake.read(spark, "warehouse/dim_customer", S.DIM_CUSTOMER),
        lake.read(spark, "warehouse/dim_product", S.DIM_PRODUCT),
        lake.read(spark, "warehouse/fact_sales", S.FACT_SALES),
        lake.read(spark, "warehouse/fact_user_events", S.FACT_USER_EVENTS),
    )
    total = spark.sql("SELECT sum(lifetime_spend) FROM vw_customer_360").first()[0]
    assert total == spark.sql("SELECT sum(total_revenue) FROM vw_product_performance").first()[0]


def _deliver(spark, path, delivered, rows, broken=()):
    """Events (id, user, day of the event) into the folder of the day of delivery."""
    import datetime as dt
    import json
    import os

    year, month, day = delivered.split("-")
    folder = f"{path}/year={year}/month={month}/day={day}"
    os.makedirs(folder, exist_ok=True)
    lines = []
    for event_id, user, happened in rows:
        at = dt.datetime.fromisoformat(f"{happened}T12:00:00+00:00").timestamp()
        lines.append(json.dumps({"event_id": event_id, "user_id": user, "event_type": "view",
                                 "product_id": "p", "timestamp": int(at * 1000)}))
    with open(f"{folder}/{len(os.listdir(folder))}.json", "w") as out:
        out.write("\n".join([*lines, *broken]) + "\n")


def _curated(spark, layout):
    rows = layout.read(spark, "curated/events", S.CURATED_EVENT).collect()
    return {r.event_id: (str(r.date), r.session_seq) for r in rows}


def test_late_and_early_events_are_not_lost(spark, tmp_path):
    path, layout = str(tmp_path / "raw"), nightly.Layout(str(tmp_path / "lake"))
    days = [f"2024-01-{d:02d}" for d in range(5, 11)]
    for day in days:
        rows = [(f"own-{day}", "u", day)]
        if day == "2024-01-05":
            rows.append(("early", "u", "2024-01-10"))  # stamped five days ahead
        if day == "2024-01-10":
            rows.append(("late", "u", "2024-01-05"))  # five days late, before the day's own event
        _deliver(spark, path, day, rows, ["{broken"] if day == "2024-01-06" else ())
        nightly.curate(spark, path, layout, day, since=days[0] if day == days[0] else None)
    got = _curated(spark, layout)
    assert set(got) == {"early", "late", *[f"own-{d}" for d in days]}
    assert got["early"][0] == "2024-01-10" and got["late"][0] == "2024-01-05"
    # one session per day, numbered as if all had come in time
    assert [got[f"own-{d}"][1] for d in days] == [1, 2, 3, 4, 5, 6] and got["late"][1] == 1
    refused = spark.read.parquet(layout.path("rejected/2024-01-06")).collect()
    assert [(r.line, r.reason) for r in refused] == [("{broken", "unreadable")]
    assert not spark.read.parquet(layout.path("rejected/2024-01-07")).count()
    before = _curated(spark, layout)
    nightly.curate(spark, path, layout, days[-1])
    assert _curated(spark, layout) == before


def test_late_days_refuse_with_a_reason(spark, tmp_path):
    path, layout = str(tmp_path / "raw"), nightly.Layout(str(tmp_path / "lake"))
    _deliver(spark, path, "2024-01-05", [("a", "u", "2024-01-05")])
    nightly.curate(spark, path, layout, "2024-01-05", since="2024-01-05")
    _deliver(spark, path, "2024-01-06", [("b", "u", "2024-01-06"), ("old", "u", "2024-01-02")])
    nightly.curate(spark, path, layout, "2024-01-06", late_days=2)
    assert set(_curated(spark, layout)) == {"a", "b"}
    refused = spark.read.parquet(layout.path("rejected/2024-01-06")).collect()
    assert [r.reason for r in refused] == ["late"] and '"event_id":"old"' in refused[0].line


def test_a_failed_state_write_loses_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "state")
    merge = lambda old, new: old.unionByName(new)
    first = spark.createDataFrame([(1,)], "k int")
    nightly._merged_state(spark, path, first, merge, "2024-01-01")

    def fail(df, target):
        raise OSError("disk full")

    monkeypatch.setattr(nightly.tables, "write_table", fail)
    with pytest.raises(OSError):
        nightly._merged_state(spark, path, first, merge, "2024-01-02")
    monkeypatch.undo()
    merged = nightly._merged_state(spark, path, spark.createDataFrame([(2,)], "k int"), merge, "2024-01-02")
    assert sorted(r.k for r in merged.collect()) == [1, 2]


def test_discovery_reads_every_line(spark, tmp_path):
    folder = tmp_path / "raw" / "day=1"
    folder.mkdir(parents=True)
    lines = ['{"id": %d, "price": 5}' % i for i in range(2999)] + ['{"id": 2999, "price": 5.5, "coupon": "x"}']
    (folder / "a.json").write_text("\n".join(lines) + "\n")
    try:
        spark.sql("CREATE DATABASE IF NOT EXISTS clickmart_found")
        catalog.discover(spark, "clickmart_found", "found", str(tmp_path / "raw"))
        row = spark.table("clickmart_found.found").filter("coupon IS NOT NULL").first()
        assert (row.price, row.coupon, row.day) == (5.5, "x", 1)
        other = tmp_path / "raw" / "hour=2"
        other.mkdir()
        (other / "b.json").write_text(lines[0] + "\n")
        with pytest.raises(Exception, match="(?i)partition"):
            catalog.discover(spark, "clickmart_found", "found", str(tmp_path / "raw"))
    finally:
        spark.sql("DROP DATABASE IF EXISTS clickmart_found CASCADE")


def _listing(layout, table):
    """File names by partition folder."""
    import os

    root = layout.path(table)
    return {
        folder: sorted(n for n in os.listdir(f"{root}/{folder}") if n.endswith(".parquet"))
        for folder in os.listdir(root) if "=" in folder
    }


def _rebuilt(spark, path):
    """Sessions of all events of a raw zone, computed at once."""
    from clickmart.sources import raw

    rows = sessions.sessionize(clean.clean(raw.accepted(raw.read_raw(spark, path)))).collect()
    return {r.event_id: (str(r.date), r.session_seq, r.session_id) for r in rows}


def _sessioned(spark, layout):
    rows = layout.read(spark, "curated/events", S.CURATED_EVENT).collect()
    return {r.event_id: (str(r.date), r.session_seq, r.session_id) for r in rows}


@pytest.fixture
def zone(spark, tmp_path):
    """Four days of three users; the last one is there on one day only."""
    path, layout = str(tmp_path / "raw"), nightly.Layout(str(tmp_path / "lake"))
    for d in range(5, 9):
        day = f"2024-01-0{d}"
        rows = [(f"{u}-{d}", u, day) for u in ("a", "b")] + ([("c-6", "c", day)] if d == 6 else [])
        _deliver(spark, path, day, rows)
        nightly.curate(spark, path, layout, day)
    return path, layout


def test_an_event_a_year_late_changes_its_users_days_only(spark, zone):
    path, layout = zone
    before, ends = _listing(layout, "curated/events"), _listing(layout, curation.INTERVALS)
    _deliver(spark, path, "2024-01-09", [("stray", "c", "2023-01-09"), ("a-9", "a", "2024-01-09")])
    days = nightly.curate(spark, path, layout, "2024-01-09")
    assert days == ["2023-01-09", "2024-01-06", "2024-01-09"]
    after = _listing(layout, "curated/events")
    changed = {folder for folder in after if after[folder] != before.get(folder)}
    assert changed == {f"date={d}" for d in days}
    found = _listing(layout, curation.INTERVALS)
    assert {f for f in found if found[f] != ends.get(f)} == {f"last_date={d}" for d in days}
    assert _sessioned(spark, layout) == _rebuilt(spark, path)
    assert _sessioned(spark, layout)["c-6"][1] == 2


def test_late_events_extend_and_join_sessions(spark, tmp_path):
    """Minutes apart, in the worst order: starts move, sessions join, later numbers fall."""
    import datetime as dt
    import json
    import random

    path, layout = str(tmp_path / "raw"), nightly.Layout(str(tmp_path / "lake"))
    rng = random.Random(11)
    start = dt.datetime(2024, 1, 5, 20, tzinfo=dt.timezone.utc).timestamp()
    rows = [(f"{u}{i}", u, start + rng.randrange(0, 60 * 60 * 30, 300)) for u in "xyz" for i in range(60)]
    rng.shuffle(rows)
    views = {}
    for n in range(4):
        folder = tmp_path / "raw" / "year=2024" / "month=01" / f"day=0{5 + n % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [json.dumps({"event_id": e, "user_id": u, "event_type": "view", "product_id": e,
                             "timestamp": int(t * 1000)}) for e, u, t in rows[n::4]]
        (folder / f"{n}.json").write_text("\n".join(lines) + "\n")
        nightly.curate(spark, path, layout, "2024-01-07")
        assert _sessioned(spark, layout) == _rebuilt(spark, path)
        from clickmart.sources import raw

        events = clean.clean(raw.accepted(raw.read_raw(spark, path)))
        stored = dims.sessions_of_intervals(layout.read(spark, curation.INTERVALS, S.SESSION_INTERVAL))
        assert _same(stored.select(*S.DIM_SESSION.names), dims.dim_session(events))
        views[n] = stored.agg(F.sum("page_views")).first()[0]
    assert list(views.values()) == [45, 90, 135, 180]


def test_a_run_that_was_cut_off_is_finished(spark, zone, monkeypatch):
    path, layout = zone
    _deliver(spark, path, "2024-01-09", [("stray", "c", "2023-01-09"), ("a-9", "a", "2024-01-09")], ["{broken"])

    def cut(*_args, **_kwargs):
        raise OSError("gone")

    for step in ("write_partitions", "replace_partitions"):
        with monkeypatch.context() as patch:
            patch.setattr(curation.tables, step, cut)
            with pytest.raises(OSError):
                nightly.curate(spark, path, layout, "2024-01-09")
    _deliver(spark, path, "2024-01-06", [("b-old", "b", "2024-01-07")])
    nightly.curate(spark, path, layout, "2024-01-09")
    assert _sessioned(spark, layout) == _rebuilt(spark, path)
    assert curation.new_files(spark, path, layout).count() == 0
    refused = spark.read.parquet(layout.path("rejected/2024-01-09")).collect()
    assert [r.line for r in refused] == ["{broken"]


def test_a_file_in_an_older_folder_is_read_once(spark, zone):
    path, layout = zone
    _deliver(spark, path, "2024-01-05", [("b-more", "b", "2024-01-08")])
    read = []
    for _ in range(2):
        nightly.curate(spark, path, layout, "2024-01-08", on_plan=lambda p: read.append(p.read("files", "path string").count()))
    assert read == [1, 0] and "b-more" in _sessioned(spark, layout)


def test_an_active_client_moves_only_its_own_days(spark, tmp_path):
    """A session that has lasted for days: its start's partition of the dimension changes, no other old one."""
    import datetime as dt
    import json

    path, layout = str(tmp_path / "raw"), nightly.Layout(str(tmp_path / "lake"))
    for n in range(4):
        day = dt.datetime(2024, 1, 5 + n, tzinfo=dt.timezone.utc)
        folder = tmp_path / "raw" / "year=2024" / "month=01" / f"day=0{5 + n}"
        folder.mkdir(parents=True)
        rows = [("on", day + dt.timedelta(minutes=20 * i)) for i in range(72)] + [("short", day + dt.timedelta(hours=9))]
        lines = [json.dumps({"event_id": f"{u}{t}", "user_id": u, "event_type": "view", "product_id": "p",
                             "timestamp": int(t.timestamp() * 1000)}) for u, t in rows]
        (folder / "0.json").write_text("\n".join(lines) + "\n")
        before = _listing(layout, "warehouse/dim_session") if n else {}
        with storage.scratch_scope(spark):
            nightly.curate(spark, path, layout, f"2024-01-0{5 + n}")
            for plan in curation.unloaded(spark, layout):
                nightly._load_sessions(spark, layout, plan)
                curation.loaded([plan])
        after = _listing(layout, "warehouse/dim_session")
        assert {f for f in after if after[f] != before.get(f)} == {"start_date=2024-01-05", f"start_date=2024-01-0{5 + n}"}
    stored = layout.read(spark, "warehouse/dim_session", S.DIM_SESSION_STORED)
    assert {(r.user_id, r.page_views) for r in stored.collect()} == {("on", 288), ("short", 1)}
