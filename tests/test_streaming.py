"""Streams give the batch result."""

import json

import pytest
from pyspark.sql import functions as F

from clickmart import schemas as S
from clickmart.operators import clean, enrich, geo
from clickmart.sources import fixtures, raw
from clickmart.streaming import delivery, ingest, live


def _event(i, user, seconds, **more):
    return {
        "event_id": f"e{i}", "user_id": user, "product_id": "p", "event_type": "view",
        "timestamp": 1704067200000 + int(seconds * 1000), "ip_address": "10.0.0.1", **more,
    }


def _write(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows) + "\n")


def _run(spark, rows, tmp_path):
    out = str(tmp_path / "out")
    query = ingest.table_sink(rows, out, str(tmp_path / "state"))
    query.awaitTermination()
    return query, spark.read.schema(rows.schema).parquet(out)


def test_enriched_delivery_equals_batch(spark, tmp_path):
    src = tmp_path / "src"
    rows = [_event(i, f"u{i % 3}", i * 10) for i in range(50)]
    _write(src, "a.json", rows[:20])
    _write(src, "b.json", rows[20:])
    segments = geo.segments(geo.ranges(fixtures.geo_table(spark)))
    stream = raw.accepted(raw.stream_raw(spark, str(src), max_files=1))
    out = str(tmp_path / "raw")
    query = ingest.raw_sink(
        enrich.enrich(stream, segments), out, str(tmp_path / "state"), interval=None
    )
    assert ingest.count_until_done(query) == 50
    assert ingest.delivered_records(spark, out) == 50
    delivered = raw.read_raw(spark, out)
    assert {"year", "month", "day"} <= set(delivered.columns)
    batch = enrich.enrich(raw.accepted(raw.read_raw(spark, str(src), S.RAW_EVENT)), segments)
    same = [c for c in S.ENRICHED_EVENT.names if c != "processed_ts"]
    got = raw.accepted(delivered).select(*same)
    assert got.count() == 50 and got.exceptAll(batch.select(*same)).count() == 0
    assert delivered.filter("processed_ts IS NULL").count() == 0


def test_duplicates_across_batches_go(spark, tmp_path):
    src = tmp_path / "src"
    rows = [_event(i, "u", i) for i in range(10)]
    _write(src, "a.json", rows)
    _write(src, "b.json", rows[5:] + [_event(5, "u", 5, event_type="click")])
    events = clean.clean(raw.accepted(raw.stream_raw(spark, str(src), max_files=1)))
    _, out = _run(spark, ingest.dedup_stream(events), tmp_path)
    assert out.count() == 11


def test_sessions_equal_batch_sessions(spark, tmp_path):
    src = tmp_path / "src"
    rows = [
        _event(0, "a", 0), _event(1, "a", 1800), _event(2, "b", 10),
        _event(3, "a", 3601, event_type="purchase", price=5), _event(4, "b", 7000),
    ]
    _write(src, "a.json", rows[:3])
    _write(src, "b.json", rows[3:])
    # a far event moves the watermark past all sessions
    _write(src, "c.json", [_event(9, "z", 10**7)])
    events = clean.clean(raw.accepted(raw.stream_raw(spark, str(src), max_files=1)))
    _, out = _run(spark, ingest.session_stream(events, delay="1 hour"), tmp_path)
    start = F.unix_seconds("session_start") - 1704067200
    end = F.unix_seconds("session_end") - 1704067200
    got = out.select("user_id", start.alias("s"), end.alias("e"), "events", "total_revenue")
    assert sorted((r.user_id, r.s, r.e, r.events, r.total_revenue and float(r.total_revenue))
                  for r in got.collect()) == [
        ("a", 0, 1800, 2, None), ("a", 3601, 3601, 1, 5.0), ("b", 10, 10, 1, None),
        ("b", 7000, 7000, 1, None),
    ]


class _Query:
    """Progress entries as a query keeps them: the newest two."""

    def __init__(self):
        self.entries, self.isActive = [], True

    def add(self, batch, rows):
        self.entries.append({"batchId": batch, "numInputRows": rows})

    @property
    def recentProgress(self):
        return self.entries[-2:]

    @property
    def lastProgress(self):
        return self.entries[-1]


def test_record_count_over_many_batches():
    query = _Query()
    count = ingest.RecordCount(query)
    for batch in range(250):
        query.add(batch, batch % 7)
        query.add(batch, 0)  # an idle trigger repeats the number
        count.update()
    query.isActive = False
    assert count.update() == sum(b % 7 for b in range(250))


def test_unseen_batches_are_an_error():
    query = _Query()
    count = ingest.RecordCount(query)
    query.add(0, 5)
    count.update()
    for batch in (1, 2, 3):
        query.add(batch, 5)
    with pytest.raises(RuntimeError, match="1 to 1"):
        count.update()


def test_unknown_fields_and_broken_lines_survive(spark, tmp_path):
    src = tmp_path / "src"
    rows = [_event(0, "u", 0), _event(1, "u", 1, coupon={"code": "x"}, rank=3)]
    _write(src, "a.json", rows)
    (src / "b.json").write_text('{"user_id": "cut off\n')
    segments = geo.segments(geo.ranges(fixtures.geo_table(spark)))
    lines = raw.stream_raw(spark, str(src))
    out, bad = str(tmp_path / "raw"), str(tmp_path / "bad")
    ingest.raw_sink(enrich.enrich(lines, segments), out, str(tmp_path / "s1"), None).awaitTermination()
    ingest.reject_sink(lines, bad, str(tmp_path / "s2"), None).awaitTermination()
    got = {r.user_id + str(r.timestamp)[-4:]: r for r in raw.accepted(raw.read_raw(spark, out)).collect()}
    assert len(got) == 2
    payloads = [r.payload for r in got.values()]
    kept = json.loads(next(p for p in payloads if p))
    assert payloads.count(None) == 1 and kept["coupon"] == {"code": "x"} and kept["rank"] == 3
    refused = spark.read.json(bad).collect()
    assert [(r.line, r.reason) for r in refused] == [('{"user_id": "cut off', "unreadable")]


def test_delivery_goes_on_from_its_checkpoint(spark, tmp_path):
    src, out, state = tmp_path / "src", str(tmp_path / "raw"), str(tmp_path / "state")
    segments = geo.segments(geo.ranges(fixtures.geo_table(spark)))
    for name in ("a.json", "b.json"):
        _write(src, name, [_event(i, name, i) for i in range(5)])
        stream = raw.accepted(raw.stream_raw(spark, str(src)))
        ingest.raw_sink(enrich.enrich(stream, segments), out, state, None).awaitTermination()
    rows = raw.accepted(raw.read_raw(spark, out))
    assert rows.count() == rows.select("user_id", "timestamp").distinct().count() == 10
    assert ingest.delivered_records(spark, out) == 10


def test_the_raw_parse_stands_once_in_a_plan(spark, tmp_path):
    from conftest import plan

    src = tmp_path / "src"
    _write(src, "a.json", [_event(0, "u", 0)])
    text = plan(clean.clean(raw.accepted(raw.read_raw(spark, str(src), S.RAW_EVENT))))
    assert text.count("from_json") == 1


# ------------------------------------------------------------------ delivery by batches


def _enriched(spark, src, places, **limits):
    return enrich.enrich(raw.accepted(raw.stream_raw(spark, str(src), **limits)), places)


@pytest.fixture(scope="module")
def places(spark):
    return geo.segments(geo.ranges(fixtures.geo_table(spark))).stored()


def _ids(df):
    return sorted((r.user_id, r.timestamp) for r in raw.accepted(df).select("user_id", "timestamp").collect())


def test_a_batch_that_is_replayed_is_delivered_once(spark, tmp_path, places):
    from pyspark.errors import StreamingQueryException

    src, out, state = tmp_path / "src", str(tmp_path / "raw"), str(tmp_path / "state")
    rows = [_event(i, f"u{i}", i) for i in range(12)]
    for n in range(4):
        _write(src, f"{n}.json", rows[n::4])

    def fail(number):
        if number == 2:
            raise RuntimeError("lost")

    with pytest.raises(StreamingQueryException):
        delivery.deliver(_enriched(spark, src, places, max_files=1), out, state, None, fail).awaitTermination()
    assert len(delivery.folders(spark, out)) == 3
    query = delivery.deliver(_enriched(spark, src, places, max_files=1), out, state, None)
    query.awaitTermination()
    assert _ids(delivery.delivered(spark, out)) == sorted((r["user_id"], r["timestamp"]) for r in rows)
    assert delivery.median_millis(query) > 0
    # merged: fewer folders, the same rows; a merge that was cut off is not seen
    before = _ids(delivery.delivered(spark, out))
    (tmp_path / "raw" / "batch=000000000000-000000000099").mkdir()
    name = delivery.merge(spark, out)
    assert name == "batch=000000000000-000000000002" and len(delivery.folders(spark, out)) == 2
    assert _ids(delivery.delivered(spark, out)) == before
    # batches left behind by a merge are covered by it
    (tmp_path / "raw" / "batch=000000000001").mkdir()
    (tmp_path / "raw" / "batch=000000000001" / "_SUCCESS").touch()
    assert name in delivery.folders(spark, out) and len(delivery.folders(spark, out)) == 2


def test_delivery_by_interval_and_size(spark, tmp_path, places):
    import time

    src, out, state = tmp_path / "src", str(tmp_path / "raw"), str(tmp_path / "state")
    rows = [_event(i, f"u{i}", i) for i in range(30)]
    _write(src, "0.json", rows[:10])
    one = (src / "0.json").stat().st_size
    query = delivery.deliver(_enriched(spark, src, places, max_bytes=one), out, state, "1 second")
    try:
        _write(src, "1.json", rows[10:20])
        _write(src, "2.json", rows[20:])
        deadline = time.time() + 60
        while time.time() < deadline and len(_ids(delivery.delivered(spark, out))) < 30:
            time.sleep(0.5)
    finally:
        query.stop()
    assert _ids(delivery.delivered(spark, out)) == sorted((r["user_id"], r["timestamp"]) for r in rows)
    # files of this size make a batch each
    assert len(delivery.folders(spark, out)) == 3


# ------------------------------------------------------------------ live sessions with corrections


def test_merged_is_the_batch_rule():
    import random

    rng = random.Random(3)
    for _ in range(300):
        events = [(rng.randrange(0, 400), 1, 2) for _ in range(rng.randrange(1, 25))]
        cut = rng.randrange(len(events) + 1)
        state = [s for s, _ in live.merged([], events[:cut], 20)]
        found = [s for s, _ in live.merged(state, events[cut:], 20)]
        want = []
        for t, n, c in sorted(events):
            if want and t - want[-1][1] <= 20:
                f, _, k, i, x, v = want[-1]
                want[-1] = (f, t, k + 1, i + n, x + c, v)
            else:
                want.append((t, t, 1, n, c, 0))
        assert found == want


def test_live_sessions_are_corrected(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    minute = 60
    batches = [
        [_event(0, "a", 0), _event(1, "a", 50 * minute), _event(2, "b", 0, event_type="purchase", price="2.50")],
        [_event(3, "a", 25 * minute), _event(4, "b", -10 * minute)],  # joins the two sessions of a, moves b's start
        [_event(5, "c", 10 * 3600)],  # the watermark passes a and b
        [_event(6, "c", 11 * 3600)],
    ]
    for key, value in live.STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        seen = []
        for n, rows in enumerate(batches):
            _write(src, f"{n}.json", rows)
            events = clean.clean(raw.accepted(raw.stream_raw(spark, str(src))))
            versions = live.live_sessions(events, delay="2 hours")
            ingest.table_sink(versions, out, str(tmp_path / "state")).awaitTermination()
            table = spark.read.schema(versions.schema).parquet(out)
            now = live.current(table)
            seen.append(sorted((r.user_id, r.events, r.final) for r in now.collect()))
    finally:
        for key in live.STATE_STORE:
            spark.conf.unset(key)
    assert seen[0] == [("a", 1, False), ("a", 1, False), ("b", 1, False)]
    assert seen[1] == [("a", 3, False), ("b", 2, False)]
    assert seen[2][:2] == [("a", 3, True), ("b", 2, True)] or seen[3][:2] == [("a", 3, True), ("b", 2, True)]
    corrections = {r.user_id: r for r in table.filter("size(replaces) > 0").collect()}
    assert set(corrections) == {"a", "b"}
    assert [t.minute for t in corrections["a"].replaces] == [50]
    assert [t.minute for t in corrections["b"].replaces] == [0] and corrections["b"].session_start.minute == 50
    assert float(corrections["b"].total_revenue) == 2.5 and corrections["b"].items_purchased == 1


def test_users_are_merged_at_once_as_one_by_one():
    import random

    import pandas as pd

    rng = random.Random(5)
    table = lambda rows: live._sessions(list(zip(*rows)) or [[]] * len(live._SESSION))
    for _ in range(100):
        state, events, want = [], [], []
        for user in ("b", None, "a"):
            old = [(rng.randrange(0, 300), 1, 2) for _ in range(rng.randrange(0, 6))]
            new = [(rng.randrange(0, 300), 1, 2) for _ in range(rng.randrange(0, 6))]
            known = [(*s[:5], 3) for s, _ in live.merged([], old, 20)]
            for s, starts in live.merged(known, new, 20):
                changed = s not in known
                want.append((user, *s[:5], s[5] + changed, changed, [t for t in starts if t != s[0]]))
            state += [(user, *s) for s in known]
            events += [(user, t, t, 1, n, c, 0) for t, n, c in new]
        if not state + events:
            continue
        rng.shuffle(state)
        got = live.merged_users(table(state), table(events), 20)
        rows = [(None if pd.isna(r[0]) else r[0], *r[1:]) for r in got[[*live._SESSION, "changed", "replaces"]].itertuples(index=False)]
        assert sorted(rows, key=str) == sorted(want, key=str)


def test_a_key_of_the_state_holds_many_users_and_one_timer(spark, tmp_path, monkeypatch):
    """Two buckets for forty users: a call per user, or a timer per session, is what made large streams slow."""
    monkeypatch.setattr(live, "BUCKETS", 2)
    src, out = tmp_path / "src", str(tmp_path / "out")
    rows = [_event(100 * u + i, f"u{u}", 7200 * i + u) for u in range(40) for i in range(5)]
    for key, value in live.STATE_STORE.items():
        spark.conf.set(key, value)
    try:
        for n, batch in enumerate([rows[::2], rows[1::2], [_event(9, "late", 10 * 3600)]]):
            _write(src, f"{n}.json", batch)
            events = clean.clean(raw.accepted(raw.stream_raw(spark, str(src))))
            query = ingest.table_sink(live.live_sessions(events, delay="10 hours"), out, str(tmp_path / "state"))
            query.awaitTermination()
            state = query.recentProgress[0]["stateOperators"][0]
            if n < 2:
                assert state["customMetrics"]["numRegisteredTimers"] <= 2
    finally:
        for key in live.STATE_STORE:
            spark.conf.unset(key)
    done = spark.read.parquet(out).filter("final")
    # the watermark stands at the first hour of the stream
    assert sorted(r.user_id for r in done.collect()) == []
    shown = live.current(spark.read.parquet(out))
    assert shown.count() == 201 and shown.filter("user_id != 'late'").agg(F.sum("events")).first()[0] == 200
