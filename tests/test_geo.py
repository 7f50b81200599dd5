"""Address lookup against a brute-force search."""

import ipaddress
import random

import pytest
from pyspark.sql import functions as F

from clickmart.functions.scalar import ip_key
from clickmart.operators import enrich, geo
from clickmart.sources import fixtures
from conftest import plan

NETWORKS = [
    ("10.0.0.0", "10.255.255.255", "US", "A"),
    ("10.1.0.0", "10.1.255.255", "US", "B"),
    ("10.1.2.0", "10.1.2.255", "CA", "C"),
    ("10.1.2.128", "10.1.2.191", "MX", None),
    ("10.0.255.0", "10.1.0.255", "BR", "D"),
    ("11.0.0.0", "11.0.0.0", "DE", "E"),
    ("11.0.0.5", "11.0.0.9", "FR", "F"),
    ("2001::", "200f:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "EU", "G"),
    ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "NL", "H"),
    ("2001:db8:0:ff00::", "2001:db8:1:ff::", "BE", "I"),
    ("2001:db8:1:2:3:4:5:6", "2001:db8:1:2:3:4:5:9", "LU", "J"),
    ("2001:db8:1:2:3:4:5:8", "2001:db8:1:2:3:4:5:8", "AT", None),
]


def _number(ip):
    return int(ipaddress.ip_address(ip))


def _brute(ip):
    try:
        at = ipaddress.ip_address(ip)
        n = int(getattr(at, "ipv4_mapped", None) or at)
        family = 4 if n < 2**32 else 6
    except ValueError:
        return "Unknown", "Unknown"
    hits = [
        (_number(hi) - _number(lo), country, city)
        for lo, hi, country, city in NETWORKS
        if _number(lo) <= n <= _number(hi) and ipaddress.ip_address(lo).version == family
    ]
    return min(hits)[1:] if hits else ("Unknown", "Unknown")


@pytest.fixture(scope="module", params=[128, 1, 0])
def segments(spark, request):
    """Few ranges split no block; a limit of one or none begets blocks of every size."""
    table = spark.createDataFrame(
        NETWORKS, "ip_from string, ip_to string, country string, city string"
    )
    before, geo.BLOCK_RANGES = geo.BLOCK_RANGES, request.param
    try:
        places = geo.segments(geo.ranges(table))
        assert bool(places.splits) == (request.param < 128)
        return places.stored()
    finally:
        geo.BLOCK_RANGES = before


def test_segments_are_disjoint(segments):
    rows = sorted((len(r.lo), r.lo, r.hi) for r in segments.segments.collect())
    assert all(a[0] < b[0] or a[2] < b[1] for a, b in zip(rows, rows[1:]))
    blocks = {r.block for r in segments.segments.collect()}
    split = {name for names in segments.splits.values() for name in names}
    # no block lies within another one
    assert not blocks & split and not any(a != b and b.startswith(a) for a in blocks for b in blocks)


def test_many_ranges(spark):
    """A list like a real one: large ranges handed out in ever smaller pieces, of both families."""
    rng = random.Random(5)
    rows = [("2a00::", "2a0f:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "EU", "all"), ("80.0.0.0", "95.255.255.255", "EU", "all")]
    for i in range(1500):
        a = (80 << 24) + (rng.randrange(2**14) << 10)
        rows.append((str(ipaddress.ip_address(a)), str(ipaddress.ip_address(a + 2 ** rng.randint(0, 12) - 1)), f"c{i}", str(i)))
        b = (0x2A00 << 112) + (rng.randrange(40) << 96) + (rng.randrange(2**16) << 80)
        rows.append((str(ipaddress.ip_address(b)), str(ipaddress.ip_address(b + 2 ** rng.randint(0, 84) - 1)), f"d{i}", str(i)))
    places = geo.segments(geo.ranges(
        spark.createDataFrame(rows, "ip_from string, ip_to string, country string, city string")
    )).stored()
    assert places.splits and max(
        r["count"] for r in places.segments.groupBy("block").count().collect()
    ) <= 4 * geo.BLOCK_RANGES + 2
    asked = [_number(r[k]) + d for r in rng.sample(rows, 150) for k in (0, 1) for d in (-1, 0, 1)]
    events = spark.createDataFrame([(i, str(ipaddress.ip_address(n))) for i, n in enumerate(asked)], "id int, ip_address string")
    spans = [(_number(hi) - _number(lo), _number(lo), _number(hi), c, t) for lo, hi, c, t in rows]
    for r in geo.locate(events, places).collect():
        n = asked[r.id]
        hits = sorted((w, c, t) for w, lo, hi, c, t in spans if lo <= n <= hi)
        ties = {h[1:] for h in hits if h[0] == hits[0][0]} if hits else {("Unknown", "Unknown")}
        assert (r.country, r.city) in ties


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_lookup_equals_brute_force(spark, segments, limit):
    rng = random.Random(1)
    edges = [_number(x) + d for lo, hi, _, _ in NETWORKS for x in (lo, hi) for d in (-1, 0, 1)]
    ips = [str(ipaddress.ip_address(n)) for n in edges]
    ips += [f"10.{rng.randint(0, 2)}.{rng.randint(0, 3)}.{rng.randint(0, 255)}" for _ in range(300)]
    ips += [f"2001:db8:{rng.randint(0, 1):x}:{rng.choice([0, 2, 0xff00]):x}::{rng.randint(0, 9)}" for _ in range(100)]
    ips += ["", "x", "1.2.3", "256.1.1.1", "192.168.1.1", None, "10.01.2.3", "::ffff:10.1.2.3",
            "2001:DB8:1:2:3:4:5:8", "2001:db8:::1", "2001:db8", "1:2:3:4:5:6:7:8:9", "::", "::1%eth0"]
    events = spark.createDataFrame([(i, ip) for i, ip in enumerate(ips)], "id int, ip_address string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        found = {r.id: (r.country, r.city) for r in geo.locate(events, segments).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(found) == len(ips)
    assert found == {i: _brute(ip if ip is not None else "") for i, ip in enumerate(ips)}


def test_ip_key(spark):
    good = ["0.0.0.0", "1.2.3.4", "255.255.255.255", "::", "::1", "1::", "2001:db8::8:800:200c:417a",
            "1:2:3:4:5:6:7:8", "::ffff:1.2.3.4", "1::2:3:4:5:6:7", "fe80::1:2"]
    bad = ["1.2.3.04", "01.2.3.4", "a.b.c.d", "1.2.3.4.5", "", None, "1::2::3", "1:2:3:4:5:6:7", ":1", "12345::",
           "1:2:3:4:5:6:7:8::", "::g", "::1.2.3.256", ":::"]
    df = spark.createDataFrame([(x,) for x in good + bad], "ip string").withColumn("key", ip_key(F.col("ip")))
    got = {r.ip: r.key for r in df.collect()}
    for x in good:
        at = ipaddress.ip_address(x)
        full = int(at) if at.version == 6 else 0xFFFF00000000 + int(at)
        assert got[x] == f"{full:032x}", x
    assert all(got[x] is None for x in bad), got


def test_join_plan(spark, sf, segments):
    events = fixtures.raw_events(spark, sf)
    small = plan(geo.locate(events, segments))
    assert "NestedLoop" not in small and "Cartesian" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large, own = plan(geo.locate(events, segments)), plan(events)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert large.count("SortMergeJoin") == own.count("SortMergeJoin") + 1 and "NestedLoop" not in large


def test_one_busy_block_is_split(spark, segments):
    """All events in one block, segments too large to broadcast: no task gets them all."""
    if segments.splits:
        pytest.skip("the events lie in several blocks")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    rows = spark.range(0, 200_000, 1, 8).select("id", F.format_string("10.1.2.%d", F.col("id") % 256).alias("ip_address"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = geo.locate(rows, segments)
        found.write.format("noop").mode("overwrite").save()
        assert found.count() == 200_000
        found.collect()
        assert "skew=true" in plan(found)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_event_hash(spark):
    import hashlib

    from clickmart import schemas as S

    raw = spark.createDataFrame(
        [("U1", 1714392000000, None), (None, None, "10.1.2.3")],
        "user_id string, timestamp bigint, ip_address string",
    )
    table = geo.segments(geo.ranges(fixtures.geo_table(spark)))
    rows = enrich.enrich(S.conform(raw, S.RAW_EVENT), table).collect()
    got = {r.user_id: r for r in rows}
    assert got["U1"].event_id == hashlib.md5(b"U11714392000000").hexdigest()
    assert got[None].event_id == hashlib.md5(b"NoneNone").hexdigest()
    assert (got["U1"].country, got[None].country) == ("Unknown", "US")
    assert got["U1"].source == "kinesis_stream" and got["U1"].processed_ts is not None
