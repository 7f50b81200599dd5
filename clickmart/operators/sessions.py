"""Sessionization by inactivity gap, safe for users with very many events.

A window over all events of a user would put a heavy user into one task.  Here
the time axis is cut into cells as long as the gap.  Two events of one user in
the same cell are never more than the gap apart, so a cell never holds a session
boundary.  Events therefore collapse to one row per (user, cell) by ordinary
hash aggregation, with map-side combine, and only these rows go through the
per-user window.  Their number per user is bounded by time span / gap, whatever
the number of events.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart.functions.scalar import event_order

CELL = "_cell"
FIRST = "_first_ts"
LAST = "_last_ts"
STATE_COLUMNS = ("user_id", "session_start", "last_ts", "session_seq")


def _micros(ts: str | Column) -> Column:
    return F.unix_micros(F.col(ts) if isinstance(ts, str) else ts)


def _gap_micros(gap_seconds: float) -> Column:
    return F.lit(int(gap_seconds * 1_000_000)).cast("bigint")


def cell_of(ts: str, gap_seconds: float) -> Column:
    """Start of the cell in epoch microseconds; integer arithmetic, also before 1970."""
    return _micros(ts) - F.pmod(_micros(ts), _gap_micros(gap_seconds))


def session_id(user: str = "user_id", start: str = "session_start") -> Column:
    """Globally unique session id: user and start in epoch milliseconds."""
    return F.concat_ws("-", F.col(user), F.unix_millis(F.col(start)).cast("string"))


def cells(
    events: DataFrame,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    aggs: Sequence[Column] = (),
    keys: Sequence[str] = (),
) -> DataFrame:
    """One row per user, cell and ``keys`` with first and last time and ``aggs``."""
    return (
        events.withColumn(CELL, cell_of("event_ts", gap_seconds))
        .groupBy("user_id", CELL, *keys)
        .agg(F.min("event_ts").alias(FIRST), F.max("event_ts").alias(LAST), *aggs)
    )


def number_sessions(
    cell_rows: DataFrame,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_seq`` and ``session_start`` to cell rows.

    ``carry`` holds the last session per user of earlier runs (``STATE_COLUMNS``);
    a first cell within the gap of it continues that session and its number.
    """
    rows = cell_rows.withColumn("_base", F.lit(None).cast("bigint"))
    if carry is not None:
        rows = rows.unionByName(
            carry.select(
                "user_id",
                F.col("session_start").alias(FIRST),
                F.col("last_ts").alias(LAST),
                F.col("session_seq").cast("bigint").alias("_base"),
            ),
            allowMissingColumns=True,
        )
    by_time = W.partitionBy("user_id").orderBy(FIRST)
    so_far = by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    # rows of one cell, if keys part them, may end in any order
    earlier = by_time.rowsBetween(W.unboundedPreceding, -1)
    gap = _micros(FIRST) - F.max(_micros(LAST)).over(earlier)
    starts = F.when(gap.isNull() | (gap > _gap_micros(gap_seconds)), 1).otherwise(0)
    numbered = (
        rows.withColumn("_new", starts)
        .withColumn(
            "session_seq",
            F.sum("_new").over(so_far) + F.coalesce(F.first("_base").over(so_far), F.lit(1)) - 1,
        )
        .withColumn(
            "session_start", F.max(F.when(F.col("_new") == 1, F.col(FIRST))).over(so_far)
        )
        .drop("_new")
    )
    if carry is None:
        return numbered.drop("_base")
    # the carried rows served as predecessors only
    return numbered.filter(F.col("_base").isNull()).drop("_base")


def sessionize(
    events: DataFrame,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_seq``, ``session_start`` and ``session_id`` to every event.

    ``events`` is read twice: once narrow (user, time) for the cells, once for the
    join back on (user, cell), which runtime re-planning can split when skewed.
    """
    numbered = number_sessions(cells(events, gap_seconds), gap_seconds, carry).select(
        "user_id", CELL, "session_seq", "session_start"
    )
    return (
        events.withColumn(CELL, cell_of("event_ts", gap_seconds))
        .join(numbered, ["user_id", CELL])
        .drop(CELL)
        .withColumn("session_id", session_id())
    )


def last_sessions(
    events: DataFrame,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    carry: DataFrame | None = None,
) -> DataFrame:
    """State for the next run: the last session of every user seen so far."""
    numbered = number_sessions(cells(events, gap_seconds), gap_seconds, carry).select(
        "user_id", "session_start", F.col(LAST).alias("last_ts"), "session_seq"
    )
    if carry is not None:
        numbered = numbered.unionByName(carry.select(*STATE_COLUMNS))
    newest = F.max(F.struct("session_seq", "last_ts", "session_start")).alias("_s")
    return numbered.groupBy("user_id").agg(newest).select(
        "user_id", *[F.col(f"_s.{c}").alias(c) for c in STATE_COLUMNS[1:]]
    )


def session_rollup(
    events: DataFrame, gap_seconds: float = C.SESSION_GAP_SECONDS
) -> DataFrame:
    """One row per session: start, end, length, page views, first device.

    Events collapse by hash: the device is a key, the first event of each a minimum of numbers.
    """
    first = F.min(event_order(F.col("event_ts"), F.col("event_id"))).alias("_first")
    views = F.count_if(F.col("event_type") == C.VIEW).alias("_views")
    numbered = number_sessions(cells(events, gap_seconds, [first, views], ["device_type"]), gap_seconds)
    return (
        numbered.groupBy("user_id", "session_seq", "session_start")
        .agg(
            F.max(LAST).alias("session_end"),
            F.sum("_views").cast("int").alias("page_views"),
            F.min(F.struct("_first", "device_type"))["device_type"].alias("device_type"),
        )
        .withColumn("session_id", session_id())
        .withColumn(
            "duration_secs",
            F.floor((_micros("session_end") - _micros("session_start")) / 1_000_000).cast("int"),
        )
    )


def session_windows(
    events: DataFrame, gap_seconds: int = C.SESSION_GAP_SECONDS
) -> DataFrame:
    """Sessions by the built-in ``session_window``, fed with cells instead of events.

    Each cell opens a window from its first event to its last event plus the gap;
    Spark merges the windows that touch.
    """
    rows = cells(events, gap_seconds, [F.count(F.lit(1)).alias("_n")])
    seconds = (_micros(LAST) - _micros(FIRST)).cast("decimal(18,0)") / 1_000_000 + gap_seconds
    zero = F.lit(0)
    length = F.make_interval(zero, zero, zero, zero, zero, zero, seconds.cast("decimal(18,6)"))
    return (
        rows.withColumn("_length", length)
        .groupBy("user_id", F.session_window(F.col(FIRST), F.col("_length")).alias("window"))
        .agg(
            F.min(FIRST).alias("session_start"),
            F.max(LAST).alias("session_end"),
            F.sum("_n").alias("events"),
        )
        .drop("window")
    )
