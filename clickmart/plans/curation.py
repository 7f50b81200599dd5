"""Curated events and their sessions, brought up to date by the files that have arrived.

Sessions are kept as intervals: one row per user and session with its first and last time, its number and what
the session dimension needs.  New events are merged into the intervals they touch, so a run reads and
rewrites only

* the days of its new events, and the days of sessions that changed their start or number, which only
  sessions of users with late events can;
* the interval partitions (by day of the last event) of those sessions.

An event that is a year late, or a client with a wrong clock, costs the days of that one user.

Which files have been read is a ledger, not a matter of dates: a file that reaches an old folder is read
by the next run, and no file is read twice.

A run first writes its plan: new rows with their sessions, the intervals that come and go, how sessions are
renumbered, and what is rejected or pending.  Then it is applied, and at last its files enter the ledger.  Every step
of the application can be repeated, so a run that was cut off is finished by the next one.
"""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickmart import constants as C
from clickmart import schemas as S
from clickmart.functions.scalar import same_row
from clickmart.operators import clean, dedup, sales, sessions
from clickmart.plans.layout import Layout
from clickmart.sinks import tables
from clickmart.sources import raw as raw_source
from clickmart.storage import list_names, materialize, path_exists, remove_path, scratch_scope

PLANS, LEDGER, INTERVALS, LAST, PENDING = (
    f"state/{name}" for name in ("plans", "ledger", "intervals", "last", "pending")
)
#: users whose new events reach further back are looked up in the older interval partitions, too
SETTLED_DAYS = 2
#: up to so many of them, the scan of the older partitions skips row groups by their names
NAMED_USERS = 1_000
_SESSION = ("session_seq", "session_start", "session_id")
_KEY = ("user_id", "session_start")
_OLD = "_old_start"


def day(value: str) -> Column:
    return F.lit(value).cast("date")


def _days(df: DataFrame, *columns: Column) -> list[str]:
    """Distinct days, as text; at most one per day of the zone."""
    found = df.select(F.explode(F.array(*columns)).alias("day")).distinct()
    return sorted(str(r.day) for r in found.collect() if r.day is not None)


def _ended(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


# ---- what has arrived -----------------------------------------------------------------------

def _listed(spark: SparkSession, raw_path: str, since: str | None) -> DataFrame:
    """Files of the raw zone; folders named by a day before ``since`` are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(raw_path).select("path")
    if since is None:
        return files
    parts = [F.regexp_extract("path", rf"/{name}=(\d+)", 1).try_cast("int") for name in ("year", "month", "day")]
    return files.filter(F.coalesce(F.make_date(*parts) >= day(since), F.lit(True)))


def new_files(spark: SparkSession, raw_path: str, layout: Layout, since: str | None = None) -> DataFrame:
    """Files that no finished run has read."""
    found = _listed(spark, raw_path, since)
    runs = [n for n in list_names(spark, layout.path(LEDGER)) if _ended(spark, layout.path(f"{LEDGER}/{n}"))]
    if not runs:
        return found
    known = spark.read.schema("path string").parquet(*[layout.path(f"{LEDGER}/{n}") for n in runs])
    return found.join(known, "path", "left_anti")


def refused(delivered: DataFrame, late: DataFrame | None) -> DataFrame:
    """What does not enter the curated zone, as text, and why."""
    incomplete = F.greatest(*[F.col(c).isNull() for c in ("user_id", "event_type", "timestamp")])
    rows = raw_source.rejects(delivered).unionByName(
        raw_source.accepted(delivered).filter(incomplete).select(
            F.to_json(F.struct("*")).alias("line"), F.lit("incomplete").alias("reason")
        )
    )
    if late is not None:
        rows = rows.unionByName(
            late.select(F.to_json(F.struct("*")).alias("line"), F.lit("late").alias("reason"))
        )
    return rows


def _waiting(spark: SparkSession, layout: Layout, like: DataFrame) -> DataFrame:
    """Events that earlier runs found too early for their day."""
    runs = [n for n in list_names(spark, layout.path(PENDING)) if _ended(spark, layout.path(f"{PENDING}/{n}"))]
    if not runs:
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(layout.path(f"{PENDING}/{runs[-1]}"))


def _stored(spark: SparkSession, layout: Layout, like: DataFrame, days: list[str]) -> DataFrame:
    """Curated events of ``days``; only their folders are opened."""
    path = layout.path("curated/events")
    if not days or not path_exists(spark, path):
        return S.conform(like.limit(0), S.CURATED_EVENT)
    events = spark.read.schema(S.CURATED_EVENT).parquet(path)
    return events.filter(F.col("date").isin([F.lit(d).cast("date") for d in days])).select(*S.CURATED_EVENT.names)


# ---- intervals ------------------------------------------------------------------------------

def _measures() -> list[Column]:
    head = F.struct("event_ts", "event_id", "device_type")
    views = F.count_if(F.col("event_type") == C.VIEW)
    return [views.alias("page_views"), F.min(head).alias("_head")]


def affected(spark: SparkSession, layout: Layout, users: DataFrame, as_of: str, gap_seconds: float) -> DataFrame:
    """Stored intervals that the users' new events (from ``from_ts`` on) touch, and all later ones of these users.

    Intervals lie in partitions of their last day.  Users who reach back beyond the last days are few; only for
    them older partitions are opened, from the earliest that any of them needs.
    """
    path = layout.path(INTERVALS)
    if not path_exists(spark, path):
        return spark.createDataFrame([], S.SESSION_INTERVAL)
    stored = spark.read.schema(S.SESSION_INTERVAL).parquet(path)
    reach = F.col("from_ts") - F.make_dt_interval(secs=F.lit(float(gap_seconds)))
    users = users.withColumn("reach", reach)
    horizon = F.date_add(day(as_of), -SETTLED_DAYS)
    recent = stored.filter(F.col("last_date") >= horizon).join(users, "user_id")
    stray = materialize(users.filter(F.to_date("reach") < horizon), "stray-users")
    older = stored.filter(F.col("last_date") < horizon)
    bounds = stray.agg(F.count(F.lit(1)).alias("n"), F.to_date(F.min("reach")).alias("first")).first()
    if not bounds.n:
        older = older.filter(F.lit(False))
    else:
        older = older.filter(F.col("last_date") >= F.lit(bounds.first))
        if bounds.n <= NAMED_USERS:
            older = older.filter(F.col("user_id").isin([r.user_id for r in stray.select("user_id").collect()]))
    both = recent.unionByName(older.join(stray, "user_id"))
    return both.filter(F.col("last_ts") >= F.col("reach")).select(*S.SESSION_INTERVAL.names)


def merge_intervals(
    cell_rows: DataFrame, old: DataFrame, last: DataFrame, gap_seconds: float = C.SESSION_GAP_SECONDS
) -> DataFrame:
    """Cells of new events and the intervals they touch, each with its session's start and number.

    ``old`` holds for every user all intervals from the first touched one on, so numbers go on from that one's;
    users without any go on from ``last``.  Rows of ``old`` have their former start in ``_old_start``.
    """
    rows = cell_rows.unionByName(
        old.select(
            "user_id", F.col("session_start").alias(sessions.FIRST), F.col("last_ts").alias(sessions.LAST), "page_views",
            F.struct(F.col("session_start").alias("event_ts"), F.col("first_id").alias("event_id"), "device_type").alias("_head"),
            F.col("session_start").alias(_OLD), F.col("session_seq").alias("_old_seq"),
        ),
        allowMissingColumns=True,
    )
    by_time = W.partitionBy("user_id").orderBy(sessions.FIRST, sessions.LAST)
    so_far = by_time.rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = by_time.rowsBetween(W.unboundedPreceding, -1)
    # an interval may reach beyond the cells that follow its start
    gap = F.unix_micros(sessions.FIRST) - F.unix_micros(F.max(sessions.LAST).over(earlier))
    starts = F.when(gap.isNull() | (gap > int(gap_seconds * 1_000_000)), 1).otherwise(0)
    numbered = (
        rows.withColumn("_new", starts)
        .withColumn("_place", F.sum("_new").over(so_far))
        .withColumn("session_start", F.max(F.when(F.col("_new") == 1, F.col(sessions.FIRST))).over(so_far))
        .withColumn("_base", F.min("_old_seq").over(W.partitionBy("user_id")))
    )
    known = last.select("user_id", (F.col("session_seq") + 1).alias("_next"))
    first = F.coalesce("_base", "_next", F.lit(1))
    return numbered.join(known, "user_id", "left").withColumn("session_seq", first + F.col("_place") - 1).drop(
        "_new", "_place", "_base", "_next"
    )


def _intervals(numbered: DataFrame) -> DataFrame:
    """One row per session of numbered cells and intervals."""
    merged = numbered.groupBy("user_id", "session_seq", "session_start").agg(
        F.max(sessions.LAST).alias("last_ts"), F.sum("page_views").alias("page_views"), F.min("_head").alias("_head")
    )
    return S.conform(
        merged.withColumns({
            "first_id": F.col("_head.event_id"), "device_type": F.col("_head.device_type"),
            "last_date": F.to_date("last_ts"),
        }),
        S.SESSION_INTERVAL,
    )


def _newest(spark: SparkSession, layout: Layout) -> DataFrame:
    """The last session of every user, by the newest run."""
    runs = [n for n in list_names(spark, layout.path(LAST)) if _ended(spark, layout.path(f"{LAST}/{n}"))]
    if not runs:
        return spark.createDataFrame([], S.SESSION_INTERVAL)
    return spark.read.schema(S.SESSION_INTERVAL).parquet(layout.path(f"{LAST}/{runs[-1]}"))


# ---- a run ----------------------------------------------------------------------------------

_RENUMBERED = "user_id string, old_start timestamp, session_start timestamp, session_seq bigint"


@dataclass(frozen=True)
class Plan:
    """What a run does, as written tables; its name sorts by time of writing."""

    spark: SparkSession
    layout: Layout
    name: str

    def path(self, part: str) -> str:
        return self.layout.path(f"{PLANS}/{self.name}/{part}")

    def write(self, part: str, df: DataFrame) -> DataFrame:
        tables.write_table(df, self.path(part))
        return self.spark.read.schema(df.schema).parquet(self.path(part))

    def read(self, part: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(part))

    @property
    def as_of(self) -> str:
        return self.name.split(".")[1]

    @property
    def rows(self) -> DataFrame:
        return self.read("rows", S.CURATED_EVENT)

    @property
    def came(self) -> DataFrame:
        """Intervals as they are now."""
        return self.read("came", S.SESSION_INTERVAL)

    @property
    def went(self) -> DataFrame:
        """Intervals that were merged, extended or renumbered, as they were."""
        return self.read("went", S.SESSION_INTERVAL)

    @property
    def days(self) -> list[str]:
        """Days of curated events that are rewritten."""
        return sorted(r.day for r in self.read("days", "day string").collect())


def _names(spark: SparkSession, layout: Layout) -> list[str]:
    """Plans that were written whole, in their order."""
    found = list_names(spark, layout.path(PLANS))
    return [n for n in found if _ended(spark, layout.path(f"{PLANS}/{n}/days"))]


def _next_name(spark: SparkSession, layout: Layout, as_of: str) -> str:
    used = list_names(spark, layout.path(PLANS)) + list_names(spark, layout.path(LEDGER))
    return f"{max([int(n.split('.')[0]) for n in used], default=0) + 1:06d}.{as_of}"


def _write_plan(
    spark: SparkSession, raw_path: str, layout: Layout, as_of: str, since: str | None, gap_seconds: float,
    late_days: int | None,
) -> Plan:
    plan = Plan(spark, layout, _next_name(spark, layout, as_of))
    files = plan.write("files", new_files(spark, raw_path, layout, since).select("path"))
    # Spark's own index holds the paths of a scan as well
    paths = [r.path for r in files.collect()]
    delivered = materialize(raw_source.read_files(spark, paths), "delivered")
    fresh = clean.clean(raw_source.accepted(delivered))
    fresh = materialize(dedup.dedup(fresh.unionByName(_waiting(spark, layout, fresh))), "fresh")
    plan.write("pending", fresh.filter(F.col("date") > day(as_of)))

    due = fresh.filter(F.col("date") <= day(as_of))
    # the id is made of user and time, so an event that came before lies on the same day
    known = _stored(spark, layout, due, _days(due, F.col("date")))
    due = due.join(known, same_row(due, known, dedup.EVENT_KEY), "left_anti")
    late = None
    if late_days is not None and since is None:
        too_old = F.col("date") < F.date_add(day(as_of), -late_days)
        late, due = due.filter(too_old), due.filter(~too_old)
    plan.write("rejected", refused(delivered, late))
    due = materialize(due, "due")

    cell_rows = sessions.cells(due, gap_seconds, _measures())
    users = cell_rows.groupBy("user_id").agg(F.min(sessions.FIRST).alias("from_ts"))
    old = materialize(affected(spark, layout, materialize(users, "due-users"), as_of, gap_seconds), "touched")
    numbered = materialize(merge_intervals(cell_rows, old, _newest(spark, layout), gap_seconds), "numbered")

    own = numbered.filter(F.col(_OLD).isNull()).select("user_id", sessions.CELL, "session_seq", "session_start")
    rows = (
        due.withColumn(sessions.CELL, sessions.cell_of("event_ts", gap_seconds))
        .join(own, ["user_id", sessions.CELL])
        .withColumn("session_id", sessions.session_id())
    )
    rows = plan.write("rows", S.conform(rows, S.CURATED_EVENT))
    moved = (F.col("session_start") != F.col(_OLD)) | (F.col("session_seq") != F.col("_old_seq"))
    renumbered = plan.write("renumbered", numbered.filter(F.col(_OLD).isNotNull() & moved).select(
        "user_id", F.col(_OLD).alias("old_start"), "session_start", "session_seq"
    ))
    came = _intervals(numbered)
    # intervals that are as they were stay where they are
    plan.write("came", came.exceptAll(old))
    plan.write("went", old.exceptAll(came))
    spans = old.join(
        renumbered.select("user_id", F.col("old_start").alias("session_start")), list(_KEY), "left_semi"
    ).select(F.explode(F.sequence(F.to_date("session_start"), F.to_date("last_ts"))).alias("date"))
    days = rows.select("date").unionByName(spans).distinct().select(F.col("date").cast("string").alias("day"))
    plan.write("days", days)
    return plan


def _apply(plan: Plan) -> None:
    spark, layout = plan.spark, plan.layout
    rows, days = plan.rows, plan.days
    stored = _stored(spark, layout, rows, days)
    renumbered = plan.read("renumbered", _RENUMBERED).withColumnsRenamed(
        {"session_start": "_start", "session_seq": "_seq", "user_id": "_user"}
    )
    # sessions that were renumbered by an application that was cut off have no former start any more
    on = (F.col("user_id") == F.col("_user")) & (F.col("session_start") == F.col("old_start"))
    again = stored.join(renumbered, on, "left").withColumns({
        "session_seq": F.coalesce("_seq", "session_seq"), "session_start": F.coalesce("_start", "session_start"),
    }).withColumn("session_id", sessions.session_id())
    added = rows.join(stored, same_row(rows, stored, dedup.EVENT_KEY), "left_anti")
    events = layout.path("curated/events")
    if days:
        tables.write_partitions(
            S.conform(again, S.CURATED_EVENT).unionByName(added), events, ["date"], ["user_id", "event_ts"]
        )
        written = _stored(spark, layout, rows, days)
        tables.write_partitions(sales.sales_of_sessions(written), layout.path("curated/sales"), ["date"])
        _apply_intervals(plan)
    pending = spark.read.schema(_pending_schema(plan)).parquet(plan.path("pending"))
    tables.write_table(pending, layout.path(f"{PENDING}/{plan.name}"))
    lines = plan.read("rejected", "line string, reason string")
    tables.write_table(lines, layout.path(f"rejected/{plan.as_of}/run={int(plan.name.split('.')[0])}"))
    # from here on the run is done
    tables.write_table(plan.read("files", "path string"), layout.path(f"{LEDGER}/{plan.name}"))


def _pending_schema(plan: Plan):
    return plan.spark.read.parquet(plan.path("pending")).schema


def _apply_intervals(plan: Plan) -> None:
    spark, layout = plan.spark, plan.layout
    came, went = plan.came, plan.went
    path = layout.path(INTERVALS)
    stored = spark.createDataFrame([], S.SESSION_INTERVAL)
    values = _days(came.unionByName(went), F.col("last_date"))
    if path_exists(spark, path):
        stored = spark.read.schema(S.SESSION_INTERVAL).parquet(path).filter(
            F.col("last_date").isin([F.lit(d).cast("date") for d in values])
        )
    gone = came.unionByName(went).select(*_KEY)
    kept = stored.join(gone, list(_KEY), "left_anti").select(*S.SESSION_INTERVAL.names)
    tables.replace_partitions(spark, path, kept.unionByName(came), "last_date", values, ["user_id", "session_start"])

    touched = came.unionByName(went).select("user_id").distinct()
    newest = F.max(F.struct("session_seq", F.struct(*S.SESSION_INTERVAL.names).alias("row"))).alias("newest")
    last = _newest(spark, layout)
    # of users with late events the intervals that came hold the last one, or it is as it was
    mine = came.unionByName(last.join(went.select(*_KEY), list(_KEY), "left_anti").join(touched, "user_id", "left_semi"))
    fresh = mine.groupBy("user_id").agg(newest).select("newest.row.*")
    new_last = last.join(touched, "user_id", "left_anti").unionByName(fresh)
    tables.write_table(materialize(new_last, "last"), layout.path(f"{LAST}/{plan.name}"))


def finish(spark: SparkSession, layout: Layout) -> None:
    """Apply what an earlier run has planned and not ended; a plan that was not written whole is removed."""
    whole = _names(spark, layout)
    for name in set(list_names(spark, layout.path(PLANS))) - set(whole):
        remove_path(spark, layout.path(f"{PLANS}/{name}"))
    for name in whole:
        if not _ended(spark, layout.path(f"{LEDGER}/{name}")):
            _apply(Plan(spark, layout, name))


def curate(
    spark: SparkSession,
    raw_path: str,
    layout: Layout,
    as_of: str,
    since: str | None = None,
    gap_seconds: float = C.SESSION_GAP_SECONDS,
    late_days: int | None = None,
    on_plan: Callable[[Plan], None] | None = None,
) -> list[str]:
    """Curated events and session sales after the new files; returns the days that were rewritten.

    Read is what no run has read before; with ``since`` folders of earlier days are left out.  Events stamped after
    ``as_of`` wait in ``state/pending`` for the run of their day.  With ``late_days``, events
    older than that are refused.  Refused and unreadable lines are written to ``rejected`` with a reason.
    ``on_plan`` sees the plan before it is applied.
    """
    with scratch_scope(spark):
        finish(spark, layout)
        plan = _write_plan(spark, raw_path, layout, as_of, since, gap_seconds, late_days)
        if on_plan is not None:
            on_plan(plan)
        _apply(plan)
        return plan.days


def unloaded(spark: SparkSession, layout: Layout) -> list[Plan]:
    """Finished runs whose plan has not been removed: the warehouse has not taken them in yet."""
    return [
        Plan(spark, layout, n) for n in _names(spark, layout) if _ended(spark, layout.path(f"{LEDGER}/{n}"))
    ]


def loaded(plans: list[Plan]) -> None:
    """Forget the plans; the ledger stays."""
    for plan in plans:
        remove_path(plan.spark, plan.layout.path(f"{PLANS}/{plan.name}"))


def prune_states(spark: SparkSession, layout: Layout, keep: int = 2) -> None:
    """Forget the last sessions and pending events of all but the newest ``keep`` runs."""
    for state in (LAST, PENDING):
        for name in list_names(spark, layout.path(state))[:-keep]:
            remove_path(spark, layout.path(f"{state}/{name}"))
