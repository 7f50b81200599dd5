"""Live sessions that are shown early and corrected.

State is the list of sessions that an event may still change.  Every batch merges new events into
them and emits what changed at once.  A row names the session by user and start, has a version, and lists the
starts that it ``replaces``: its own earlier one when a late event has moved the start, and those of all sessions
that the event has joined.  A timer fires when the watermark has passed a session's end by the gap;
the row is emitted a last time as ``final`` and the session leaves the state.

A call per user, and a timer per session, cost far more than the merge itself.  So users are dealt by hash into
``BUCKETS`` state keys: a bucket's sessions are one state value of parallel arrays, merged for all its users at
once, and its one timer stands at the first end among them.

A reader that keeps rows by (user, start) and deletes what a row replaces always shows the sessions of the
events so far.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickmart import constants as C

#: the state store that values and timers need
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
#: state keys; a checkpoint holds for one number of them
BUCKETS = 1_024
_SESSION = ["user_id", "first", "last", "events", "items", "cents", "version"]
_STATE = ", ".join(f"{c} array<{'string' if c == 'user_id' else 'bigint'}>" for c in _SESSION)
_ROW = (
    "user_id string, session_start bigint, session_end bigint, events bigint, items_purchased bigint, "
    "cents bigint, version bigint, replaces array<bigint>, final boolean"
)
_COLUMNS = [c.split()[0] for c in _ROW.split(", ")]


def merged(sessions: list[tuple], events: list[tuple], gap: int) -> list[tuple[tuple, list[int]]]:
    """Sessions after ``events`` (time, item or none, cents), each with the starts of the sessions it is made of.

    A session is (first, last, events, items, cents, version); a gap of exactly ``gap`` does not part.
    """
    pieces = [(s, [s[0]]) for s in sessions] + [((t, t, 1, n, c, 0), []) for t, n, c in events]
    found: list[tuple[tuple, list[int]]] = []
    for piece, starts in sorted(pieces, key=lambda p: p[0][:2]):
        if found and piece[0] - found[-1][0][1] <= gap:
            last, own = found[-1]
            joined = (
                last[0], max(last[1], piece[1]), last[2] + piece[2], last[3] + piece[3], last[4] + piece[4],
                max(last[5], piece[5]),
            )
            found[-1] = (joined, own + starts)
        else:
            found.append((piece, list(starts)))
    return found


def _sessions(values) -> pd.DataFrame:
    """Sessions as a table, from one sequence per column."""
    table = pd.DataFrame(dict(zip(_SESSION, values, strict=True)))
    return table.astype({c: "int64" for c in _SESSION[1:]}).astype({"user_id": object})


def merged_users(state: pd.DataFrame, events: pd.DataFrame, gap: int) -> pd.DataFrame:
    """``merged`` for many users at once: sessions with ``changed`` and the starts that they replace.

    ``events`` are sessions of one event.
    """
    pieces = pd.concat([state, events], ignore_index=True)
    user = pd.factorize(pieces["user_id"])[0]
    order = np.lexsort((pieces["last"], pieces["first"], user))
    pieces, user, known = pieces.take(order), user[order], order < len(state)
    first = pieces["first"].to_numpy()
    reach = pieces["last"].groupby(user).cummax().to_numpy()
    opens = np.ones(len(pieces), bool)
    opens[1:] = (user[1:] != user[:-1]) | (first[1:] - reach[:-1] > gap)
    at = np.flatnonzero(opens)
    found = pd.DataFrame({
        "user_id": pieces["user_id"].to_numpy()[at], "first": first[at],
        **{c: np.maximum.reduceat(pieces[c].to_numpy(), at) for c in ("last", "version")},
        **{c: np.add.reduceat(pieces[c].to_numpy(), at) for c in ("events", "items", "cents")},
    }).astype({"user_id": object})
    found["changed"] = ~np.logical_and.reduceat(known, at)
    found["version"] += found["changed"]
    found["replaces"] = [[] for _ in at]
    session = np.cumsum(opens) - 1
    for i in np.flatnonzero(known & (first != first[at][session])):
        found["replaces"].iat[session[i]].append(int(first[i]))
    return found


class LiveSessions(StatefulProcessor):
    def __init__(self, gap_millis: int):
        self.gap = gap_millis

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def _state(self) -> pd.DataFrame:
        return _sessions(self.open.get() or [[]] * len(_SESSION))

    def _keep(self, sessions: pd.DataFrame) -> int | None:
        """Store the open sessions of a bucket; when the first of them ends."""
        if not len(sessions):
            self.open.clear()
            return None
        self.open.update(tuple(sessions[c].tolist() for c in _SESSION))
        return self._first_end(sessions)

    def _first_end(self, sessions: pd.DataFrame) -> int | None:
        return int(sessions["last"].min()) + self.gap if len(sessions) else None

    def _rows(self, sessions: pd.DataFrame, final: bool) -> Iterator[pd.DataFrame]:
        if len(sessions):
            yield sessions.assign(final=final)[[*_SESSION, "replaces", "final"]].set_axis(_COLUMNS, axis=1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        one, at = np.ones(len(batch), "int64"), batch["at"]
        before = self._state()
        events = _sessions([batch["user_id"], at, at, one, batch["item"], batch["cents"], one * 0])
        after = merged_users(before, events, self.gap)
        was, now = self._first_end(before), self._keep(after)
        if was != now:
            if was is not None:
                self.handle.deleteTimer(was)
            self.handle.registerTimer(now)
        yield from self._rows(after[after["changed"]], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        sessions = self._state()
        over = sessions["last"] + self.gap <= passed
        after = self._keep(sessions[~over])
        if after is not None:
            self.handle.registerTimer(after)
        done = sessions[over]
        yield from self._rows(done.assign(version=done["version"] + 1, replaces=[[] for _ in range(len(done))]), True)

    def close(self) -> None:
        pass


def live_sessions(events: DataFrame, gap_seconds: int = C.SESSION_GAP_SECONDS, delay: str = C.RETENTION) -> DataFrame:
    """Versions of sessions as ``events`` (user_id, event_type, event_ts, price) come; the session needs ``STATE_STORE``."""
    bought = F.col("event_type") == C.PURCHASE
    cents = F.when(bought, F.coalesce(F.col("price") * 100, F.lit(0))).otherwise(0).cast("bigint")
    rows = events.withWatermark("event_ts", delay).select(
        F.pmod(F.xxhash64("user_id"), F.lit(BUCKETS)).alias("bucket"), "user_id", "event_ts",
        F.unix_millis("event_ts").alias("at"), bought.cast("bigint").alias("item"), cents.alias("cents"),
    )
    versions = rows.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=LiveSessions(gap_seconds * 1000), outputStructType=_ROW, outputMode="Append",
        timeMode="EventTime",
    )
    return versions.select(
        "user_id", F.timestamp_millis("session_start").alias("session_start"),
        F.timestamp_millis("session_end").alias("session_end"), "events", "items_purchased",
        F.when(F.col("items_purchased") > 0, (F.col("cents").cast("decimal(38,0)") / 100).cast("decimal(38,2)"))
        .alias("total_revenue"),
        "version",
        F.transform("replaces", F.timestamp_millis).alias("replaces"), "final",
    )


def current(versions: DataFrame) -> DataFrame:
    """The newest version of every session that no later row replaces."""
    gone = versions.select("user_id", "version", F.explode("replaces").alias("session_start"))
    last_gone = gone.groupBy("user_id", "session_start").agg(F.max("version").alias("gone"))
    newest = F.max_by(F.struct(*versions.columns), "version").alias("row")
    rows = versions.groupBy(F.col("user_id").alias("u"), F.col("session_start").alias("s")).agg(newest).select("row.*")
    return rows.join(last_gone, ["user_id", "session_start"], "left").filter(
        F.col("gone").isNull() | (F.col("version") > F.col("gone"))
    ).drop("gone")
