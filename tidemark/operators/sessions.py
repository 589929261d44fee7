"""App sessions from window events, phone sessions, and the pauses between them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SESSION_CUTOFF = 3 * 3600 * 1000
PAUSE_CUTOFF = 10 * 1000


def app_sessions(events: DataFrame) -> DataFrame:
    """userId, time, duration, app from events of userId, time, rank, id, kind, app.

    Kinds: S (a window of an app), L (locked), U (unlocked). Rows are taken by time, rank, id. While locked, windows
    only tell the app that is open; a lock ends the session; an unlock goes on with that app. Windows alone decide, no
    user's rows are held together.
    """
    w = Window.partitionBy("userId").orderBy("time", "rank", "id")
    so_far, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    gate = F.last(F.when(F.col("kind") != "S", F.col("kind")), ignorenulls=True).over(before)
    rows = events.withColumn("absorbed", F.coalesce((gate == "L") & (F.col("kind") != "U"), F.lit(False)))
    # a struct around the app, as a second lock sets it to null on purpose
    told = F.when(F.col("kind") == "S", F.struct(F.col("app").alias("v"))).when(F.col("absorbed"), F.struct(F.lit(None).cast("string").alias("v")))
    rows = rows.withColumn("app", F.last(told, ignorenulls=True).over(so_far)["v"]).filter(~F.col("absorbed"))
    last_kind, last_app = F.lag("kind").over(w), F.lag("app").over(w)
    goes_on = (F.col("kind") == "S") & last_kind.isin("S", "U") & last_app.eqNullSafe(F.col("app"))
    rows = rows.withColumn("segment", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(so_far))
    order = F.struct("time", "rank", "id")
    segments = rows.groupBy("userId", "segment").agg(
        F.min("time").alias("start"), F.max("time").alias("last"), F.max(F.col("kind") == "S").alias("seen"), F.min_by("kind", order).alias("first"), F.min_by("app", order).alias("app")
    )
    nxt = Window.partitionBy("userId").orderBy("segment")
    segments = segments.withColumn("next_start", F.lead("start").over(nxt)).withColumn("next_kind", F.lead("first").over(nxt))
    return _closed(segments, F.col("next_start").isNull())


def _same(rows: DataFrame, other: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """rows with the columns of the row of `other` that has the same keys; null is a key like others."""
    named = other.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return rows.join(named, on, how).drop(*[f"_{k}" for k in keys])


def sliced_app_sessions(events: DataFrame, *, slice_millis: int = 7 * 86_400_000) -> DataFrame:
    """As app_sessions(), with a user's history cut into slices of time that different tasks work on.

    What decides a row are running values that merge: the last lock or unlock, the last app told, the last row that is not
    absorbed, the number of segments. Each slice says what it adds to them, a scan over a user's slices (a few
    numbers each) tells what comes in, and the slice's rows take that where its own rows have not told yet. Segments that reach over slices
    are merged by their number. The cut does not change the result.
    """
    rows = events.withColumn("slice", F.coalesce(F.floor(F.col("time") / slice_millis), F.lit(-1 << 62)))
    order = F.struct("time", "rank", "id")
    w = Window.partitionBy("userId", "slice").orderBy("time", "rank", "id")
    so_far, before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow), w.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("userId").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)

    gates = rows.groupBy("userId", "slice").agg(F.max_by("kind", F.when(F.col("kind") != "S", order)).alias("gate"), F.max(F.col("kind") != "S").alias("any"))
    gates = gates.select("userId", "slice", F.last(F.when(F.col("any"), F.col("gate")), ignorenulls=True).over(earlier).alias("gate_in"))
    gate = F.coalesce(F.last(F.when(F.col("kind") != "S", F.col("kind")), ignorenulls=True).over(before), F.col("gate_in"))
    rows = _same(rows, gates, "userId", "slice").withColumn("absorbed", F.coalesce((gate == "L") & (F.col("kind") != "U"), F.lit(False)))
    told = F.when(F.col("kind") == "S", F.struct(F.col("app").alias("v"))).when(F.col("absorbed"), F.struct(F.lit(None).cast("string").alias("v")))
    rows = rows.withColumn("told", F.last(told, ignorenulls=True).over(so_far)).drop("gate_in", "app")

    kept_order = F.when(~F.col("absorbed"), order)
    adds = rows.groupBy("userId", "slice").agg(F.max_by("told", order).alias("told"), F.max_by(F.struct("kind", "told"), kept_order).alias("kept"), F.max(~F.col("absorbed")).alias("any"))
    comes = adds.withColumn("app_in", F.last("told", ignorenulls=True).over(earlier)["v"])
    kept = F.when(F.col("any"), F.struct(F.col("kept.kind"), F.when(F.col("kept.told").isNull(), F.col("app_in")).otherwise(F.col("kept.told.v")).alias("app")))
    comes = comes.withColumn("kept", kept).select("userId", "slice", "app_in", F.last("kept", ignorenulls=True).over(earlier).alias("kept_in"))
    rows = _same(rows.filter(~F.col("absorbed")), comes, "userId", "slice")
    rows = rows.withColumn("app", F.when(F.col("told").isNull(), F.col("app_in")).otherwise(F.col("told.v")))
    last = F.coalesce(F.lag(F.struct("kind", "app")).over(w), F.col("kept_in"))
    goes_on = (F.col("kind") == "S") & last["kind"].isin("S", "U") & last["app"].eqNullSafe(F.col("app"))
    rows = rows.withColumn("own", F.sum(F.when(F.coalesce(goes_on, F.lit(False)), 0).otherwise(1)).over(so_far))

    def merged(over: DataFrame, *keys: str) -> DataFrame:
        return over.groupBy(*keys).agg(F.min("start").alias("start"), F.max("last").alias("last"), F.max("seen").alias("seen"), F.min_by("first", "at").alias("first"), F.min_by("app", "at").alias("app"), F.min("at").alias("at"))

    pieces = merged(rows.select("userId", "slice", "own", F.col("time").alias("start"), F.col("time").alias("last"), (F.col("kind") == "S").alias("seen"), F.col("kind").alias("first"), "app", order.alias("at")), "userId", "slice", "own")
    counts = pieces.groupBy("userId", "slice").agg(F.max("own").alias("n")).select("userId", "slice", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    segments = merged(_same(pieces, counts, "userId", "slice").withColumn("segment", F.col("base") + F.col("own")), "userId", "segment")
    following = segments.select("userId", (F.col("segment") - 1).alias("segment"), F.col("start").alias("next_start"), F.col("first").alias("next_kind"), F.lit(True).alias("more"))
    segments = _same(segments, following, "userId", "segment", how="left")
    return _closed(segments, F.col("more").isNull())


def _closed(segments: DataFrame, is_last: Column) -> DataFrame:
    """Sessions from segments and what follows them."""
    end = F.when(is_last | ((F.col("next_kind") == "U") & F.col("seen")), F.col("last")).otherwise(F.col("next_start"))
    kept = segments.filter((F.col("first") != "L") & F.col("app").isNotNull() & (~is_last | F.col("seen")))
    return kept.select("userId", F.col("start").alias("time"), (end - F.col("start")).alias("duration"), "app")


def good_sessions(sessions: DataFrame, *, since: int, until: int, longest_seconds: int = 43_200) -> DataFrame:
    """Sessions (ms) that start between the bounds (both excluded) and last less than the limit in whole seconds."""
    seconds = (F.col("duration") - F.col("duration") % 1000) / 1000
    return sessions.filter((F.col("time") > since) & (F.col("time") < until) & (seconds < longest_seconds))


def combine_sessions(phone: DataFrame, derived: DataFrame) -> DataFrame:
    """The phone's own sessions, and derived ones before each user's first (all of users without any)."""
    first = phone.groupBy("userId").agg(F.min("time").alias("first"))
    early = derived.join(first, "userId", "left").filter(F.col("first").isNull() | (F.col("time") < F.col("first"))).drop("first")
    return phone.unionByName(early)


_FRAGMENT = "userId long, sessionStart long, time long, duration long, app string"


def _filled(marks: np.ndarray) -> np.ndarray:
    """For each place the last one that is marked so far; -1 before any."""
    return np.maximum.accumulate(np.where(marks, np.arange(len(marks)), -1))


def phone_pieces(batches: Iterator[pa.RecordBatch], session_cutoff: int, pause_cutoff: int) -> Iterator[pa.RecordBatch]:
    """Pieces of rows (userId, time, kind, shown, duration, app) that are sorted by user and time.

    Pauses and locks are told by arrays; only a stretch without pauses that is longer than a session may be is walked, by
    a search for each session's end. Between batches user, start, end and lock of the last row are kept.
    """
    last: tuple[int | None, int, int, bool] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        users, kinds = batch.column("userId"), batch.column("kind")
        u, known = pc.fill_null(users, 0).to_numpy(zero_copy_only=False), pc.is_valid(users).to_numpy(zero_copy_only=False)
        t, ends = (c.to_numpy(zero_copy_only=False) for c in (batch.column("time"), pc.add(batch.column("time"), pc.fill_null(batch.column("duration"), 0))))
        is_kind = {k: pc.fill_null(pc.equal(kinds, k), False).to_numpy(zero_copy_only=False) for k in "FUL"}
        fresh = np.append(True, (u[1:] != u[:-1]) | (known[1:] != known[:-1]))
        before, start, unlocked = np.append(t[0], ends[:-1]), int(t[0]), False
        if last and last[0] == (int(u[0]) if known[0] else None):
            fresh[0], start, before[0], unlocked = False, last[1], last[2], last[3]
        changed = ~fresh & (t - before > pause_cutoff)
        borders = np.flatnonzero(np.append(True, (fresh | changed)[1:]))
        begins = t[borders]
        if not (fresh[0] or changed[0]):
            begins[0] = start  # the session goes on from the batch before
        stops = np.append(borders[1:], len(t))
        for i in np.flatnonzero(t[stops - 1] - begins > session_cutoff):
            lo, hi, begin = borders[i], stops[i], begins[i]
            while t[hi - 1] - begin > session_cutoff:
                lo += np.searchsorted(t[lo:hi], begin + session_cutoff, "right")
                changed[lo], begin = True, t[lo]
        since = _filled(fresh | changed)
        starts = np.where(since < 0, start, t[since])
        # a lock locks, an unlock or any other change unlocks, a new user begins locked; what else comes leaves it as it is
        opens = is_kind["U"] | (changed & ~is_kind["L"])
        state, told = _filled(opens | is_kind["L"]), _filled(fresh)
        after = np.where(state < told, False, np.where(state < 0, unlocked, opens[state]))
        was = np.where(fresh, False, np.append(unlocked, after[:-1]))
        out = pa.array(is_kind["F"] & (was | changed))
        last = (int(u[-1]) if known[-1] else None, int(starts[-1]), int(ends[-1]), bool(after[-1]))
        columns = [users, pa.array(starts, pa.int64()), batch.column("shown"), pc.fill_null(batch.column("duration"), 0), batch.column("app")]
        yield pa.RecordBatch.from_arrays([c.filter(out) for c in columns], ["userId", "sessionStart", "time", "duration", "app"])


def phone_sessions(events: DataFrame, *, session_cutoff: int = SESSION_CUTOFF, pause_cutoff: int = PAUSE_CUTOFF, partitions: int | None = None) -> DataFrame:
    """userId, sessionStart, time, duration, app from events of userId, time, rank, id, kind, shown, duration, app.

    Kinds: F (an app, call or message), U (unlocked), L (locked), others. shown: the time a piece is given. A session
    changes if the event is later than `session_cutoff` after its start or `pause_cutoff` after the last event's end. In
    an unlocked or changed session F gives a piece and unlocks, L locks, others unlock; in the locked rest
    only U unlocks. Each boundary depends on the one before, so this is a fold over batches: rows are sorted by user and
    time, and a task keeps four fields of the user it is at. Rows without time take no part; a null duration is 0.
    """
    columns = ["userId", "time", "kind", "shown", "duration", "app"]
    timed = events.filter("time is not null")
    dealt = timed.repartition(partitions, "userId") if partitions else timed.repartition("userId")
    rows = dealt.sortWithinPartitions("userId", "time", "rank", "id").select(*[F.col(c).cast("long") if c in ("userId", "time", "shown", "duration") else F.col(c) for c in columns])
    return rows.mapInArrow(lambda batches: phone_pieces(batches, session_cutoff, pause_cutoff), _FRAGMENT)


def inactivity_sessions(phone: DataFrame, *, partitions: int | None = None) -> DataFrame:
    """userId, time, duration: from the end of the last piece to the start of the next session, wherever a session begins.

    Both are the first piece's own time before it, so a piece that is shown elsewhere than in its session gives a row.
    Durations may be negative. Pieces are taken by time, session start and app. partitions: of users, which what is made of
    the pauses keeps (see dealing.tasks).
    """
    phone = phone.repartition(partitions, "userId") if partitions else phone
    w = Window.partitionBy("userId").orderBy("time", "sessionStart", "app", "duration")
    last_start = F.coalesce(F.lag("sessionStart").over(w), F.col("time"))
    last_end = F.coalesce(F.lag(F.col("time") + F.col("duration")).over(w), F.col("time"))
    rows = phone.withColumn("_start", last_start).withColumn("_end", last_end).filter(F.col("sessionStart") != F.col("_start"))
    return rows.select("userId", F.col("_end").alias("time"), (F.col("sessionStart") - F.col("_end")).alias("duration"))
