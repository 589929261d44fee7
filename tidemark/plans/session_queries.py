"""Queries of sessions, pauses, breaks, places, installed apps, documents and dumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import activity, apps, documents, places, sessions, vectors
from tidemark.operators.dealing import tasks
from tidemark.plans import adapter as ad
from tidemark.plans.aggregate_queries import _with, split_sql
from tidemark.plans.registry import query
from tidemark.schema import DAILY, DAY, HOURLY, MINUTE
from tidemark.session import scratch
from tidemark.sources import dump, tables

_WIDE = {"session_cutoff": 24 * 3_600_000, "pause_cutoff": 6 * 3_600_000}

_APP_SESSIONS = """
a as (
  select *, coalesce(last_value(case when kind <> 'S' then kind end ignore nulls) over (w rows between unbounded preceding and 1 preceding) = 'L' and kind <> 'U', false) as absorbed
  from we window w as (partition by userId order by time, rank, id)
), b as (
  select * exclude app, last_value(case when kind = 'S' then {'v': app} when absorbed then {'v': null::varchar} end ignore nulls) over (w rows between unbounded preceding and current row)['v'] as app
  from a window w as (partition by userId order by time, rank, id)
), c as (
  select *, coalesce(kind = 'S' and lag(kind) over w in ('S', 'U') and lag(app) over w is not distinct from app, false) as goes_on
  from b where not absorbed window w as (partition by userId order by time, rank, id)
), d as (
  select *, sum(case when goes_on then 0 else 1 end) over (partition by userId order by time, rank, id rows between unbounded preceding and current row) as segment from c
), e as (
  select userId, segment, min(time) as start, max(time) as last, bool_or(kind = 'S') as seen, arg_min(kind, (time, rank, id)) as first, max(app) as app from d group by userId, segment
), f as (
  select *, lead(start) over w as next_start, lead(first) over w as next_kind from e window w as (partition by userId order by segment)
), app_sessions as (
  select userId, start as time, case when next_start is null or (next_kind = 'U' and seen) then last else next_start end - start as duration, app
  from f where first <> 'L' and app is not null and (next_start is not null or seen)
)"""


@query(_with(ad.EV, ad.WINDOW_EVENTS, _APP_SESSIONS) + "select * from app_sessions")
def app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.app_sessions(ad.window_events(spark, sf_dir))


@query(_with(ad.EV) + "select id, userId, time, kind from ev where userId = (select min(userId) from ev) and time >= (select min(time) from ev)")
def events_of_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first user's events, read from all events in order of user and time: other users' row groups are skipped."""
    path = scratch(spark, "sorted")
    tables.write_sorted(ad.base(spark, sf_dir).select("id", "userId", "time", "kind"), f"{path}/events", group_bytes=1 << 20)
    bounds = spark.read.parquet(f"{path}/events").agg(F.min("userId").alias("user"), F.min("time").alias("since")).first()
    return tables.read_events(spark, path, "events", (F.col("userId") == bounds.user) & (F.col("time") >= bounds.since))


@query(_with(ad.EV, ad.WINDOW_EVENTS, _APP_SESSIONS) + "select * from app_sessions")
def app_sessions_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """app_sessions over a table that lies in buckets of users."""
    rows = tables.write_bucketed(ad.window_events(spark, sf_dir), f"window_events_{tables.random_name()}", scratch(spark, "bucketed"), buckets=16)
    return sessions.app_sessions(rows)


_VECTORS = """
word as (select 'app' || k as app, row_number() over (order by 'app' || k) - 1 as i from (select distinct k from ev)),
day as (select userId, time - time % 86400000 as time, i, count(*) as n from ev join word on app = 'app' || k group by 1, 2, 3),
ordered as (select userId, time, row_number() over (partition by userId order by time) as d from (select distinct userId, time from day)),
own as (select userId, d, string_agg(i || ':' || n, ' ' order by i) as vector from day join ordered using (userId, time) group by userId, d),
joint as (select userId, d, string_agg(i || ':' || n, ' ' order by i) as sums from (select o.userId, o.d, x.i, sum(x.n)::bigint as n from ordered o join ordered b on b.userId = o.userId and b.d in (o.d, o.d - 1) join day x on x.userId = b.userId and x.time = b.time group by 1, 2, 3) group by userId, d)"""


@query(_with(ad.EV, _VECTORS) + "select userId, time, vector, sums from ordered join own using (userId, d) join joint using (userId, d)")
def app_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day's use of apps as a sparse vector, and its sum with that of the day of use before."""
    use = ad.base(spark, sf_dir).select("userId", (F.col("time") - F.col("time") % DAY).alias("time"), F.concat(F.lit("app"), F.col("k")).alias("app"))
    rows = use.join(apps.dictionary(use), "app").withColumn("value", F.lit(1))
    days = vectors.gathered(rows, "userId", "time")
    before = F.lag("vector").over(Window.partitionBy("userId").orderBy("time"))
    return days.select("userId", "time", vectors.as_text(F.col("vector")).alias("vector"), vectors.as_text(vectors.add(F.col("vector"), before)).alias("sums"))


_ONE = "we as (select * replace (0 as userId) from we_all)"


@query(_with(ad.EV, ad.WINDOW_EVENTS.replace("we as", "we_all as", 1), _ONE, _APP_SESSIONS) + "select * from app_sessions")
def app_sessions_one_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one user's, whose history is worked on in slices of a day."""
    return sessions.sliced_app_sessions(ad.window_events(spark, sf_dir).withColumn("userId", F.lit(0).cast("long")), slice_millis=DAY)


_SINCE, _UNTIL = 1_704_240_000_000, 1_706_000_000_000


@query(_with(ad.EV, ad.WINDOW_EVENTS, _APP_SESSIONS) + f"select * from app_sessions where time > {_SINCE} and time < {_UNTIL} and duration // 1000 < 21600")
def good_app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.good_sessions(app_sessions(spark, sf_dir), since=_SINCE, until=_UNTIL, longest_seconds=21_600)


_COLLECTED = "collected as (select userId, time, duration, 'app' || k as app from ev where kind = 'signup')"


@query(
    _with(ad.EV, ad.WINDOW_EVENTS, _APP_SESSIONS, _COLLECTED)
    + "select userId, time, duration, app from collected union all select userId, time, duration, app from app_sessions left join (select userId, min(time) as first from collected group by 1) using (userId) where first is null or time < first"
)
def combined_app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups stand for the sessions that the phone has collected itself."""
    collected = ad.base(spark, sf_dir).filter("kind = 'signup'").select("userId", "time", "duration", F.concat(F.lit("app"), F.col("k")).alias("app"))
    return sessions.combine_sessions(collected, app_sessions(spark, sf_dir))


def phone_sql(session_cutoff: int, pause_cutoff: int) -> str:
    changed = f"(n.time - s.st > {session_cutoff} or n.time - s.en > {pause_cutoff})"
    return f"""
o as (select *, row_number() over (partition by userId order by time, rank, id) as rn from pe),
fold as (
  select userId, rn, time as st, time + duration as en, kind = 'U' as unlocked, false as emit, kind, shown, duration, app from o where rn = 1
  union all
  select n.userId, n.rn, case when {changed} then n.time else s.st end, n.time + n.duration,
    case when s.unlocked or {changed} then n.kind <> 'L' else n.kind = 'U' end, (s.unlocked or {changed}) and n.kind = 'F', n.kind, n.shown, n.duration, n.app
  from fold s join o n on n.userId = s.userId and n.rn = s.rn + 1
), phone as (
  select userId, st as sessionStart, shown as time, duration, app from fold where emit
)"""


def _recursive(*ctes: str) -> str:
    return "with recursive " + ", ".join(ctes) + " "


_NARROW_SQL = phone_sql(sessions.SESSION_CUTOFF, sessions.PAUSE_CUTOFF)
_WIDE_SQL = phone_sql(_WIDE["session_cutoff"], _WIDE["pause_cutoff"])


@query(_recursive(ad.EV, ad.PHONE_EVENTS, _NARROW_SQL) + "select * from phone")
def phone_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.phone_sessions(ad.phone_events(spark, sf_dir))


def _phone_sessions_wide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Phone sessions and how many tasks their users are dealt to."""
    events = ad.phone_events(spark, sf_dir)
    n = tasks(events)
    return sessions.phone_sessions(events, **_WIDE, partitions=n), n


@query(_recursive(ad.EV, ad.PHONE_EVENTS, _WIDE_SQL) + "select * from phone")
def phone_sessions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _phone_sessions_wide(spark, sf_dir)[0]


_INACTIVITY = """
inactivity as (
  select userId, last_end as time, sessionStart - last_end as duration from (
    select *, coalesce(lag(sessionStart) over w, time) as last_start, coalesce(lag(time + duration) over w, time) as last_end
    from phone window w as (partition by userId order by time, sessionStart, app, duration)) where sessionStart <> last_start
)"""


@query(_recursive(ad.EV, ad.PHONE_EVENTS, _WIDE_SQL, _INACTIVITY) + "select * from inactivity")
def inactivity_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone, n = _phone_sessions_wide(spark, sf_dir)
    return sessions.inactivity_sessions(phone, partitions=n)


_FILTER_START = 1_704_500_000_000
_KEPT = f"kept as (select * from inactivity where not (time < {_FILTER_START} and duration > {DAY}))"
_INTERVALS = "(select unnest([0, 5, 10, 15, 20, 30, 60]) as interval)"


def _positive_sql(measure: str, name: str, where: str = "true") -> str:
    return _recursive(ad.EV, ad.PHONE_EVENTS, _WIDE_SQL, _INACTIVITY, _KEPT) + " union all ".join(
        f"select userId, b as time, {g.code} as granularity, interval, sum({measure})::bigint as {name} from ({split_sql('kept', g.millis)}), {_INTERVALS} where {where} group by userId, b, interval" for g in (DAILY, HOURLY)
    )


@query(_positive_sql(f"greatest(0, piece - interval * {MINUTE})", "millis"))
def positive_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.positive_time(inactivity_sessions(spark, sf_dir), filter_start=_FILTER_START).drop("count")


@query(_positive_sql(f"trunc(piece / (interval * {MINUTE})::double)::bigint", "count", "interval > 0"))
def positive_interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.positive_time(inactivity_sessions(spark, sf_dir), intervals=activity.INTERVALS[1:], filter_start=_FILTER_START).drop("millis")


@query(
    _with(
        ad.EV,
        ad.SESSIONS,
        f"ends as (select *, time + duration as stop, time - time % {DAY} + {DAY - 1} as midnight from sessions)",
        "change as (select userId, id, time as t, 1 as start from ends union all select userId, id, stop, 0 from ends "
        f"union all select userId, id, midnight, 0 from ends where stop > midnight union all select userId, id, stop - stop % {DAY}, 1 from ends where stop > midnight)",
        f"daily as (select *, t - t % {DAY} as day from change)",
        "placed as (select *, row_number() over w as place, lag(t) over w as last, lag(start) over w as last_start from daily window w as (partition by userId, day order by t, start, id))",
        "begun as (select *, min(case when place > 1 and start = 0 then place end) over (partition by userId, day) as begun from placed)",
    )
    + f"select userId, day, interval, sum(greatest(0, t - last - interval * {MINUTE}))::bigint as minutes from begun, {_INTERVALS} where start = 1 and last_start = 0 and place > begun group by userId, day, interval"
)
def positive_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.positive_minutes(ad.sessions(spark, sf_dir))


_BREAKS = f"""
breaks as (
  select userId, time, duration, "end", rank from (
    select *, time + duration as "end", row_number() over (partition by userId, (time + duration) - (time + duration) % {DAY} order by duration desc, time)::int as rank from inactivity) where rank <= 2
)"""


@query(_recursive(ad.EV, ad.PHONE_EVENTS, _WIDE_SQL, _INACTIVITY, _BREAKS) + "select * from breaks")
def longest_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.longest_breaks(inactivity_sessions(spark, sf_dir), 2)


_CLUSTERS = """
clusters as (
  select p.userId, p.time, p.duration, p.app, coalesce(b."end", least(p.first, coalesce(f.first, p.first))) as clusterStartTime, coalesce(b.rank, 0) as lastInactivitySessionRank
  from (select *, min(time) over (partition by userId) as first, row_number() over () as n from phone) p
  left join (select userId, min(time) as first from breaks group by 1) f on f.userId = p.userId
  left join lateral (select x."end", x.rank from breaks x where x.userId = p.userId and x.time < p.time order by x.time desc, x."end" desc, x.rank desc limit 1) b on true
)"""


@query(_recursive(ad.EV, ad.PHONE_EVENTS, _WIDE_SQL, _INACTIVITY, _BREAKS, _CLUSTERS) + "select * from clusters")
def activity_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    phone, n = _phone_sessions_wide(spark, sf_dir)
    return activity.activity_clusters(phone, sessions.inactivity_sessions(phone, partitions=n), 2)


_PLACES = "places as (select points.*, id % 5 + 10 as cluster from points where accuracy <> 0)"
_FRAGMENTS = """
fragments as (
  select s.userId, coalesce(p.time, 0) as locationChangeTime, coalesce(p.cluster, 999999)::bigint as locationCluster, s.time, s.duration, s.app
  from sessions s left join lateral (select x.time, x.cluster from places x where x.userId = s.userId and x.time < s.time order by x.time desc, x.id desc limit 1) p on true
)"""


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = ad.points(spark, sf_dir)
    clusters = points.select("id", (F.col("id") % 5 + 10).alias("cluster"))
    return places.located(points, clusters)


@query(_with(ad.EV, ad.POINTS, _PLACES) + "select id, userId, time, cluster from places")
def located_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select("id", "userId", "time", "cluster")


@query(_with(ad.EV, ad.POINTS, ad.SESSIONS, _PLACES, _FRAGMENTS) + "select * from fragments")
def location_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.location_fragments(ad.sessions(spark, sf_dir), _places(spark, sf_dir))


_HALF_CHORD = "pow(sin(radians({c} - {a}) / 2), 2) + pow(sin(radians({d} - {b}) / 2), 2) * cos(radians({a})) * cos(radians({c}))"
_HAVERSINE = f"12745.6 * asin(sqrt(case when {_HALF_CHORD} > 1 then 1.0 else {_HALF_CHORD} end))"


@query(
    _with(ad.EV, ad.POINTS)
    + f"select userId, day, count(*)::int as points, round(coalesce(sum(step), 0), 6) as distance from (select *, {_HAVERSINE.format(a='la', b='ln', c='latitude', d='longitude')} as step from "
    + f"(select *, time - time % {DAY} as day, lag(latitude) over w as la, lag(longitude) over w as ln from points where accuracy > 0 window w as (partition by userId, time - time % {DAY} order by time, id))) group by userId, day"
)
def path_covered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.path_covered(ad.points(spark, sf_dir)).withColumn("distance", F.round("distance", 6))


@query(
    _with(ad.EV, ad.POINTS, f"spots as (select distinct userId, time - time % {DAY} as day, latitude, longitude from points where accuracy > 0)")
    + "select userId, day, lat1, lng1, lat2, lng2, round(dist, 6) as dist from (select *, row_number() over (partition by userId, day order by -round(dist, 9), lat1, lng1, lat2, lng2) as n from "
    + f"(select a.userId, a.day, a.latitude as lat1, a.longitude as lng1, b.latitude as lat2, b.longitude as lng2, {_HAVERSINE.format(a='a.latitude', b='a.longitude', c='b.latitude', d='b.longitude')} as dist "
    + "from spots a join spots b on a.userId = b.userId and a.day = b.day and (a.latitude, a.longitude) <= (b.latitude, b.longitude))) where n = 1"
)
def daily_radius(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.daily_radius(ad.points(spark, sf_dir)).withColumn("dist", F.round("dist", 6))


_CHANGES = (
    "change as (select userId, time, unnest(list_distinct(['app' || k, 'app' || (k::int % 7), 'core'])) as app, true as present from ev where kind = 'signup' "
    "union all select userId, time, 'app' || k, true from ev where kind = 'view' union all select userId, time, 'app' || k, false from ev where kind = 'click')"
)


def _app_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.base(spark, sf_dir)
    app = F.concat(F.lit("app"), F.col("k"))
    listed = rows.filter("kind = 'signup'").select("userId", "time", F.array(app, F.concat(F.lit("app"), (F.col("k").cast("int") % 7).cast("string")), F.lit("core")).alias("installedApps"))
    return apps.app_changes(listed, rows.filter("kind = 'view'").select("userId", "time", app.alias("packageName")), rows.filter("kind = 'click'").select("userId", "time", app.alias("packageName")))


def _usage_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad.sessions(spark, sf_dir).select("userId", (F.col("time") - F.col("time") % DAY).alias("time")).distinct()


@query(
    _with(
        ad.EV,
        ad.SESSIONS,
        _CHANGES,
        "word as (select userId, app, time, bool_and(present) as present from change group by 1, 2, 3)",
        f"moment as (select distinct userId, time from (select userId, time from change union all select userId, time - time % {DAY} from sessions union all select userId, 0 from change))",
        "known as (select m.userId, m.time, w.app, arg_max(w.present, w.time) as present from moment m join word w on w.userId = m.userId and w.time <= m.time group by 1, 2, 3)",
    )
    + "select m.userId, m.time, coalesce(string_agg(app, ',' order by app) filter (present), '') as apps from moment m left join known k on k.userId = m.userId and k.time = m.time group by 1, 2"
)
def installed_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apps.installed_apps(_app_changes(spark, sf_dir), _usage_days(spark, sf_dir)).withColumn("apps", F.array_join("apps", ","))


_WORDS = "words as (select row_number() over (order by app) - 1 as index, app from (select distinct app from sessions))"


@query(_with(ad.EV, ad.SESSIONS, _WORDS) + "select index, app from words")
def app_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apps.dictionary(ad.sessions(spark, sf_dir))


_STUDY = f"""
study as (
  select userId, a as startTime, z as endTime, trunc((z - a) / {DAY}::double)::bigint as days from (
    select userId, min(time) - min(time) % {DAY} + {DAY} as a, max(time) - max(time) % {DAY} as z from sessions group by 1)
)"""


def _study(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ad.sessions(spark, sf_dir)
    return documents.user_days(rows.select(F.col("userId").alias("user")), rows)


@query(_with(ad.EV, ad.SESSIONS, _STUDY) + "select * from study")
def user_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _study(spark, sf_dir)


@query(_with(ad.EV, ad.SESSIONS, _STUDY) + "select id, userId, time, duration, app from sessions join study using (userId) where time >= startTime and time < endTime")
def sessions_in_study(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.in_study(ad.sessions(spark, sf_dir), _study(spark, sf_dir)).select("id", "userId", "time", "duration", "app")


def _document_sql(template: str, aggregate: str) -> str:
    t = documents.TEMPLATES[template]
    source = {"phone": "phone", "locations": "fragments", "clusters": "clusters"}[t.source]
    measure = "count(duration)" if aggregate == "COUNT" else "sum(duration)"
    return (
        f"select row_number() over (order by userId, documentTime, documentClusterType) - 1 as id, userId, documentTime, documentClusterType, '[' || string_agg('[' || key || ', ' || value || ']', ',' order by key) || ']' as document from ("
        f"select userId, ({t.time})::bigint as documentTime, ({t.cluster})::int as documentClusterType, index as key, {measure}::bigint as value from {source} join words using (app) group by 1, 2, 3, 4) group by userId, documentTime, documentClusterType"
    )


def _register_documents() -> None:
    head = _recursive(ad.EV, ad.SESSIONS, _WORDS, ad.POINTS, ad.PHONE_EVENTS, _WIDE_SQL, _INACTIVITY, _BREAKS, _CLUSTERS, _PLACES, _FRAGMENTS)

    def make(template: str, aggregate: str):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            source = {"phone": phone_sessions_wide, "locations": location_fragments, "clusters": activity_clusters}[documents.TEMPLATES[template].source]
            words = apps.dictionary(ad.sessions(spark, sf_dir))
            out = documents.documents(source(spark, sf_dir), words, template, aggregate)
            return out.withColumn("document", documents.as_text())

        return run

    for template in documents.TEMPLATES:
        for aggregate in ("COUNT", "SUM"):
            query(head + _document_sql(template, aggregate), f"documents_{template}_{aggregate.lower()}")(make(template, aggregate))


_register_documents()


def _dump_lines(spark: SparkSession, sf_dir: str, number: int, payload) -> DataFrame:
    """Lines of a dump made from the events table, with quoted and raw payloads in turn and junk between."""
    stamp = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    raw = payload
    quoted = F.concat(F.lit('"'), F.replace(raw, F.lit('"'), F.lit('\\\\"')), F.lit('"'))
    data = F.when(F.col("event_id") % 2 == 0, raw).otherwise(quoted)
    line = F.concat_ws("\t", F.col("event_id").cast("string"), F.col("user_id").cast("string"), F.concat(stamp, F.lit("+00")), F.lit(str(number)), data)
    rows = ad.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k"))
    return rows.select(F.when(F.col("event_id") % 13 == 0, F.lit("junk\tline")).otherwise(line).alias("value"))


@query(
    _with(ad.EV) + "select id, userId, time, 'view' as kind, 'name' || k as appName, 'org.a' || k as packageName, 'a' || chr(9) || 'b' as windowTitle from ev where id % 2 = 0 and id % 13 <> 0 "
    "union all select id, userId, time, 'view', 'name' || k, 'org.a' || k, 'ab' from ev where id % 2 = 1 and id % 13 <> 0"
)
def dump_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.when(F.col("event_id") % 2 == 0, F.lit("a\tb")).otherwise(F.lit("ab"))
    payload = F.concat(F.lit('["name'), F.col("k"), F.lit('","org.a'), F.col("k"), F.lit("/org.a"), F.col("k"), F.lit('.Main","'), title, F.lit('"]'))
    return dump.decode(dump.split_lines(_dump_lines(spark, sf_dir, 32, payload)), 32).withColumn("kind", F.lit("view"))


@query(
    _with(ad.EV) + "select id, userId, time, 'view' as kind, 'name' || k as appName, 'org.a' || k as packageName, 'a' || chr(9) || 'b' as windowTitle from ev where id % 2 = 0 and id % 13 <> 0 "
    "union all select id, userId, time, 'view', 'name' || k, 'org.a' || k, 'ab' from ev where id % 2 = 1 and id % 13 <> 0"
)
def dump_text_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dump_windows by way of a text dump on disk and the event table made of it."""
    title = F.when(F.col("event_id") % 2 == 0, F.lit("a\tb")).otherwise(F.lit("ab"))
    payload = F.concat(F.lit('["name'), F.col("k"), F.lit('","org.a'), F.col("k"), F.lit("/org.a"), F.col("k"), F.lit('.Main","'), title, F.lit('"]'))
    base = scratch(spark, "dump")
    _dump_lines(spark, sf_dir, 32, payload).select("value").write.text(f"{base}/text")
    tables.write_table(dump.decode(dump.read_dump(spark, f"{base}/text"), 32), f"{base}/window_state_changed")
    return tables.read_events(spark, base, "window_state_changed").withColumn("kind", F.lit("view"))


@query("select p_brand as key, p_type as category, count(*) as n from part where p_size > 10 group by all")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts written as a table and, filtered in its scan, as CSV with a header; what the CSV says, counted."""
    base = scratch(spark, "csv")
    tables.write_table(spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand", "p_type", "p_size"), f"{base}/part")
    few = tables.read_events(spark, base, "part", F.col("p_size") > 10)
    tables.write_csv(few.select(F.col("p_brand").alias("key"), F.col("p_type").alias("category")), f"{base}/lookup.csv")
    return tables.read_csv(spark, f"{base}/lookup.csv", "key string, category string").groupBy("key", "category").agg(F.count("*").alias("n"))


@query(_with(ad.EV) + "select userId, time, k::bigint * 1000 as duration, 'org.b' || k as packageName from ev where id % 13 <> 0")
def dump_app_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.lit('["1","'), F.col("k"), F.lit('","B","org.b'), F.col("k"), F.lit('"]'))
    return dump.decode(dump.split_lines(_dump_lines(spark, sf_dir, 1032, payload)), 1032)


@query(_with(ad.EV) + "select id, userId, time, 'h' || k as contactHash, k::int as messageLength, k::int % 2 <> 0 as isGroupMessage from ev where id % 13 <> 0")
def dump_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.lit('["h'), F.col("k"), F.lit('",'), F.col("k"), F.lit(","), (F.col("k").cast("int") % 2).cast("string"), F.lit("]"))
    return dump.decode(dump.split_lines(_dump_lines(spark, sf_dir, 1019, payload)), 1019)


@query(_with(ad.EV) + "select id, userId, time, 'p' || k || ',' as installedApps from ev where id % 13 <> 0 and id % 2 = 1")
def dump_app_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.concat(F.lit('[{"pkg":"p'), F.col("k"), F.lit('"},{"name":"x"}]'))
    out = dump.decode(dump.split_lines(_dump_lines(spark, sf_dir, 1008, payload)), 1008)
    return out.withColumn("installedApps", F.array_join("installedApps", ","))


@query(
    _with(ad.EV) + "select case id % 13 when 0 then 'fields' when 1 then 'id' when 2 then 'userId' when 3 then 'time' when 4 then 'type' when 5 then 'unknown type' when 6 then 'unread type' "
    "when 7 then 'payload' when 8 then 'payload' when 9 then 'payload' else 'accepted' end as reason, count(*) as lines from ev group by 1"
)
def dump_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why lines of a dump are in no table: three of thirteen are in one, the others fail in ten ways."""
    wrong = F.col("event_id") % 13
    good = F.concat(F.lit('["name'), F.col("k"), F.lit('","org.a/b","t"]'))
    payload = F.when(wrong == 7, F.lit('["two","org.a"]')).when(wrong == 8, F.lit("no JSON")).when(wrong == 9, F.lit('["name",7,"t"]')).otherwise(good)
    number = F.when(wrong == 4, F.lit("win")).when(wrong == 5, F.lit("31337")).when(wrong == 6, F.lit("16")).otherwise(F.lit("32"))
    stamp = F.when(wrong == 3, F.lit("yesterday")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("+00")))
    first, second = F.when(wrong == 1, F.lit("x")).otherwise(F.col("event_id").cast("string")), F.when(wrong == 2, F.lit("")).otherwise(F.col("user_id").cast("string"))
    line = F.when(wrong == 0, F.concat_ws("\t", first, second, stamp)).otherwise(F.concat_ws("\t", first, second, stamp, number, payload))
    rows = ad.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k")).select(line.alias("value"))
    return dump.checked_lines(rows).groupBy(F.coalesce("reason", F.lit("accepted")).alias("reason")).agg(F.count("*").alias("lines"))
