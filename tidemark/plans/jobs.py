"""The batch jobs over a data folder, alone or all in order: python -m tidemark.plans.jobs JOB FOLDER [DUMP].

Each reads the tables it needs from the folder and writes its own there. `ingest` takes the path of a dump.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import activity, aggregates, apps, categories, documents, places, sessions, sleep, summary
from tidemark.operators.dealing import dealt
from tidemark.schema import DAILY, FIVE_MIN, GRANULARITIES, SPECS
from tidemark.sources import dump, tables

#: Bounds of sessions that count: from 2013 on, and a day far ahead; jobs take them as they are.
SINCE, UNTIL = 1_356_998_400_000, 4_102_444_800_000


def _read(spark: SparkSession, base: str, table: str) -> DataFrame:
    return tables.read_events(spark, base, table)


def _some(spark: SparkSession, base: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    return {n: _read(spark, base, n) for n in names if tables.exists(spark, f"{base}/{n}")}


def _write(df: DataFrame, base: str, name: str) -> None:
    tables.write_table(df, f"{base}/{name}", overwrite=True)


def ingest(spark: SparkSession, base: str, path: str) -> dict[str, int]:
    """The event tables of a dump, and its other lines with their reasons (rejected_lines); the counts of both."""
    tables.write_events(dump.read_dump(spark, path), base, overwrite=True)
    seen = Observation("dump")
    _write(dump.observed(dump.checked_lines(spark.read.text(path)), seen).filter("reason is not null").select("value", "reason"), base, "rejected_lines")
    return seen.get


def _gate(spark: SparkSession, base: str, table: str, kind: str, rank: int) -> DataFrame:
    return _read(spark, base, table).select("userId", "time", F.lit(rank).alias("rank"), "id", F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("app"))


def app_sessions(spark: SparkSession, base: str) -> None:
    """Sessions from window events, filtered, united with those the phones collected."""
    windows = _read(spark, base, "window_state_changed").select("userId", "time", F.lit(3).alias("rank"), "id", F.lit("S").alias("kind"), F.col("packageName").alias("app"))
    gates = [_gate(spark, base, "screen_off", "L", 0), _gate(spark, base, "dreaming_started", "L", 1), _gate(spark, base, "screen_unlock", "U", 2)]
    derived = sessions.app_sessions(reduce(DataFrame.unionByName, gates, windows))
    _write(sessions.good_sessions(derived, since=SINCE, until=UNTIL), base, "app_session_calculated")
    phone = _read(spark, base, "app_session").select("userId", "time", "duration", F.col("packageName").alias("app"))
    _write(sessions.good_sessions(phone, since=SINCE, until=UNTIL), base, "app_session_filtered")
    both = sessions.combine_sessions(spark.read.parquet(f"{base}/app_session_filtered"), spark.read.parquet(f"{base}/app_session_calculated"))
    _write(both.select("userId", "time", "duration", F.col("app").alias("packageName")), base, "app_session_combined")


def _usage(spark: SparkSession, base: str) -> DataFrame:
    name = "app_session_combined" if tables.exists(spark, f"{base}/app_session_combined") else "app_session"
    return _read(spark, base, name)


def metrics(spark: SparkSession, base: str) -> None:
    """All metrics of all event tables at all granularities, as one table by metric and level."""
    found = _some(spark, base, tuple(s.event for s in SPECS)) | {"app_session": _usage(spark, base)}
    tables.write_aggregates(aggregates.suite(found, SPECS, GRANULARITIES), base, overwrite=True)


def by_category(spark: SparkSession, base: str) -> None:
    lookup = tables.read_csv(spark, f"{base}/categories.csv", "key string, category string")
    entries = spark.read.parquet(f"{base}/aggregates")
    sums = [
        categories.by_category(entries.filter(F.col("metric") == m), lookup).withColumn("metric", F.lit(n)) for m, n in (("app_total_count", "category_total_count"), ("app_total_duration", "category_total_duration"))
    ]
    events = aggregates.events_kv(_usage(spark, base), SPECS[0])
    distinct = [categories.distinct_by_category(events, lookup, g).withColumn("metric", F.lit("category_total_count_unique")) for g in GRANULARITIES]
    _write(reduce(DataFrame.unionByName, sums + distinct), base, "category_aggregates")


def summaries(spark: SparkSession, base: str) -> None:
    _write(summary.summarise(spark.read.parquet(f"{base}/aggregates")), base, "summary")


def _piece(df: DataFrame, app: Column, kind: str = "F", shown: str = "time", duration: str | None = None, rank: int = 3) -> DataFrame:
    length = F.col(duration) if duration else F.lit(0).cast("long")
    number = F.col("id") if "id" in df.columns else F.lit(0).cast("long")
    return df.select("userId", "time", F.lit(rank).alias("rank"), number.alias("id"), F.lit(kind).alias("kind"), F.col(shown).alias("shown"), length.alias("duration"), app.alias("app"))


def phone_sessions(spark: SparkSession, base: str) -> None:
    """Phone sessions and the pauses between them."""
    none = F.lit(None).cast("string")
    found = _some(spark, base, ("screen_off", "screen_unlock", "dreaming_started", "call_missed", "call_outgoing", "call_received", "sms_received", "sms_sent"))
    parts = [_piece(_usage(spark, base), F.col("packageName"), duration="duration")]
    shape = {
        "screen_off": ("L", "time", None), "dreaming_started": ("L", "time", None), "screen_unlock": ("U", "time", None), "call_missed": ("F", "timestamp", None),
        "call_outgoing": ("F", "startTimestamp", "durationInMillis"), "call_received": ("F", "startTimestamp", "durationInMillis"), "sms_received": ("F", "time", None), "sms_sent": ("F", "time", None),
    }
    for rank, (name, df) in enumerate(found.items()):
        kind, shown, duration = shape[name]
        parts.append(_piece(df, F.lit(name) if kind == "F" else none, kind, shown, duration, rank))
    _write(sessions.phone_sessions(reduce(DataFrame.unionByName, parts)), base, "phone_sessions")
    _write(sessions.inactivity_sessions(spark.read.parquet(f"{base}/phone_sessions")), base, "phone_inactivity_sessions")


def positive(spark: SparkSession, base: str) -> None:
    """Time without the phone, where pauses of over a day from before SINCE are left out, and minutes of use."""
    _write(activity.positive_time(dealt(spark.read.parquet(f"{base}/phone_inactivity_sessions"), "userId"), filter_start=SINCE), base, "positive_time")
    use = _usage(spark, base).withColumn("id", F.xxhash64("time", "duration", "packageName"))
    _write(activity.positive_minutes(use), base, "pos_minutes")


def clusters(spark: SparkSession, base: str) -> None:
    for n in (2, 3):
        found = activity.activity_clusters(spark.read.parquet(f"{base}/phone_sessions"), spark.read.parquet(f"{base}/phone_inactivity_sessions"), n)
        _write(found, base, f"activity_clusters_{n}")


def distances(spark: SparkSession, base: str) -> None:
    points = _read(spark, base, "localisation")
    _write(places.daily_radius(points), base, "daily_radius")
    _write(places.path_covered(points), base, "path_covered")


def locations(spark: SparkSession, base: str) -> None:
    """Needs the table location_clusters (id, cluster)."""
    spots = places.located(_read(spark, base, "localisation"), spark.read.parquet(f"{base}/location_clusters"))
    use = spark.read.parquet(f"{base}/phone_sessions").select("userId", "time", "duration", "app")
    _write(places.location_fragments(use, spots), base, "location_sessions")


def sleeps(spark: SparkSession, base: str) -> None:
    """The sleep tables; those of the moving median also with it over the signal without idle days (gapped_..).

    The runs of a signal are written first (.._runs) and read back by the tables made of them.
    """
    entries = dealt(tables.read_aggregate(spark, base, "app_total_duration", FIVE_MIN), "userId")
    written: set[str] = set()

    def keep(prefix: str) -> sleep.Keep:
        def read_back(name: str, df: DataFrame) -> DataFrame:
            _write(df, base, prefix + name)
            written.add(prefix + name)
            return dealt(spark.read.parquet(f"{base}/{prefix}{name}"), "userId")

        return read_back

    found = sleep.sleep_tables(entries, spark.read.parquet(f"{base}/phone_inactivity_sessions"), keep=keep(""))
    gapped = sleep.smooth_tables(dealt(spark.read.parquet(f"{base}/clean_no_filter_runs"), "userId"), keep("gapped_"))
    for name, df in {**found, **{f"gapped_{n}": df for n, df in gapped.items()}}.items():
        if name not in written:
            _write(df, base, name)


def installed(spark: SparkSession, base: str) -> None:
    changes = apps.app_changes(*[_read(spark, base, t) for t in ("app_list", "app_install", "app_removal")])
    days = tables.read_aggregate(spark, base, "app_total_duration", DAILY).filter("value > 0").select("userId", "time").distinct()
    _write(apps.encoded(apps.installed_apps(changes, days), apps.dictionary(changes)), base, "installed_apps")


def topic_documents(spark: SparkSession, base: str) -> None:
    """Documents as CSV; users are those of personality.csv (column user)."""
    phone = spark.read.parquet(f"{base}/phone_sessions")
    users = spark.read.csv(f"{base}/personality.csv", header=True).select(F.col("user").try_cast("bigint").alias("user"))
    days, words = documents.user_days(users, phone), apps.dictionary(phone)
    tables.write_csv(days, f"{base}/user_stats.csv")
    tables.write_csv(words, f"{base}/app_to_number.csv")
    for name, t in documents.TEMPLATES.items():
        for n in (2, 3) if t.source == "clusters" else (None,):
            path = {"phone": "phone_sessions", "locations": "location_sessions", "clusters": f"activity_clusters_{n}"}[t.source]
            if not tables.exists(spark, f"{base}/{path}"):
                continue
            rows = documents.in_study(spark.read.parquet(f"{base}/{path}"), days)
            for aggregate in ("COUNT", "SUM"):
                out = documents.documents(rows, words, name, aggregate).withColumn("document", documents.as_text())
                tables.write_csv(out, f"{base}/documents_{name}{n or ''}_{aggregate.lower()}.csv", mode="overwrite")


JOBS: dict[str, Callable[..., None]] = {
    "ingest": ingest,
    "app_sessions": app_sessions,
    "metrics": metrics,
    "categories": by_category,
    "summary": summaries,
    "phone_sessions": phone_sessions,
    "positive": positive,
    "clusters": clusters,
    "distances": distances,
    "locations": locations,
    "sleep": sleeps,
    "installed": installed,
    "documents": topic_documents,
}
#: Side inputs without which a job is left out of a full run.
NEEDS = {"categories": "categories.csv", "locations": "location_clusters", "documents": "personality.csv"}


def run_all(spark: SparkSession, base: str, dump_path: str | None = None) -> list[str]:
    """All jobs in order; the names of those that ran."""
    ran = []
    for name, job in JOBS.items():
        if name == "ingest":
            if dump_path is None:
                continue
            job(spark, base, dump_path)
        elif name in NEEDS and not tables.exists(spark, f"{base}/{NEEDS[name]}"):
            continue
        else:
            job(spark, base)
        ran.append(name)
    return ran


def main(args: list[str]) -> None:
    from tidemark.session import session, ship

    if len(args) < 2 or args[0] not in (*JOBS, "all"):
        sys.exit(f"{__doc__}\nJobs: {', '.join([*JOBS, 'all'])}")
    spark = session()
    ship(spark)
    if args[0] == "all":
        print("\n".join(run_all(spark, *args[1:3])))
    else:
        JOBS[args[0]](spark, *args[1:])


if __name__ == "__main__":
    main(sys.argv[1:])
