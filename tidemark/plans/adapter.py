"""The model's tables from the supplied `events` table, once for Spark and once as DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, userId, time, duration, kind (the event type), k (a small number, as text)."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("userId"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("time"),
        F.floor(F.col("value") * 60000).cast("long").alias("duration"),
        F.col("event_type").alias("kind"),
        F.get_json_object("props", "$.k").alias("k"),
    )


#: The same rows in SQL.
EV = "ev as (select event_id as id, user_id as userId, epoch_us(ts) // 1000 as time, cast(floor(value * 60000) as bigint) as duration, event_type as kind, json_extract_string(props, '$.k') as k from events)"


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and clicks as app sessions of the app `k`: id, userId, time, duration, app."""
    return base(spark, sf_dir).filter(F.col("kind").isin("view", "click")).select("id", "userId", "time", "duration", F.concat(F.lit("app"), F.col("k")).alias("app"))


SESSIONS = "sessions as (select id, userId, time, duration, 'app' || k as app from ev where kind in ('view', 'click'))"


def events_kv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as intervals with their type as key."""
    return base(spark, sf_dir).select("userId", "time", "duration", F.col("kind").alias("key"), F.col("duration").alias("value"), F.lit(True).alias("splits"))


KV = "kv as (select userId, time, duration, kind as key from ev)"


def parts(kind: str) -> int:
    """How many tables the events of a type are dealt to."""
    return 2 if kind == "error" else 3


def event_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """One table for each event type of the metric specs: every event is in one, by its type and the remainder of its id."""
    rows = base(spark, sf_dir)
    half = lambda kind, r: rows.filter((F.col("kind") == kind) & (F.col("id") % parts(kind) == r))
    call = [F.col("k").alias("contactHash"), F.col("time").alias("startTimestamp"), F.col("duration").alias("durationInMillis")]
    text = [F.col("k").alias("contactHash"), F.col("k").cast("int").alias("msgLength")]
    bare = ["id", "userId", "time"]
    return {
        "app_session": half("view", 0).select("userId", "time", "duration", F.col("k").alias("packageName")),
        "notification_state_change": half("view", 1).select(*bare, F.col("k").alias("packageName")),
        "screen_unlock": half("view", 2).select(*bare),
        "call_missed": half("click", 0).select(*bare, F.col("k").alias("contactHash")),
        "call_received": half("click", 1).select(*bare, *call),
        "call_outgoing": half("click", 2).select(*bare, *call),
        "sms_received": half("purchase", 0).select(*bare, *text),
        "sms_sent": half("purchase", 1).select(*bare, *text),
        "whatsapp_received": half("purchase", 2).select(*bare, F.col("k").alias("contactHash"), F.col("k").cast("int").alias("messageLength")),
        "screen_off": half("signup", 0).select(*bare),
        "screen_on": half("signup", 1).select(*bare),
        "whatsapp_sent": half("signup", 2).select(*bare, F.col("k").alias("contactHash"), F.col("k").cast("int").alias("messageLength")),
        "phone_shutdown": half("error", 0).select(*bare),
        "phone_boot": half("error", 1).select(*bare),
    }


#: (type, remainder): key, value, whether it is an interval, and the names of count, sum and distinct; as event_tables and the specs have it.
PARTS: tuple[tuple[str, int, str, str, bool, str, str | None, str | None], ...] = (
    ("view", 0, "k", "duration", True, "app_total_count", "app_total_duration", "app_total_count_unique"),
    ("view", 1, "k", "0", False, "notification_count", None, None),
    ("view", 2, "'screen_unlock'", "0", False, "screen_unlocks_count", None, None),
    ("click", 0, "k", "0", False, "call_miss_count", None, None),
    ("click", 1, "k", "duration", True, "call_in_count", "call_in_duration", "call_in_participants"),
    ("click", 2, "k", "duration", True, "call_out_count", "call_out_duration", "call_out_participants"),
    ("purchase", 0, "k", "cast(k as int)", False, "sms_in_count", "sms_incoming_length", "sms_in_participants"),
    ("purchase", 1, "k", "cast(k as int)", False, "sms_out_count", "sms_outgoing_length", "sms_out_participants"),
    ("purchase", 2, "k", "cast(k as int)", False, "whats_app_in_count", "whats_app_incoming_length", "whats_app_in_participants"),
    ("signup", 0, "'screen_off'", "0", False, "screen_off_count", None, None),
    ("signup", 1, "'screen_on'", "0", False, "screen_on_count", None, None),
    ("signup", 2, "k", "cast(k as int)", False, "whats_app_out_count", "whats_app_outgoing_length", "whats_app_out_participants"),
    ("error", 0, "'unknown'", "0", False, "phone_shutdowns_count", None, None),
    ("error", 1, "'unknown'", "0", False, "phone_boots_count", None, None),
)


def window_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors lock, sign-ups unlock, the rest are windows of an app named by their type."""
    kind = F.when(F.col("kind") == "error", "L").when(F.col("kind") == "signup", "U").otherwise("S")
    rank = F.when(F.col("kind") == "error", 0).when(F.col("kind") == "signup", 1).otherwise(2)
    return base(spark, sf_dir).select("userId", "time", rank.alias("rank"), "id", kind.alias("kind"), F.when(kind == "S", F.col("kind")).alias("app"))


WINDOW_EVENTS = (
    "we as (select userId, time, case kind when 'error' then 0 when 'signup' then 1 else 2 end as rank, id, "
    "case kind when 'error' then 'L' when 'signup' then 'U' else 'S' end as kind, case when kind in ('error', 'signup') then null else kind end as app from ev)"
)


def phone_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As window_events, but purchases, views and clicks are pieces of a tenth of their duration; clicks show a minute late."""
    kind = F.when(F.col("kind") == "error", "L").when(F.col("kind") == "signup", "U").otherwise("F")
    rank = F.when(F.col("kind") == "error", 0).when(F.col("kind") == "signup", 1).otherwise(2)
    piece = kind == "F"
    duration = F.when(piece, F.expr("duration div 10")).otherwise(F.lit(0).cast("long"))
    shown = F.when(F.col("kind") == "click", F.col("time") + 60000).otherwise(F.col("time"))
    return base(spark, sf_dir).select("userId", "time", rank.alias("rank"), "id", kind.alias("kind"), shown.alias("shown"), duration.alias("duration"), F.concat(F.lit("app"), F.col("k")).alias("app"))


PHONE_EVENTS = (
    "pe as (select userId, time, case kind when 'error' then 0 when 'signup' then 1 else 2 end as rank, id, "
    "case kind when 'error' then 'L' when 'signup' then 'U' else 'F' end as kind, case when kind = 'click' then time + 60000 else time end as shown, "
    "case when kind in ('error', 'signup') then 0 else duration // 10 end as duration, 'app' || k as app from ev)"
)


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions derived from the id; every seventh is inaccurate, every eleventh below zero."""
    accuracy = F.when(F.col("id") % 7 == 0, 0.0).when(F.col("id") % 11 == 0, -1.0).otherwise(5.0)
    return base(spark, sf_dir).select("id", "userId", "time", accuracy.alias("accuracy"), (F.lit(7.0) + F.col("id") % 37 / F.lit(100.0)).alias("longitude"), (F.lit(50.0) + F.col("id") % 100 / F.lit(100.0)).alias("latitude"))


POINTS = (
    "points as (select id, userId, time, case when id % 7 = 0 then 0.0 when id % 11 = 0 then -1.0 else 5.0 end as accuracy, "
    "7.0::double + (id % 37) / 100.0::double as longitude, 50.0::double + (id % 100) / 100.0::double as latitude from ev)"
)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the event types in two categories."""
    return spark.createDataFrame([("view", "browse"), ("click", "browse"), ("purchase", "buy")], "key string, category string")


CATEGORIES = "categories as (select * from (values ('view', 'browse'), ('click', 'browse'), ('purchase', 'buy')) as t(key, category))"
