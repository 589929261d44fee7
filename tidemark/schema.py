"""The data model: event types, metric names, granularities, table schemas."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Granularity:
    """A time bucket: its stored code, and its length where buckets count from the epoch."""

    name: str
    code: int
    millis: int


MINUTE = 60_000
DAY = 86_400_000

# The codes stored in the granularity column and the epoch bucket lengths.
FIVE_MIN = Granularity("FiveMin", 6, 5 * MINUTE)
FIFTEEN_MIN = Granularity("FifteenMin", 7, 15 * MINUTE)
HOURLY = Granularity("Hourly", 1, 60 * MINUTE)
DAILY = Granularity("Daily", 2, DAY)
WEEKLY = Granularity("Weekly", 3, 7 * DAY)
MONTHLY = Granularity("Monthly", 4, 30 * DAY)
YEARLY = Granularity("Yearly", 5, 365 * DAY)

GRANULARITIES = (FIVE_MIN, FIFTEEN_MIN, HOURLY, DAILY, WEEKLY, MONTHLY, YEARLY)
#: From which finer level a calendar bucket can be summed.
SUB = {WEEKLY: DAILY, MONTHLY: DAILY, YEARLY: MONTHLY}
#: Roll-up trees: a level and those made from it.
FOREST: tuple[tuple, ...] = ((FIVE_MIN, ()), (FIFTEEN_MIN, ()), (HOURLY, ()), (DAILY, ((MONTHLY, ((YEARLY, ()),)), (WEEKLY, ()))))

# Number, table and extra columns of each event type. All tables have userId and time
# (epoch ms), all but app_session have id. Columns come in the order of the payload.
EVENTS: dict[int, tuple[str, str]] = {
    32: ("window_state_changed", "appName string, packageName string, windowTitle string"),
    64: ("notification_state_change", "appName string, packageName string, length bigint"),
    132: ("window_state_changed", "appName string, packageName string, windowTitle string"),
    1000: ("sms_received", "contactHash string, msgLength int"),
    1001: ("sms_sent", "contactHash string, msgLength int"),
    1002: ("call_received", "contactHash string, startTimestamp bigint, durationInMillis bigint"),
    1003: ("call_outgoing", "contactHash string, startTimestamp bigint, durationInMillis bigint"),
    1004: ("call_missed", "contactHash string, timestamp bigint"),
    1005: ("screen_on", ""),
    1006: ("screen_off", ""),
    1007: ("localisation", "signalType string, accuracy float, longitude double, latitude double"),
    1008: ("app_list", "installedApps array<string>"),
    1009: ("app_install", "appName string, packageName string"),
    1010: ("app_removal", "appName string, packageName string"),
    1011: ("mood", "mood float"),
    1012: ("phone_boot", ""),
    1013: ("phone_shutdown", ""),
    1014: ("screen_unlock", ""),
    1015: ("app_upgrade", ""),
    1017: ("dreaming_started", ""),
    1018: ("dreaming_stopped", ""),
    1019: ("whatsapp_sent", "contactHash string, messageLength int, isGroupMessage boolean"),
    1020: ("whatsapp_received", "contactHash string, messageLength int, isGroupMessage boolean"),
    1021: ("device_features", "androidVersion string, deviceName string, operatorName string"),
    1022: ("app_action", "fragment string"),
    1023: ("timezone", "moTime bigint, momoTime bigint, offsetInMillis bigint"),
    1025: ("traffic_data", "connectionType int, name string, networkType int, bytesReceived bigint, bytesTransferred bigint, bytesTransferredOverMobile bigint"),
    1032: ("app_session", "duration bigint, packageName string"),
    1100: ("questionnaire", "version int, answers array<string>"),
}
#: Known numbers whose payload is never read.
UNPARSED = (1, 2, 4, 8, 16, 128, 256, 1016, 2000)
UNKNOWN = 999999

# Metric names.
METRICS = (
    "sms_in_count", "sms_out_count", "sms_total_count", "sms_in_participants", "sms_out_participants", "sms_total_participants",
    "sms_incoming_length", "sms_outgoing_length", "whats_app_in_count", "whats_app_out_count", "whats_app_total_count",
    "whats_app_in_participants", "whats_app_out_participants", "whats_app_total_participants", "whats_app_incoming_length",
    "whats_app_outgoing_length", "call_in_count", "call_miss_count", "call_out_count", "call_total_count", "call_in_participants",
    "call_out_participants", "call_participants_count", "call_in_duration", "call_out_duration", "call_total_duration",
    "app_total_count_unique", "app_total_count", "app_total_duration", "notification_count", "screen_unlocks_count",
    "screen_off_count", "screen_on_count", "phone_shutdowns_count", "phone_boots_count", "summary", "category_total_count_unique",
    "category_total_count", "category_total_duration",
)


@dataclass(frozen=True)
class MetricSpec:
    """Metrics of an event table: what splits over buckets, keys, values, and the names of count, sum and distinct."""

    event: str
    key: str
    value: str | None = None
    start: str | None = None  # the interval's start, where its length (value) is split over buckets
    count: str | None = None
    total: str | None = None
    distinct: str | None = None


SPECS = (
    MetricSpec("app_session", "packageName", "duration", "time", "app_total_count", "app_total_duration", "app_total_count_unique"),
    MetricSpec("call_missed", "contactHash", count="call_miss_count"),
    MetricSpec("call_outgoing", "contactHash", "durationInMillis", "time", "call_out_count", "call_out_duration", "call_out_participants"),
    MetricSpec("call_received", "contactHash", "durationInMillis", "startTimestamp", "call_in_count", "call_in_duration", "call_in_participants"),
    MetricSpec("notification_state_change", "packageName", count="notification_count"),
    MetricSpec("screen_off", "'screen_off'", count="screen_off_count"),
    MetricSpec("screen_on", "'screen_on'", count="screen_on_count"),
    MetricSpec("screen_unlock", "'screen_unlock'", count="screen_unlocks_count"),
    MetricSpec("sms_received", "contactHash", "msgLength", None, "sms_in_count", "sms_incoming_length", "sms_in_participants"),
    MetricSpec("sms_sent", "contactHash", "msgLength", None, "sms_out_count", "sms_outgoing_length", "sms_out_participants"),
    MetricSpec("phone_shutdown", "'unknown'", count="phone_shutdowns_count"),
    MetricSpec("phone_boot", "'unknown'", count="phone_boots_count"),
    MetricSpec("whatsapp_received", "contactHash", "messageLength", None, "whats_app_in_count", "whats_app_incoming_length", "whats_app_in_participants"),
    MetricSpec("whatsapp_sent", "contactHash", "messageLength", None, "whats_app_out_count", "whats_app_outgoing_length", "whats_app_out_participants"),
)

#: Columns of the summary: name, operation and input metrics.
SUMMARY: tuple[tuple[str, str, tuple[str, ...]], ...] = (
    ("sms_in_count", "sum", ("sms_in_count",)),
    ("sms_out_count", "sum", ("sms_out_count",)),
    ("sms_total_count", "sum", ("sms_in_count", "sms_out_count")),
    ("sms_in_participants", "distinct", ("sms_in_count",)),
    ("sms_out_participants", "distinct", ("sms_out_count",)),
    ("sms_total_participants", "distinct", ("sms_in_count", "sms_out_count")),
    ("sms_incoming_length", "sum", ("sms_incoming_length",)),
    ("sms_outgoing_length", "sum", ("sms_outgoing_length",)),
    ("call_in_count", "sum", ("call_in_count",)),
    ("call_miss_count", "sum", ("call_miss_count",)),
    ("call_out_count", "sum", ("call_out_count",)),
    ("call_total_count", "sum", ("call_in_count", "call_out_count")),
    ("call_in_participants", "distinct", ("call_in_count",)),
    ("call_out_participants", "distinct", ("call_out_count",)),
    ("call_participants_count", "distinct", ("call_in_count", "call_out_count")),
    ("call_in_duration", "sum", ("call_in_duration",)),
    ("call_out_duration", "sum", ("call_out_duration",)),
    ("call_total_duration", "sum", ("call_in_duration", "call_out_duration")),
    ("app_total_count_unique", "distinct", ("app_total_count",)),
    ("app_total_count", "sum", ("app_total_count",)),
    ("app_total_duration", "sum", ("app_total_duration",)),
    ("screen_unlocks_count", "sum", ("screen_unlocks_count",)),
    ("screen_off_count", "sum", ("screen_off_count",)),
    ("screen_on_count", "sum", ("screen_on_count",)),
    ("phone_shutdowns_count", "sum", ("phone_shutdowns_count",)),
    ("phone_boots_count", "sum", ("phone_boots_count",)),
)


def event_schema(number: int) -> str:
    """DDL of an event table."""
    table, extra = EVENTS[number]
    own = "userId bigint, time bigint" if table == "app_session" else "id bigint, userId bigint, time bigint"
    return f"{own}, {extra}" if extra else own


def event_number(table: str) -> int:
    """The (lowest) number of an event table; UNKNOWN for others."""
    return min((n for n, (name, _) in EVENTS.items() if name == table), default=UNKNOWN)


def event_table(number: int) -> str:
    return EVENTS[number][0] if number in EVENTS else "unknown"
