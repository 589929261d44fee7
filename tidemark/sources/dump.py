"""Raw dumps: tab-separated lines of id, user, time, event type and a JSON payload, to typed events.

Lines that do not parse are dropped, by the rules of their type, or kept apart with the reason. Everything is a column expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import EVENTS, UNPARSED, event_schema

_SLASH = chr(92)
#: Payloads whose elements need not all be strings.
_MIXED = (64, 1019, 1020)
#: Types that don't look at their payload.
_BARE = tuple(n for n, (_, extra) in EVENTS.items() if not extra)


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a dump as id, userId, time, type, payload; junk lines are gone."""
    return split_lines(spark.read.text(path))


def _fields() -> dict[str, Column]:
    part = F.split(F.col("value"), "\t", 5)
    stamp = F.replace(F.get(part, F.lit(2)), F.lit("T"), F.lit(" "))
    return {
        "id": F.get(part, F.lit(0)).try_cast("bigint"),
        "userId": F.get(part, F.lit(1)).try_cast("bigint"),
        "time": F.unix_millis(F.try_to_timestamp(stamp)),
        "type": F.get(part, F.lit(3)).try_cast("int"),
        "payload": F.get(part, F.lit(4)),
    }


def split_lines(lines: DataFrame) -> DataFrame:
    """The five fields of each line (`value`); tabs in the payload stay."""
    out = lines.select(*[c.alias(n) for n, c in _fields().items()])
    return out.filter("id is not null and userId is not null and time is not null and type is not null and payload is not null")


#: Why a line is in no event table; the first that holds.
REASONS = ("fields", "id", "userId", "time", "type", "unread type", "unknown type", "payload")


def checked_lines(lines: DataFrame) -> DataFrame:
    """Each line (`value`) with its fields and the reason why it is in no event table, null where it is in one.

    fields: there are fewer than five; id, userId, time, type: does not parse; unread and unknown types have no table; payload:
    not what the type asks for.
    """
    rows = lines.select("value", *[c.alias(n) for n, c in _fields().items()])
    text = _json(F.col("payload"))
    rows = rows.withColumns({"text": text, "p": _elements(text), "apps": _app_maps()})
    fits = F.lit(None).cast("boolean")
    for number in EVENTS:
        fits = F.when(F.col("type") == number, F.coalesce(_fits(number), F.lit(False))).otherwise(fits)
    reason = F.when(F.col("payload").isNull(), "fields")
    for name in ("id", "userId", "time", "type"):
        reason = reason.when(F.col(name).isNull(), name)
    reason = reason.when(F.col("type").isin(list(UNPARSED)), "unread type").when(~F.col("type").isin(list(EVENTS)), "unknown type").when(~fits, "payload")
    return rows.withColumn("reason", reason).drop("text", "p", "apps")


def rejected_lines(lines: DataFrame) -> DataFrame:
    """value, reason of the lines that are in no event table."""
    return checked_lines(lines).filter("reason is not null").select("value", "reason")


def observed(checked: DataFrame, observation: Observation) -> DataFrame:
    """checked_lines that count, as they pass, all lines, the accepted, and the rejected by reason."""
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return checked.observe(observation, F.count("*").alias("lines"), F.count_if(F.col("reason").isNull()).alias("accepted"), *counts)


def _json(payload: Column) -> Column:
    """The JSON text: of a quoted payload all between its quotes, without any backslash."""
    inner = F.replace(F.substring(payload, F.lit(2), F.length(payload) - 2), F.lit(_SLASH), F.lit(""))
    return F.when(F.startswith(payload, F.lit('"')), inner).otherwise(payload)


def _elements(text: Column) -> Column:
    return F.from_json(text, "array<string>", {"allowUnquotedControlChars": "true"})


def _all_strings(text: Column) -> Column:
    """Whether every element of a JSON array is a quoted string (Spark would take numbers as strings too)."""
    return F.rlike(text, F.lit(r'(?s)^\s*\[\s*(?:"(?:[^"\\]|\\.)*+"\s*(?:,\s*"(?:[^"\\]|\\.)*+"\s*)*+)?\]\s*$'))


def _app_maps() -> Column:
    """The objects of an app list; the outer characters go, whatever they are."""
    inner = F.replace(F.substring("payload", F.lit(2), F.length("payload") - 2), F.lit(_SLASH), F.lit(""))
    return F.from_json(inner, "array<map<string,string>>", {"allowUnquotedControlChars": "true"})


def _shape(number: int) -> tuple[Column, list[Column]]:
    """How many elements `p` a type's payload has, and its columns."""
    p = lambda i: F.get("p", F.lit(i))
    n = F.size("p")
    long, integer, real, double = (lambda i, k=k: p(i).try_cast(k) for k in ("bigint", "int", "float", "double"))
    package = F.substring_index(p(1), "/", 1)
    shape: dict[int, tuple[Column, list[Column]]] = {
        32: (n == 3, [p(0), package, p(2)]),
        132: (n == 3, [p(0), package, p(2)]),
        64: (n == 3, [p(0), p(1), long(2)]),
        1000: (n == 2, [p(0), integer(1)]),
        1001: (n == 2, [p(0), integer(1)]),
        1002: (n == 3, [p(0), long(1), long(2)]),
        1003: (n == 3, [p(0), long(1), long(2)]),
        1004: (n >= 2, [p(0), long(1)]),
        1007: (n == 4, [p(0), real(1), double(2), double(3)]),
        1009: (n == 2, [p(0), p(1)]),
        1010: (n == 2, [p(0), p(1)]),
        1011: (n == 2, [real(0)]),
        1019: (n == 3, [p(0), integer(1), integer(2) != 0]),
        1020: (n == 3, [p(0), integer(1), integer(2) != 0]),
        1021: (n == 3, [p(0), p(1), p(2)]),
        1022: (n == 1, [p(0)]),
        1023: (n == 3, [long(0), long(1), long(2)]),
        1025: (n == 7, [integer(0), p(1), integer(2), long(3), long(4), long(5)]),
        1032: (n == 4, [long(1) * 1000, p(3)]),  # seconds in the dump, milliseconds in the tables
        1100: (n >= 1, [integer(0), F.slice("p", F.lit(2), F.greatest(n - 1, F.lit(0)))]),
    }
    return shape[number]


def _fits(number: int) -> Column:
    """Whether a payload (with `text`, `p` and `apps` made of it) is what its type asks for; null where it can't be read."""
    if number in _BARE:
        return F.lit(True)
    if number == 1008:
        return F.col("apps").isNotNull() & ~F.exists("apps", lambda a: a.isNull())
    arity, columns = _shape(number)
    fits = F.col("p").isNotNull() & arity
    for c in columns:
        fits = fits & c.isNotNull()
    return fits if number in _MIXED else fits & _all_strings(F.col("text"))


def decode(fields: DataFrame, number: int) -> DataFrame:
    """Typed rows of one event type from split_lines' fields."""
    own = fields.filter(F.col("type") == number)
    if number in _BARE:
        return own.select("id", "userId", "time")
    if number == 1008:
        package = lambda a: F.get(F.filter(F.map_values(F.map_filter(a, lambda k, _: k == "pkg")), lambda v: v.isNotNull()), F.lit(0))
        own = own.withColumn("apps", _app_maps()).filter(_fits(number))
        return own.select("id", "userId", "time", F.transform("apps", lambda a: F.coalesce(package(a), F.lit(""))).alias("installedApps"))
    own = own.withColumn("text", _json(F.col("payload"))).withColumn("p", _elements(F.col("text"))).filter(_fits(number))
    names = [c.split()[0] for c in event_schema(number).split(", ")]
    keys = ["userId", "time"] if number == 1032 else ["id", "userId", "time"]
    return own.select(*keys, *[c.alias(x) for c, x in zip(_shape(number)[1], names[len(keys) :], strict=True)])


def decode_all(fields: DataFrame) -> dict[str, DataFrame]:
    """Every event table of the split lines, by name; numbers of one table are united."""
    tables: dict[str, DataFrame] = {}
    for number, (name, _) in EVENTS.items():
        own = decode(fields, number)
        tables[name] = tables[name].unionByName(own) if name in tables else own
    return tables
