"""Decode and validate raw event messages. The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.schemas import EVENT, EVENT_TYPES

REQUIRED = ("event_id", "event_type", "event_timestamp")


def _fields(kind: type) -> list[str]:
    return [f.name for f in EVENT.fields if isinstance(f.dataType, kind)]


# JSON numbers without a fraction are integers however they are written (2, 2.0, 2e0), so integers are
# read as doubles and narrowed after the check.
_CORRUPT = "_corrupt"
_WIRE = T.StructType(
    [T.StructField(f.name, T.DoubleType() if isinstance(f.dataType, T.IntegerType) else f.dataType) for f in EVENT.fields]
).add(_CORRUPT, "string")
# A text field whose value does not start like a string or null. Inside a JSON string the quotes are
# escaped, so this cannot match there; a nested object can match, which the exact check then clears.
_ODD_TEXT = r'"(' + "|".join(_fields(T.StringType)) + r')"\s*:\s*[^"n\s]'


def _wrong_kind(entry: Column) -> Column:
    """Whether a (field, JSON type) pair of the message breaks the contract."""
    name, kind = entry["key"], entry["value"]
    text = name.isin(*_fields(T.StringType)) & (kind != "STRING")
    number = name.isin(*_fields(T.IntegerType), *_fields(T.DoubleType)) & ~kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)")
    return (kind != "VOID") & (text | number)


def _json_kinds(text: Column) -> Column:
    """Map of top-level field to JSON type; null when the text is not a JSON object."""
    parts = F.from_json(text, T.MapType(T.StringType(), T.VariantType()))
    return F.transform_values(parts, lambda _, v: F.coalesce(F.schema_of_variant(v), F.lit("VOID")))


def parse_events(raw: DataFrame, value: str = "value") -> DataFrame:
    """Decode JSON messages: envelope columns, the message itself, and ``reject_reason``.

    A message is rejected when it is not a JSON object, misses a required field, holds a value of the
    wrong JSON type, or names an unknown event type. Nothing is dropped here. Only messages that look odd
    pay for the exact type check.
    """
    text = F.col(value).cast("string")
    decoded = raw.select(text.alias("raw_value"), F.from_json(text, _WIRE, {"columnNameOfCorruptRecord": _CORRUPT}).alias("e"))
    raw_text, corrupt = F.col("raw_value"), F.col("e").isNull() | F.col(f"e.{_CORRUPT}").isNotNull()
    odd = raw_text.isNull() | corrupt | raw_text.rlike(_ODD_TEXT)
    checked = decoded.select("raw_value", "e", corrupt.alias("corrupt"), F.when(odd, _type_error(raw_text)).alias("type_error"))
    fraction = lambda c: F.col(f"e.{c}") != F.floor(f"e.{c}")
    reason = F.coalesce(
        F.when(F.col("type_error") == "malformed", "malformed"),
        *[F.when(F.col(f"e.{c}").isNull(), F.lit(f"missing:{c}")) for c in REQUIRED],
        F.nullif("type_error", F.lit("")),
        F.when(F.col("corrupt"), "malformed"),
        *[F.when(fraction(c), F.lit(f"type:{c}")) for c in _fields(T.IntegerType)],
        F.when(~F.col("e.event_type").isin(*EVENT_TYPES), F.lit("unknown:event_type")),
    )
    columns = [F.col(f"e.{f.name}").try_cast(f.dataType).alias(f.name) for f in EVENT.fields]
    row = F.struct(*columns, "raw_value", reason.alias("reject_reason"))
    # inline keeps a later filter on the reason from being pushed below the parser, which would parse
    # every message once per mention of a field in the filter
    return checked.select(F.inline(F.array(row)))


def _type_error(text: Column) -> Column:
    """``malformed``, ``type:<field>`` for the first field of a wrong type, or an empty string."""
    wrong = lambda kinds: F.transform(F.filter(F.map_entries(kinds), _wrong_kind), lambda entry: entry["key"])
    named = lambda fields: F.when(F.size(fields) > 0, F.concat(F.lit("type:"), F.array_min(fields))).otherwise("")
    verdict = F.transform(F.array(_json_kinds(text)), lambda kinds: F.when(kinds.isNull(), "malformed").otherwise(named(wrong(kinds))))
    return F.element_at(verdict, 1)


def event_day(timestamp: Column, today: Column | None = None) -> Column:
    """Calendar day written in the timestamp text itself, without zone conversion.

    A missing or malformed timestamp falls back to the current UTC day.
    """
    today = F.current_date() if today is None else today
    day = F.try_to_timestamp(F.substring(timestamp, 1, 10), F.lit("yyyy-MM-dd")).cast("date")
    well_formed = F.try_to_timestamp(timestamp).isNotNull()
    return F.coalesce(F.when(well_formed, day), today)


def with_bronze_partition(events: DataFrame, today: Column | None = None) -> DataFrame:
    """Add the Bronze partition columns: ``event_type`` (``unknown`` if missing) and ``date``."""
    return events.withColumns(
        {
            "event_type": F.coalesce("event_type", F.lit("unknown")),
            "date": event_day(F.col("event_timestamp"), today),
        }
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("raw_value", "reject_reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Rejected messages with their reason; the message text is kept so that it can be replayed."""
    return parsed.where(F.col("reject_reason").isNotNull()).select("raw_value", "reject_reason")


def ingest_metrics(parsed: DataFrame) -> DataFrame:
    """(event_type, processed, failed); a rejected message counts under ``unknown``."""
    ok = F.col("reject_reason").isNull()
    kind = F.when(ok, F.col("event_type")).otherwise(F.lit("unknown"))
    return parsed.groupBy(kind.alias("event_type")).agg(F.count_if(ok).alias("processed"), F.count_if(~ok).alias("failed"))


def pin_event_date(events: DataFrame, run_date: str) -> DataFrame:
    """Move every event to the run's logical day and keep its time of day."""
    at = F.col("event_timestamp")
    pinned = F.make_timestamp_ntz(
        F.year(F.lit(run_date).cast("date")), F.month(F.lit(run_date).cast("date")), F.dayofmonth(F.lit(run_date).cast("date")),
        F.hour(at), F.minute(at), F.extract(F.lit("SECOND"), at),
    )
    return events.withColumn("event_timestamp", F.try_to_timestamp(F.date_format(pinned, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))
