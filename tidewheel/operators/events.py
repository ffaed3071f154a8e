"""Checking rating events and setting bad ones aside."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import parse_event_json, parse_event_time
from tidewheel.functions.scalars import CORRUPT
from tidewheel.operators.cleaning import HIGHEST, LOWEST

FIELDS = ["user_id", "item_id", "rating", "timestamp"]
CLEAN_COLUMNS = ["user_id", "item_id", "rating", "event_time", "kafka_ts"]


def parse_events(envelope: DataFrame) -> DataFrame:
    """Messages ``(value, timestamp)`` to the raw text, its fields and the arrival time.

    The fields come out of a generator, which filters are not moved through: a plain
    projection would be copied into every later condition and parse each message anew.
    """
    texts = envelope.select(F.col("value").cast("string").alias("raw"), F.col("timestamp").alias("kafka_ts"))
    return texts.select("raw", "kafka_ts", F.inline(F.array(parse_event_json(F.col("raw")))))


def validate_events(parsed: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """Typed fields and the first rule a message breaks, null for a good one."""
    fields = {name: F.col(name) for name in FIELDS}
    typed = parsed.select(
        "raw",
        "kafka_ts",
        *[column.alias(f"_{name}") for name, column in fields.items()],
        CORRUPT,
        fields["user_id"].try_cast("bigint").alias("user_id"),
        fields["item_id"].try_cast("bigint").alias("item_id"),
        fields["rating"].try_cast("double").alias("rating"),
        parse_event_time(fields["timestamp"]).alias("event_time"),
    )
    nothing, something_missing = F.lit(True), F.lit(False)
    for name in FIELDS:
        nothing = nothing & F.col(f"_{name}").isNull()
        something_missing = something_missing | F.col(f"_{name}").isNull()
    empty = F.col("raw").isNull() | (F.trim("raw") == "")
    unreadable = empty | (nothing & F.col(CORRUPT).isNotNull())
    reason = (
        F.when(unreadable, "unparseable_json")
        .when(something_missing, "missing_field")
        .when(F.col("user_id").isNull() | F.col("item_id").isNull(), "bad_id")
        .when(F.col("rating").isNull(), "bad_rating")
        .when(~F.col("rating").between(lowest, highest), "rating_out_of_range")
        .when(F.col("event_time").isNull(), "bad_timestamp")
    )
    return typed.select("raw", *CLEAN_COLUMNS, reason.alias("reject_reason"))


def clean_events(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNull()).select(*CLEAN_COLUMNS)


def dead_letters(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("reject_reason").isNotNull()).select("raw", "kafka_ts", "reject_reason")


def split_dead_letters(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    return clean_events(validated), dead_letters(validated)
