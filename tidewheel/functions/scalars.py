"""Column functions. All of them stay inside Spark's own expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The score divides by this many seconds, and is kept to this many digits.
SCORE_SECONDS = 30.0
SCORE_DIGITS = 4

# Names of the user segments by cluster number.
SEGMENT_LABELS = {
    0: "Enthusiast",
    1: "Critic",
    2: "Casual",
    3: "Explorer",
    4: "Hardcore",
}

CORRUPT = "_corrupt_record"

# Every field is text on the wire: numbers sent as text and numbers sent as numbers then
# take the same cast, and one bad field does not spoil the others.
EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("user_id", "item_id", "rating", "timestamp", CORRUPT)]
)


def engagement_score(
    count: Column, average: Column, seconds: Column | float = SCORE_SECONDS, digits: int = SCORE_DIGITS
) -> Column:
    """Interactions times mean rating, per second of window."""
    length = seconds.cast("double") if isinstance(seconds, Column) else F.lit(float(seconds))
    return F.round(count * average / length, digits)


def short_title(title: Column, n: int = 40) -> Column:
    """Titles longer than ``n`` characters are cut there and end in three dots."""
    return F.when(F.length(title) > n, F.concat(F.substring(title, 1, n), F.lit("..."))).otherwise(title)


def label_column(segment: Column, labels: Mapping[int, str] = SEGMENT_LABELS) -> Column:
    """Name of a segment; null where the number has no name."""
    pairs = [F.lit(part) for pair in labels.items() for part in pair]
    return F.create_map(*pairs)[segment]


def parse_event_json(value: Column) -> Column:
    """JSON text to a struct of text fields; what does not parse is null."""
    return F.from_json(value.cast("string"), EVENT_SCHEMA, {"columnNameOfCorruptRecord": CORRUPT})


def parse_event_time(text: Column) -> Column:
    """ISO text to a timestamp, null where it is none."""
    return F.try_to_timestamp(text)


def display_affinity(score: Column) -> Column:
    """Score squeezed into 0..1 for display."""
    return F.least(F.abs(score) / F.lit(10.0), F.lit(1.0))


def trending_message(item_id: Column, score: Column) -> Column:
    # Through decimals, so that a half rounds up in decimal notation on every engine.
    cents = score.cast("decimal(38,4)").cast("decimal(38,2)").cast("string")
    return F.format_string("Trending Item #%s (Score: %s)", item_id.cast("string"), cents)


def spike_message(user_id: Column) -> Column:
    return F.format_string("Sudden activity spike from User #%s", user_id.cast("string"))


def dot_product(a: Column, b: Column) -> Column:
    """Inner product of two float arrays, summed in double."""
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def features_to_vector(df: DataFrame, features: str = "features", out: str = "features_vec") -> DataFrame:
    """Float arrays as ML vectors, converted on the JVM."""
    return df.withColumn(out, array_to_vector(F.col(features)))
