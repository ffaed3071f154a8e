from tidewheel.functions.scalars import (
    display_affinity,
    dot_product,
    engagement_score,
    features_to_vector,
    label_column,
    parse_event_json,
    parse_event_time,
    short_title,
    spike_message,
    trending_message,
)

__all__ = [
    "display_affinity",
    "dot_product",
    "engagement_score",
    "features_to_vector",
    "label_column",
    "parse_event_json",
    "parse_event_time",
    "short_title",
    "spike_message",
    "trending_message",
]
