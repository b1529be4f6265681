"""Message streams, bounded offset ranges and file streams."""

from eventlake.sources.messages import (
    event_range,
    event_stream,
    file_stream,
    in_ranges,
    kafka_options,
    offsets_json,
)

__all__ = [
    "event_range",
    "event_stream",
    "file_stream",
    "in_ranges",
    "kafka_options",
    "offsets_json",
]
