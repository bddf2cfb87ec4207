from clickstream.sources.files import read_json, read_lines, stream_lines
from clickstream.sources.kafka import (
    consumed_ranges,
    envelope,
    kafka_options,
    kafka_source,
    next_offsets,
    rate_cap,
)
from clickstream.sources.tail import TailLogSource, register_tail

__all__ = [
    "TailLogSource",
    "consumed_ranges",
    "envelope",
    "kafka_options",
    "kafka_source",
    "next_offsets",
    "rate_cap",
    "read_json",
    "read_lines",
    "register_tail",
    "stream_lines",
]
