"""Where interactions come from."""

from coursepulse.sources.landing import (
    read_landed,
    read_landed_lines,
    stream_landed,
    unusable_landed,
)
from coursepulse.sources.messages import kafka_options, read_messages, stream_messages
from coursepulse.sources.session import build_session

__all__ = [
    "build_session",
    "kafka_options",
    "read_landed",
    "read_landed_lines",
    "read_messages",
    "stream_landed",
    "stream_messages",
    "unusable_landed",
]
