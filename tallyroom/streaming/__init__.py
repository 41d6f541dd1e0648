"""Structured Streaming: decode, clean, deduplicate, sink, incremental star load."""

from tallyroom.streaming.clean import (
    clean_live_stream,
    clean_stream,
    clean_video_stream,
    dedup_stream,
    observe_nulls,
)
from tallyroom.streaming.decode import decode_json
from tallyroom.streaming.events import EventStream, first_by_window
from tallyroom.streaming.jobs import load_closed, load_micro_batch, load_streamed, run_entity_stream
from tallyroom.streaming.sink import run_until_stopped, start_sink

__all__ = [
    "EventStream", "first_by_window", "load_closed",
    "clean_live_stream", "clean_stream", "clean_video_stream", "decode_json",
    "dedup_stream", "load_micro_batch", "load_streamed", "observe_nulls",
    "run_entity_stream", "run_until_stopped", "start_sink",
]
