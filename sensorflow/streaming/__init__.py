"""Structured Streaming: the batch plan per micro-batch via ``foreachBatch``."""

from sensorflow.streaming.microbatch import (
    batch_writer,
    landing_stream,
    message_stream_to_landing,
    run_available_now,
    start,
)

__all__ = ["batch_writer", "landing_stream", "message_stream_to_landing", "run_available_now", "start"]
