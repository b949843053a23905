"""Structured Streaming drivers for the jobs."""

from tidewater.streaming.retries import RetryTable
from tidewater.streaming.runner import (CommissionStream, ItemIndexStream, OrderSearchStream,
                                        QueueJobStream, queue_stream)

__all__ = ["QueueJobStream", "OrderSearchStream", "CommissionStream", "ItemIndexStream", "queue_stream"]
