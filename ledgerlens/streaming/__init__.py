"""Structured Streaming entry points (micro-batch categorisation)."""

from ledgerlens.streaming.categorize import categorized_batches, payment_stream

__all__ = ["categorized_batches", "payment_stream"]
