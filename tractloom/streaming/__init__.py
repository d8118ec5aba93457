"""Streams of contexts against a static tract table; the same columns as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tractloom.operators.membership import membership


def stream_membership(contexts: DataFrame, points: DataFrame) -> DataFrame:
    """Membership rows of a stream of contexts: a stream-static join on market_id, without state."""
    return membership(contexts, points)
