"""Time decoding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reference instants of the two raw data sets (UTC epoch seconds).
CARD_EPOCH = 1512000000  # 2017-11-30
TRANSFER_EPOCH = 1483228800  # 2017-01-01


def from_offset_seconds(col: Column, epoch: int = CARD_EPOCH) -> Column:
    """Seconds since a reference instant to a timestamp."""
    return F.timestamp_seconds(col.cast("long") + F.lit(epoch).cast("long"))


def from_step_hours(col: Column, epoch: int = TRANSFER_EPOCH) -> Column:
    """Whole hours since a reference instant to a timestamp."""
    return F.timestamp_seconds(col.cast("long") * F.lit(3600).cast("long") + F.lit(epoch).cast("long"))


def from_epoch_ms(col: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(col.cast("long"))


def epoch_seconds(col: Column) -> Column:
    """Whole epoch seconds of a timestamp (with or without time zone)."""
    return F.unix_seconds(col.cast("timestamp"))
