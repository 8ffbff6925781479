"""Scalar column functions used across the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FINGERPRINT_HEX_DIGITS = 16
MESSAGE_CHARACTERS = 500


def error_fingerprint(error_type: Column, message: Column) -> Column:
    """Short stable id of one kind of error."""
    return F.left(F.sha2(F.concat_ws(":", error_type, message), 256), F.lit(FINGERPRINT_HEX_DIGITS))


def short_message(message: Column) -> Column:
    return F.substring(message, 1, MESSAGE_CHARACTERS)


def from_epoch_millis(value: Column) -> Column:
    """Timestamp stored as a plain count of milliseconds."""
    return F.timestamp_millis(value)


def from_epoch_days(value: Column) -> Column:
    """Date stored as a plain count of days."""
    return F.date_from_unix_date(value)


def minutes_before(moment: Column, minutes: int | float) -> Column:
    return moment - F.make_dt_interval(mins=F.lit(minutes))


def row_salt(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """A hash of the row's own values.

    It spreads the rows of one hot key, and, unlike a random number, gives the
    same placement again when a lost task is run anew.
    """
    return F.xxhash64(*(columns or df.columns))
