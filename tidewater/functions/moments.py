"""Times of the driver as UTC, whatever its own time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc(moment: dt.datetime) -> dt.datetime:
    """``moment`` with a zone; one without is taken as UTC."""
    return moment.replace(tzinfo=dt.timezone.utc) if moment.tzinfo is None else moment


def collected(moment: dt.datetime | None) -> dt.datetime | None:
    """A timestamp that Spark handed to the driver, in the driver's zone but without saying so."""
    return moment.astimezone(dt.timezone.utc) if moment else None


def timestamp(moment: dt.datetime) -> Column:
    """The moment as a timestamp literal."""
    return F.lit(utc(moment))
