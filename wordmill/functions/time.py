"""Time column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(c: ColumnOrName) -> Column:
    """X9 + X10: parse a timestamp string; bad values become null; any zone
    is converted to UTC and then dropped (``timestamp_ntz``).

    Every row is parsed on its own, so mixed formats do not null each other.
    The result is the UTC wall clock whatever the session time zone: the
    instant is read as session-zone wall time and converted to UTC.
    """
    local = F.try_to_timestamp(_col(c)).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def parse_date_param(value: str) -> dt.datetime:
    """X11: validate a ``YYYY-MM-DD`` parameter on the driver (raises)."""
    return dt.datetime.strptime(value, "%Y-%m-%d")


def timestamp_param(value: str | dt.datetime) -> Column:
    """A driver-side wall-clock parameter as a ``timestamp_ntz`` literal.

    Built from its ISO text: a naive ``datetime`` literal would be read in
    the Python process's zone and cast back in the session zone, shifting
    the value whenever the two differ.
    """
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day_of(published_at: ColumnOrName) -> Column:
    """F11 + X13: the day of a publish time, from its first 10 characters.
    Text that is not a date gives null (callers count or drop it)."""
    return F.substring(_col(published_at), 1, 10).try_cast("date")


def day_label(c: ColumnOrName) -> Column:
    """Date -> ``YYYY-MM-DD``."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def iso_utc(ts: ColumnOrName) -> Column:
    """A UTC wall-clock ``timestamp_ntz`` as the API's ISO-8601 text
    (second precision). Cut from the zone-free text form of the value, so
    the session time zone plays no part."""
    text = _col(ts).cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))


def trunc_second(ts: ColumnOrName) -> Column:
    """A ``timestamp_ntz`` truncated to whole seconds, zone-independent."""
    return F.substring(_col(ts).cast("string"), 1, 19).cast("timestamp_ntz")


def instant_param(value: str | dt.datetime) -> Column:
    """A UTC wall-clock parameter as an instant (``timestamp``) literal, for
    comparisons with parsed instants that need no per-row conversion."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    return F.lit(value.replace(tzinfo=dt.timezone.utc))


def elapsed_micros(now: Column, last: ColumnOrName) -> Column:
    """Microseconds from ``last`` to ``now`` (both UTC wall clock,
    ``timestamp_ntz``). Computed on the wall-clock values, so a daylight
    saving change in the session zone never shifts it."""
    return F.timestamp_diff("MICROSECOND", _col(last).cast("timestamp_ntz"), now.cast("timestamp_ntz"))
