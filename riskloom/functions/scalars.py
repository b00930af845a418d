"""Keys, dates, casts and display text as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskloom.schemas import MONEY, SCORE

# Microseconds kept, so that an event time read back from JSON is the same instant.
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def surrogate_key(*parts: Column | str) -> Column:
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(F.concat(*[c.cast("string") for c in columns]))


def date_key(when: Column | str) -> Column:
    """Integer ``YYYYMMDD``."""
    return F.date_format(when, "yyyyMMdd").cast("int")


def weekday(day: Column | str) -> Column:
    """0 is Sunday, 6 is Saturday."""
    return F.dayofweek(day) - 1


def money(value: Column | str) -> Column:
    """NUMERIC(12,2); NULL where the value does not fit, for a check to count."""
    return _col(value).try_cast(MONEY)


def score(value: Column | str) -> Column:
    return _col(value).try_cast(SCORE)


def micros(when: Column | str) -> Column:
    return F.unix_micros(_col(when).cast("timestamp"))


def json_row(columns: Sequence[str]) -> Column:
    """One JSON object of the given columns; NULL fields are left out."""
    return F.to_json(F.struct(*columns), JSON_TIME)


def short_id(value: Column | str) -> Column:
    return F.substring(_col(value), 1, 12)


def readable_reason(value: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_col(value), ";", " • "), "_", " ")


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
