"""Deterministic identifiers, canonical hashes and timestamps, all from built-in functions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

CANONICAL_JSON = {
    "ignoreNullFields": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def row_hash(*columns: str | Column) -> Column:
    """SHA-256 of the ordered fields as JSON, nulls kept; the session must be in UTC for hashes to travel."""
    return F.sha2(F.to_json(F.struct(*columns), CANONICAL_JSON), 256)


def text_hash(*columns: str | Column, separator: str = "|") -> Column:
    """SHA-256 of a separated text, nulls as empty: the same in any engine."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws(separator, *parts), 256)


def fingerprint(*columns: str | Column, length: int = 24) -> Column:
    """The first hex digits of :func:`text_hash`."""
    return F.left(text_hash(*columns), F.lit(length))


def uuid5(namespace: uuid.UUID, name: Column) -> Column:
    """RFC 4122 version 5 UUID of a name."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def instant(text: Column) -> Column:
    """A timestamp from ISO-8601 text with an offset; null for naive or unreadable text."""
    zoned = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(zoned, F.try_to_timestamp(text))


def iso_millis(moment: Column) -> Column:
    """UTC text with milliseconds and Z; the session must be in UTC."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def rows_per_second(rows: Column, millis: Column) -> Column:
    """Rows per second, 0 where no time has passed."""
    return F.when(millis > 0, rows * 1000.0 / millis).otherwise(F.lit(0.0))
