"""Fingerprint of a raw message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENVELOPE_VERSION = "v2"  # fixed value


def _raw(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fingerprint(raw: Column | str) -> Column:
    """MD5 of the raw message bytes, as lower-case hex."""
    return F.md5(_raw(raw))


def envelope(raw: Column | str) -> Column:
    """A JSON object with the fingerprint, the message and a version.

    The message is inserted as it stands, not parsed and written again, so that the fingerprint can
    be checked against it.
    """
    text = _raw(raw).cast("string")
    return F.concat(
        F.lit('{"hash": "'), F.md5(_raw(raw)), F.lit('", "data": '), text,
        F.lit(f', "version": "{ENVELOPE_VERSION}"}}'),
    )
