"""Deterministic keys: the same row gets the same key on every run."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column) -> Column:
    """60-bit integer key of a business key, equal in any engine that has md5."""
    text = F.concat_ws("_", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def stable_id(*parts: Column) -> Column:
    """Row id that replaces a random one, so that a rerun writes the same rows."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
