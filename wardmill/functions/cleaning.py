"""Text cleaning and safe typing.

Payload columns arrive as text. Spark 4 sessions run ANSI, where a bad cast
raises, so every conversion here is a ``try_`` form that yields NULL, and the
texts that stand for a missing value become NULL before any cast.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill.constants import AREA_SUFFIXES, MISSING_TEXT


def null_text(c: Column) -> Column:
    """NULL for texts that stand for a missing value."""
    return F.when(~F.trim(c).isin(*MISSING_TEXT), c)


def col_or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column cast to ``dtype``, or a typed NULL where the frame lacks it."""
    if name in df.columns:
        return F.col(name).cast(dtype)
    return F.lit(None).cast(dtype)


def digits_only(c: Column) -> Column:
    """Drop everything but digits, dot and minus, then read a double."""
    return F.regexp_replace(c.cast("string"), r"[^0-9.\-]", "").try_cast("double")


def clean_numeric(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("double")
    return digits_only(F.col(name))


def to_double(c: Column) -> Column:
    """Text to double; bad text and NaN are NULL."""
    value = null_text(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(value), value)


def to_integer(c: Column) -> Column:
    """Text holding a whole number (``3`` or ``3.0``) to bigint, anything else NULL."""
    value = to_double(c)
    return F.when(value == F.rint(value), value.try_cast("bigint"))


def round_to_integer(c: Column) -> Column:
    """Round half away from zero before the integer cast (a bare cast truncates)."""
    return F.round(c.cast("double")).cast("bigint")


def norm_text(c: Column, upper: bool = True) -> Column:
    return F.trim(F.upper(c)) if upper else F.trim(c)


def with_norm_text(df: DataFrame, names: Sequence[str], upper: bool = True) -> DataFrame:
    present = [n for n in names if n in df.columns]
    return df.withColumns({n: norm_text(F.col(n), upper) for n in present}) if present else df


def strip_suffix(c: Column, words: Sequence[str] = AREA_SUFFIXES) -> Column:
    """Remove one trailing administrative word, whatever its case."""
    alternatives = "|".join(re.escape(w).replace("\\ ", " ") for w in words)
    return F.regexp_replace(c, rf"(?i)\s+({alternatives})$", "")


def split_last(c: Column, separator: str = ", ") -> tuple[Column, Column]:
    """Split at the last separator; without one the whole text is the head and the tail is NULL."""
    found = F.contains(c, F.lit(separator))
    tail = F.when(found, F.substring_index(c, separator, -1))
    # Length arithmetic rather than a regex: linear and blind to the separator's characters.
    cut = F.length(c) - F.length(F.substring_index(c, separator, -1)) - F.lit(len(separator))
    head = F.when(found, F.substring(c, F.lit(1), cut)).otherwise(c)
    return head, tail


def compose_code(*candidates: Sequence[Column]) -> Column:
    """First candidate whose parts are all present, its parts joined."""
    return F.coalesce(*[F.concat(*parts) for parts in candidates])


def pad_code(c: Column, width: int, truncate: bool = False) -> Column:
    """Zero-pad on the left; longer codes are kept unless ``truncate``."""
    text = c.cast("string")
    padded = F.lpad(text, width, "0")
    return padded if truncate else F.when(F.length(text) < width, padded).otherwise(text)


def map_code(c: Column, mapping: Mapping[str, str]) -> Column:
    """Look a code up in a small fixed table; an unknown code is NULL.

    The table is a constant of this package, so it becomes a map literal and no
    join is planned at all.
    """
    literal = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(literal, c)


def season_start(c: Column) -> Column:
    """First year of a season label such as ``2020-21``."""
    return to_integer(F.split_part(c, F.lit("-"), F.lit(1)))


def parse_date(c: Column, fmt: str) -> Column:
    return F.try_to_date(c, fmt)


def title_case(c: Column) -> Column:
    return F.initcap(F.trim(c))


def null_sentinel(c: Column, value: float) -> Column:
    return F.nullif(c, F.lit(value).cast("double"))
