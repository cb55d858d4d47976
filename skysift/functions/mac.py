"""MAC address normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_mac(c: Column) -> Column:
    """Lower case with colons; case, blanks and the separators ``:``, ``-``, ``.`` are ignored.

    Text that does not hold exactly twelve hexadecimal digits is kept, trimmed and lower-cased.
    Null and blank give null.
    """
    text = F.lower(F.trim(c))
    digits = F.regexp_replace(text, r"[\s:.\-]", "")
    colons = F.regexp_replace(digits, r"^(..)(..)(..)(..)(..)(..)$", "$1:$2:$3:$4:$5:$6")
    common = text.rlike(r"^[0-9a-f]{2}(:[0-9a-f]{2}){5}\z")
    return F.when(common, text).when(digits.rlike(r"^[0-9a-f]{12}\z"), colons).otherwise(F.nullif(text, F.lit("")))


def epoch_us(c: Column) -> Column:
    """Microseconds since 1970-01-01 UTC of a timestamp (zoneless ones are read as UTC)."""
    return F.unix_micros(c.cast("timestamp"))
