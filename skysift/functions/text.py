"""Text normalisation, tokens and redaction."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The token pattern and the redaction patterns.
TOKEN = r"[a-z0-9][a-z0-9:_./-]{0,190}"
CONTROL = r"[\p{Cc}\p{Cf}]"
USERINFO = r"://[^/]*?:([^@/]+)@"
BEARER = r"(?i)((?:authorization\s*[:=]?\s*)?Bearer\s+)([A-Za-z0-9._\-]+)"
SECRET = r"(?i)(password|passwd|token|secret|api[-_]?key)\s*[:=]\s*([^\s,;]+)"


@F.pandas_udf(T.StringType())
def _compose(s: pd.Series) -> pd.Series:
    """Compatibility composition; ASCII text, which it cannot change, is passed on."""
    return s.map(lambda x: x if x is None or x.isascii() else unicodedata.normalize("NFKC", x))


def normalized(text: Column, ascii_only: bool = False) -> Column:
    """Composed, lower case, single blanks, trimmed. There is no built-in for the first step."""
    plain = F.coalesce(text, F.lit(""))
    return F.trim(F.regexp_replace(F.lower(plain if ascii_only else _compose(plain)), r"\s+", " "))


def tokens(normalized_text: Column) -> Column:
    return F.regexp_extract_all(normalized_text, F.lit(TOKEN), F.lit(0))


def sanitized(text: Column) -> Column:
    """Error text without control characters and secrets, at most 512 characters."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), CONTROL, "")
    t = F.regexp_replace(t, USERINFO, "://[REDACTED]@")
    t = F.regexp_replace(t, BEARER, "$1[REDACTED]")
    t = F.regexp_replace(t, SECRET, "$1=[REDACTED]")
    return F.left(F.trim(F.regexp_replace(t, r"\s+", " ")), F.lit(512))


def search_text(*columns: Column) -> Column:
    """Lower-cased values joined by blanks, nulls skipped; null if nothing is left."""
    return F.nullif(F.lower(F.concat_ws(" ", *columns)), F.lit(""))
