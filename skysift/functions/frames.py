"""Frame tokens, radio bands and vector distances."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 13 frame tokens and the spellings they absorb.
MANAGEMENT = (
    "beacon", "probe_request", "probe_response", "authentication", "association_request", "association_response",
    "reassociation_request", "reassociation_response", "disassociation", "deauthentication", "action",
)
TOKENS = (*MANAGEMENT, "data", "other")
SPELLINGS = {
    "auth": "authentication", "assoc_request": "association_request", "assoc_response": "association_response", "reassoc_request": "reassociation_request",
    "reassoc_response": "reassociation_response", "disassoc": "disassociation", "deauth": "deauthentication",
}


def frame_token(frame_type: Column, subtype: Column) -> Column:
    """One of TOKENS; data by type, everything unknown is other."""
    s = F.coalesce(F.translate(F.lower(F.trim(subtype)), "- ", "__"), F.lit(""))
    known = F.when(s.isin(*MANAGEMENT), s)
    for spelling, token in SPELLINGS.items():
        known = known.when(s == spelling, token)
    return known.when(F.lower(F.trim(frame_type)) == "data", "data").otherwise("other")


def band(channel: Column) -> Column:
    return F.when(channel.between(1, 14), "2.4GHz").when((channel > 14) & (channel <= 233), "5GHz").otherwise("unknown")


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null for empty vectors or different sizes, 0 for a zero vector, within -1 .. 1."""
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    value = F.when(norm == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), _dot(a, b) / norm)))
    return F.when((F.size(a) > 0) & (F.size(a) == F.size(b)), value)
