"""Risk and similarity scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def weighted_risk(score: Column, weight: Column) -> Column:
    """Aggregate: bounded scores times non-negative weights, summed, within 0 .. 100."""
    return clamp(F.sum(clamp(score, 0.0, 100.0) * F.greatest(weight, F.lit(0.0))), 0.0, 100.0)


def dns_score(blocked: Column, traffic: Column, recent: Column) -> Column:
    n = F.greatest(blocked, F.lit(1)).cast("double")
    return blocked * (traffic / n + 1) * (1 + 2.0 * recent / n)


def severity(score: Column) -> Column:
    return F.when(score >= 1000, "critical").when(score >= 500, "high").when(score >= 100, "medium").otherwise("low")


def ap_risk(deauth: Column, anomaly: Column, typosquat: Column, vendor: Column, outlier: Column) -> dict[str, Column]:
    """Signal, identity, behaviour and composite risk; inputs are bounded to 0 .. 1."""
    finite = [F.when(F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")), F.raise_error(F.lit("risk input is not finite")).cast("double")).otherwise(clamp(c.cast("double"), 0.0, 1.0)) for c in (deauth, anomaly, typosquat, vendor, outlier)]
    signal = 0.25 * finite[0] + 0.20 * finite[1]
    identity = 0.20 * finite[2] + 0.15 * finite[3]
    behaviour = 0.20 * finite[4]
    return {"signal_risk": signal, "identity_risk": identity, "behaviour_risk": behaviour, "composite_risk": clamp(signal + identity + behaviour, 0.0, 1.0)}


def distance_similarity(distance: Column) -> Column:
    """1 - distance within -1 .. 1; distances that are not finite or outside 0 .. 2 are errors."""
    fine = distance.between(0.0, 2.0) & ~F.isnan(distance)
    return F.when(fine, clamp(1 - distance, -1.0, 1.0)).when(distance.isNotNull(), F.raise_error(F.concat(F.lit("invalid cosine distance "), distance.cast("string"))).cast("double"))
