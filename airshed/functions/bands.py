"""Threshold table and the band / grade expressions built from it.

The threshold table is small and fixed per report run, so it is compiled into
CASE expressions (no join, stays in generated code).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from airshed.functions import labels as L


@dataclass(frozen=True)
class Band:
    pollutant: str
    moderate: float
    unhealthy: float

    @property
    def slug(self) -> str:
        return re.sub(r"[^0-9a-z]", "", self.pollutant.lower())


@dataclass(frozen=True)
class Limits:
    bands: tuple[Band, ...] = field(
        default_factory=lambda: tuple(Band(p, m, u) for p, m, u in L.POLLUTANT_LIMITS))
    flat: float = L.FLAT_LIMIT
    summary_good: float = L.SUMMARY_GOOD_LIMIT

    def band(self, pollutant: str) -> Band:
        for b in self.bands:
            if b.pollutant == pollutant:
                return b
        raise KeyError(pollutant)


DEFAULT_LIMITS = Limits()


def _p(col="pollutant_type") -> Column:
    return F.col(col)


def _v(col="avg_value") -> Column:
    return F.col(col)


def over_moderate(limits: Limits = DEFAULT_LIMITS, value="avg_value") -> Column:
    """Strictly above the moderate limit of its own pollutant."""
    cond = F.lit(False)
    for b in limits.bands:
        cond = cond | ((_p() == b.pollutant) & (_v(value) > b.moderate))
    return cond


def over_unhealthy(limits: Limits = DEFAULT_LIMITS, value="avg_value") -> Column:
    """Strictly above the unhealthy limit of its own pollutant."""
    cond = F.lit(False)
    for b in limits.bands:
        cond = cond | ((_p() == b.pollutant) & (_v(value) > b.unhealthy))
    return cond


def in_moderate_band(limits: Limits = DEFAULT_LIMITS, value="avg_value") -> Column:
    """Between the moderate and unhealthy limits, both ends inclusive (SQL BETWEEN)."""
    cond = F.lit(False)
    for b in limits.bands:
        cond = cond | ((_p() == b.pollutant) & _v(value).between(b.moderate, b.unhealthy))
    return cond


def health_status(limits: Limits = DEFAULT_LIMITS, value="avg_value") -> Column:
    """UNHEALTHY above the unhealthy limit, MODERATE above the moderate one, else HEALTHY.

    Pollutants without a band are HEALTHY.
    """
    expr = None
    for b in limits.bands:
        for cond, label in (((_p() == b.pollutant) & (_v(value) > b.unhealthy), L.UNHEALTHY),
                            ((_p() == b.pollutant) & (_v(value) > b.moderate), L.MODERATE)):
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(L.HEALTHY)


def location_grade(means: dict[str, Column], limits: Limits = DEFAULT_LIMITS) -> Column:
    """GOOD if every banded mean is at most its moderate limit (a missing mean
    passes), MODERATE if every one is at most its unhealthy limit, else POOR."""
    good = F.lit(True)
    moderate = F.lit(True)
    for b in limits.bands:
        m = means[b.pollutant]
        good = good & (F.coalesce(m, F.lit(0.0)) <= b.moderate)
        moderate = moderate & (F.coalesce(m, F.lit(0.0)) <= b.unhealthy)
    return F.when(good, L.GOOD).when(moderate, L.MODERATE).otherwise(L.POOR)
