"""Tunable parameters of the adaptive metrics, as one frozen value object."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class DecayParams:
    """Parameters of the adaptive-decay review metrics.

    Fixed values: the defaults below are the documented defaults of the
    metric definitions (age cap 365 days; short half-life 5% of tenure within
    7..30 days; long half-life 20% within 30..180; sentiment half-life 10%
    within 30..120). ``as_of`` None means the current date.
    """

    weight_age_cap_days: float = 365.0
    h_short_frac: float = 0.05
    h_short_min_days: float = 7.0
    h_short_max_days: float = 30.0
    h_long_frac: float = 0.20
    h_long_min_days: float = 30.0
    h_long_max_days: float = 180.0
    h_pos_frac: float = 0.10
    h_pos_min_days: float = 30.0
    h_pos_max_days: float = 120.0
    as_of: _dt.date | None = None

    def with_as_of(self, as_of: str | _dt.date) -> "DecayParams":
        if isinstance(as_of, str):
            as_of = _dt.date.fromisoformat(as_of)
        return replace(self, as_of=as_of)

    def overrides(self, **kw) -> "DecayParams":
        """Override parameters by name, as the metric definitions allow."""
        unknown = set(kw) - set(self.__dataclass_fields__)
        if unknown:
            raise KeyError(f"unknown decay parameters: {sorted(unknown)}")
        if isinstance(kw.get("as_of"), str):
            kw["as_of"] = _dt.date.fromisoformat(kw["as_of"])
        return replace(self, **kw)
