"""Run parameters for the marts.

The reference reads ``CURRENT_DATE()`` and pins a few years inside its SQL;
here they are parameters, so a run is repeatable and a test can fix them.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class MartConfig:
    # Fixed values of the published marts.
    state: str = "40"                 # state FIPS prefix of in-state areas
    state_name: str = "Oklahoma"      # name used on state rows
    baseline_year: int = 2015         # index base year (month 1 for monthly series)
    population_years: tuple[int, int] = (2024, 2023)   # current, prior
    award_levels: tuple[int, ...] = (3, 5, 7, 9, 11)
    certification_type: str = "Certification"
    excluded_certification: str = "Valid Driver's License"
    hours_per_year: int = 2080
    as_of: _dt.date = field(default_factory=_dt.date.today)
    # "now" for the operational views (freshness, recent runs)
    ops_as_of: _dt.datetime = field(default_factory=lambda: _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))
    recent_as_of: _dt.datetime | None = None   # defaults to ops_as_of
    # 'as_written' keeps the source's grouping by the full code (trap T1);
    # 'truncated' groups by the 5-digit code the output column carries.
    lq_group_on: str = "as_written"

    @property
    def as_of_year(self) -> int:
        return self.as_of.year


def harness_config() -> MartConfig:
    """Parameters for the driver's synthetic tables.

    Their calendar runs 1995-2001 (orders end 2001-08-01), so the run date,
    the index base year and the pinned population years move with it.
    """
    return MartConfig(
        as_of=_dt.date(2001, 8, 1),
        baseline_year=1995,
        population_years=(2001, 2000),
        # the run log spans 2024-01-01 .. 2024-01-30
        ops_as_of=_dt.datetime(2024, 3, 15, 0, 0, 0),
        recent_as_of=_dt.datetime(2024, 1, 30, 0, 0, 0),
    )
