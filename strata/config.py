"""Options of a run. The defaults give the results of the rules as coded; the alternatives give
the rules as worded (README, "Options")."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from strata import fixed_values as fv


@dataclass(frozen=True)
class GateOptions:
    first_day: dt.date = dt.date.fromisoformat(fv.WINDOW_FIRST_DAY)
    last_day: dt.date = dt.date.fromisoformat(fv.WINDOW_LAST_DAY)
    rate_codes: tuple[int, int] = fv.RATE_CODES
    zones: tuple[int, int] = fv.ZONES
    # "calendar_day": dropoff up to 00:00 of the day after pickup; "elapsed_24h": up to 86,400 s.
    duration_rule: str = "calendar_day"
    # "inclusive_midnight": up to last_day 00:00:00; "exclusive_next_day": all of last_day.
    window_end: str = "inclusive_midnight"

    def __post_init__(self):
        if self.duration_rule not in ("calendar_day", "elapsed_24h"):
            raise ValueError(f"unknown duration_rule: {self.duration_rule}")
        if self.window_end not in ("inclusive_midnight", "exclusive_next_day"):
            raise ValueError(f"unknown window_end: {self.window_end}")


@dataclass(frozen=True)
class RunOptions:
    gates: GateOptions = field(default_factory=GateOptions)
    # None: rows are duplicates when every column is equal, lineage included;
    # "business": lineage columns are ignored, so a row repeated in two files counts once.
    dedup: str | None = None
    focus_month: int = fv.FOCUS_MONTH
    # "mean_of_means" over the (day, hour) cells, or "trip_weighted".
    hour_mean: str = "mean_of_means"
    audit_system: str = "spark_medallion"
    audit_script: str = "run_medallion"
    # Fixed at the start of a run, so that a repeated task or run stamps the same value.
    ingested_at: dt.datetime | None = None
    # Size of a silver shuffle partition and file: about 500 MB in memory, 100 MB as Parquet.
    silver_rows_per_file: int = 2_000_000

    def __post_init__(self):
        if self.dedup not in (None, "business"):
            raise ValueError(f"unknown dedup: {self.dedup}")
        if self.hour_mean not in ("mean_of_means", "trip_weighted"):
            raise ValueError(f"unknown hour_mean: {self.hour_mean}")
