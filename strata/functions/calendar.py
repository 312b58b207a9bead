"""Calendar parts, calendar buckets and travel time, as SQL expressions."""

from __future__ import annotations

from strata import fixed_values as fv


def check_grain(grain: str) -> str:
    if grain not in fv.GRAINS:
        raise ValueError(f"invalid time slice {grain!r}; valid slices are {fv.GRAINS}")
    return grain


def calendar_part(grain: str, ts: str) -> str:
    """Month of year (1-12), day of month (1-31) or hour of day (0-23): equal parts of different
    months or years fall together."""
    return f"{check_grain(grain)}({ts})"


def calendar_bucket(grain: str, ts: str, ts_type: str) -> str:
    """Start of the month, day or hour ``ts`` lies in, in the type of ``ts``: nothing is pooled."""
    return f"cast(date_trunc('{check_grain(grain)}', {ts}) AS {ts_type})"


def three_parts(ts: str) -> dict[str, str]:
    """The keys of the month/day/hour grain."""
    return {
        fv.MONTH_SLICE: calendar_part("month", ts),
        fv.DAY_SLICE: calendar_part("day", ts),
        fv.HOUR_SLICE: calendar_part("hour", ts),
    }


def travel_seconds(pickup: str = fv.PICKUP, dropoff: str = fv.DROPOFF) -> str:
    """Whole seconds between pickup and dropoff, as a long."""
    return f"unix_timestamp({dropoff}) - unix_timestamp({pickup})"
