"""Sums of doubles, as SQL expressions: nothing is rounded away, and the order of values does not matter.

A sum of doubles changes in its last digits with the partitioning. A value that is the double of a number with
few decimals, such as money, is therefore counted in ticks of ``10 ** -decimals``, a whole number that a long
holds: two sums of longs (ticks below and above ``2 ** LOW_BITS``, so that none can overflow), which is exact, free of order
and cheap. Any other value is the decimal number it prints as, split into a whole part and a fraction of ``FRACTION``
decimals, each summed as a decimal; on money these sums see only NULL. What lies below those decimals, and
values from ``LARGE`` on, are summed as doubles, with the usual precision of such a sum.
"""

from __future__ import annotations

from collections.abc import Mapping

# Ticks: two decimals more than money and distances have.
DECIMALS = 4
LOW_BITS = 24
# Up to here a count of ticks is a whole number that a double holds exactly.
MOST_TICKS = "9007199254740992D"
FRACTION = 18
LARGE = "1e18D"
_NUMBER = f"decimal({18 + FRACTION},{FRACTION})"
_INFINITY = "double('Infinity')"

# Names of the parts of a sum. Each is a sum itself, so parts are merged by adding them.
SUM_PARTS = ("high", "low", "whole", "fraction", "rest")


def summands(value: str, decimals: int = DECIMALS) -> dict[str, str]:
    """What the parts of a sum are made of, by name: the ticks of a value with few decimals, and the decimal
    number of another. As columns of their own they are computed once a row."""
    scale = 10**decimals
    value = f"double({value})"
    scaled = f"rint({value} * {scale}D)"
    is_few = f"abs({scaled}) < {MOST_TICKS} AND {scaled} / {scale}D = {value}"
    return {
        "ticks": f"CASE WHEN {is_few} THEN bigint({scaled}) END",
        "number": f"CASE WHEN abs({value}) < {LARGE} AND NOT ({is_few}) THEN cast({value} AS {_NUMBER}) END",
    }


def sum_parts(value: str, decimals: int = DECIMALS, of: Mapping[str, str] | None = None) -> dict[str, str]:
    """The parts of the sum of the finite values, as aggregates by name; ``of`` names columns that hold the
    summands."""
    of = of or summands(value, decimals)
    ticks, number = of["ticks"], of["number"]
    value = f"double({value})"
    whole = f"cast({number} AS decimal(28,0))"
    # The filter keeps the sums of decimals, which are slow to read and write, out of rows that have none.
    if_any = f"FILTER (WHERE {number} IS NOT NULL)"
    return {
        "high": f"sum(shiftright({ticks}, {LOW_BITS}))",
        "low": f"sum(({ticks}) & {(1 << LOW_BITS) - 1}L)",
        "whole": f"sum({whole}) {if_any}",
        "fraction": f"sum(cast({number} - cast({whole} AS {_NUMBER}) AS decimal({FRACTION + 1},{FRACTION}))) {if_any}",
        # NaN sorts above every number in Spark, so one comparison drops it with the infinities.
        "rest": (
            f"sum(CASE WHEN abs({value}) >= {LARGE} AND abs({value}) < {_INFINITY} THEN {value}"
            f" WHEN {number} IS NOT NULL THEN {value} - double({number}) END)"
        ),
    }


def joined_total(parts: dict[str, str], low: str, high: str, decimals: int = DECIMALS) -> str:
    """The total as a double, from the parts of a sum and the extremes of the same values.

    NaN and infinities are left out of the parts and show in the extremes: they decide the total
    just as they would in a sum of doubles.
    """

    def whole(part: str) -> str:
        return f"cast(coalesce({parts[part]}, 0L) AS decimal(19,0))"

    ticks = f"cast({whole('high')} * {1 << LOW_BITS}BD + {whole('low')} AS decimal(28,0)) * {_power(decimals)}"
    units = f"({ticks} + coalesce({parts['whole']}, 0BD))"
    fraction, exact = f"coalesce({parts['fraction']}, 0BD)", f"decimal({19 + FRACTION},{FRACTION})"
    # Both are added before the one rounding to a double; where that does not fit, the fraction is below its last digit.
    added = f"double(try_cast({units} AS {exact}) + try_cast({fraction} AS {exact}))"
    total = f"coalesce({added}, double({units}) + double({fraction})) + coalesce({parts['rest']}, 0D)"
    all_finite = f"abs({low}) < {_INFINITY} AND abs({high}) < {_INFINITY}"
    return f"CASE WHEN {all_finite} THEN {total} ELSE {low} + {high} END"


def mean_of(total: str, count: str) -> str:
    """Total over count as a double; NULL where nothing was counted."""
    return f"({total}) / nullif({count}, 0)"


def exact_mean(value: str, decimals: int = DECIMALS) -> str:
    """Mean of the non-null values, as an aggregate."""
    total = joined_total(sum_parts(value, decimals), f"min({value})", f"max({value})", decimals)
    return mean_of(total, f"count({value})")


def _power(decimals: int) -> str:
    return f"{10**-decimals:.{decimals}f}BD"
