"""Keys for clustering files on several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def morton_key(columns: Sequence[str], bits: int) -> Column:
    """Interleave the ``bits`` bits of small non-negative integer expressions into one long.

    Rows close in all columns get close keys, so a range of the key is a compact block in each. A value that
    does not fit in ``bits`` bits raises.
    """
    width = len(columns)
    if not columns or bits * width > 63:
        raise ValueError("the interleaved key has to fit in 63 bits")
    digits = [
        f"shiftleft(bigint(shiftright({column}, {bit}) & 1), {bit * width + place})"
        for bit in range(bits)
        for place, column in enumerate(columns)
    ]
    too_wide = " OR ".join(f"shiftright(bigint({column}), {bits}) != 0" for column in columns)
    error = f"bigint(raise_error('a value of a clustered column does not fit in {bits} bits'))"
    return F.expr(f"CASE WHEN {too_wide} THEN {error} ELSE {' | '.join(digits)} END")
