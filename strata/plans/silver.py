"""Bronze rows to silver rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from strata.config import RunOptions
from strata.operators.dedup import drop_business_duplicates, drop_exact_duplicates
from strata.operators.quality import apply_gates, trip_gates


def silver_rows(bronze: DataFrame, options: RunOptions = RunOptions()) -> DataFrame:
    """Rows that pass every gate, without duplicates. Gates run first: they are scan-side filters
    and leave fewer rows to shuffle."""
    kept = apply_gates(bronze, trip_gates(options.gates))
    return drop_business_duplicates(kept) if options.dedup == "business" else drop_exact_duplicates(kept)
