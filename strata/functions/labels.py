"""Label lookups written as CASE expressions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_of(key: Column, labels: Mapping[int, str]) -> Column:
    """The label of an integer key; NULL for a key without one."""
    chain = F
    for value, text in labels.items():
        chain = chain.when(key == value, F.lit(text))
    return chain.otherwise(F.lit(None).cast("string"))


def sign_status(deviation: Column, texts: Sequence[str]) -> Column:
    """The text for above, below or at the mean. A NULL deviation counts as at the mean."""
    above, below, equal = texts
    return F.when(deviation > 0, above).when(deviation < 0, below).otherwise(equal)
