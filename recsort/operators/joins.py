"""Join helpers: broadcast only what has a checked size bound.

Lookup tables (keywords, groups, vocabulary, corrections) are small by
contract, but we still check: ``limit(cap + 1).count()`` stops once the
cap is passed. Above the cap the plain DataFrame is returned and
Catalyst/AQE pick a shuffle join (AQE still converts to broadcast at run
time when the shuffled side turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# About 1M narrow lookup rows is comfortably below the default 8 GB
# broadcast limit and the driver's collect budget.
DEFAULT_BROADCAST_ROWS = 1_000_000


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_bounded(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if is_bounded(df, max_rows) else df
