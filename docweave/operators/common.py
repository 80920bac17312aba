"""Plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, computed: list[str]) -> DataFrame:
    """Optimisation boundary for expensive derived columns.

    The ``computed`` columns come out of a one-row generator, so a later
    filter on them cannot be pushed (and their expressions inlined, once per
    reference) below it; the other columns pass through and still reach the
    scan.
    """
    keep = [c for c in df.columns if c not in computed]
    return df.select(*keep, F.inline(F.array(F.struct(*computed))))

