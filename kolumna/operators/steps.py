"""A projection that is evaluated once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read as plain values.

    A filter on a projected column is pushed below the projection, and the expression with it: it is
    then evaluated twice, and a chain of such steps grows with every mention. A one-element
    ``inline`` keeps its place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[e.alias(name) for name, e in columns.items()]))))
