"""Columns that are computed once per row, whatever filters follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """The columns ``keep`` of ``df`` with the new ``columns``.

    A filter on a projected column is pushed below the projection, and then computes the
    column again, once for every place that names it. For a cheap column that is a gain; a
    parsed document it would parse many times over. Unfolding an array of one element
    gives the same row, and no filter on its element moves below it.

    The columns are made in a projection below the unfolding: there a common part of them is computed once, and
    a part without generated code leaves the others theirs.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    once = df.select(*keep, made.alias("__row")).select(*keep, F.explode(F.array("__row")).alias("__made"))
    return once.select(*keep, *[F.col("__made")[name].alias(name) for name in columns])
