"""Columns computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Adds a costly column (such as parsed JSON) that is computed once per row.

    The optimizer copies the expression of a plain column into every filter it pushes
    down, so JSON would be parsed again for each mention. It does not push filters
    through ``explode``, here of a list of one. The expression itself stays in a
    projection, where it is compiled.
    """
    made = df.withColumn("_made", expression)
    return made.select(*df.columns, F.explode(F.array("_made")).alias(name))
