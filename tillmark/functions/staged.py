"""Parsers as steps of columns.

A parser is a list of steps, each a dict of new columns that may refer to those of the
steps before. Spark computes a column that is mentioned often once, if it was made in an
earlier projection. ``staged`` lays several parsers side by side, so that all first steps
share one projection, all second steps the next, and so on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

Steps = list[dict[str, Column]]


def staged(df: DataFrame, *parsers: Steps) -> DataFrame:
    """Add the columns of all steps. Helper columns stay; what is not selected costs nothing."""
    for depth in range(max(map(len, parsers), default=0)):
        df = df.withColumns({name: col for steps in parsers if depth < len(steps) for name, col in steps[depth].items()})
    return df
