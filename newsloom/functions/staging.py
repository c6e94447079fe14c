"""Work a costly column out once per row.

Catalyst may write an expression out again wherever it is used: in a filter it
pushes down, in a projection it merges, around Python functions.  For cheap
expressions that is fine; for a text pass it is not.  A one-row generator is a
step that such rewrites stop at, while filters on other columns and column
pruning still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """As ``withColumns``; each new column is worked out exactly once per row."""
    kept = [c for c in df.columns if c not in columns]
    made = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*kept, F.inline_outer(F.array(made))).select(
        *df.columns, *[c for c in columns if c not in df.columns]
    )
