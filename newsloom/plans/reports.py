"""Reports: counts, shares, calendar series and crosstabs.

Every report is a partial aggregation in each task followed by a small
shuffle of the groups, so a key that holds a third of the rows costs one row
per task.  Totals come from scalar subqueries over the counts, not from a window
over all groups, so no task ever sees all of them and the table is read once.  Wide crosstabs take their column
values as a list; without one they come in long form.

Null keys are dropped from the reports unless the name says otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.operators.quality import date_range_filter
from newsloom.operators.repair import explode_categories


def _rows() -> Column:
    return F.count("*").alias("n")


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, the null key included."""
    return df.groupBy(key).agg(_rows())


def value_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, most frequent first."""
    return count_by(df.where(F.col(key).isNotNull()), key).orderBy(F.desc("n"), key)


def value_shares(df: DataFrame, key: str, scale: float = 1.0) -> DataFrame:
    """As above with each key's share of all rows that have one, times ``scale``."""
    counted = count_by(df.where(F.col(key).isNotNull()), key)
    total = counted.agg(F.sum("n")).scalar()
    share = F.col("n") / total * F.lit(scale)
    return counted.withColumn("share", share).orderBy(F.desc("n"), key)


def day_of(moment: str | Column) -> Column:
    """The UTC day of a timestamp."""
    return F.to_date(moment)


def calendar(df: DataFrame, start: str, end: str) -> DataFrame:
    """One row per day from ``start`` to ``end``."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    return df.sparkSession.range(1).select(F.explode(days).alias("day"))


def _since(df: DataFrame, moment: str, start: str) -> DataFrame:
    """Rows per day from ``start`` on."""
    return date_range_filter(df, moment, start).groupBy(day_of(moment).alias("day")).agg(_rows())


def _on_calendar(counted: DataFrame, start: str, end: str) -> DataFrame:
    return (
        calendar(counted, start, end)
        .join(counted, "day", "left")
        .select("day", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy("day")
    )


def daily_volume(df: DataFrame, moment: str, start: str, end: str) -> DataFrame:
    """Rows per day over a calendar without gaps; rows after its end are left out."""
    return _on_calendar(_since(df, moment, start), start, end)


def daily_share(df: DataFrame, moment: str, start: str, end: str) -> DataFrame:
    """Each day's part of all rows since ``start``, those after the calendar's end included."""
    counted = _since(df, moment, start)
    total = counted.agg(F.sum("n")).scalar()
    return _on_calendar(counted, start, end).select("day", (F.col("n") / total).alias("share"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str] | None = None) -> DataFrame:
    """Counts by row and column.

    With ``values`` one column per value and 0 where nothing was counted, for
    all rows that have any value at all; otherwise one line per pair.
    """
    both = df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
    if values is None:
        return both.groupBy(row, column).agg(_rows())
    # One conditional sum per value: a single shuffle of one line per row key.
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return both.groupBy(row).agg(*counts).orderBy(row)


def _dated(df: DataFrame, moment: str, start: str, end: str) -> DataFrame:
    return date_range_filter(df, moment, start, end).withColumn("day", day_of(moment))


def day_by(
    df: DataFrame, moment: str, column: str, start: str, end: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Day by sentiment, origin or another single-valued column."""
    return crosstab(_dated(df, moment, start, end), "day", column, values)


def day_by_category(
    df: DataFrame, moment: str, start: str, end: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Day by category; an article counts once in each of its categories."""
    return crosstab(explode_categories(_dated(df, moment, start, end)), "day", "categorie", values)


def category_by_sentiment(
    df: DataFrame, moment: str, start: str, end: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Category by sentiment within a date range."""
    dated = explode_categories(_dated(df, moment, start, end))
    return crosstab(dated, "categorie", "sentiment", values)


def row_shares(counts: DataFrame, row: str, scale: float = 1.0) -> DataFrame:
    """Each count of a long crosstab as a share of its row.

    The window holds one line per column value of a row, not articles.
    """
    total = F.sum("n").over(Window.partitionBy(row))
    return counts.withColumn("share", F.col("n") / total * F.lit(scale))


def wide_row_shares(wide: DataFrame, values: Sequence[str]) -> DataFrame:
    """Each row of a wide crosstab divided by its sum."""
    total = sum((F.col(v) for v in values), F.lit(0))
    return wide.withColumns({v: F.try_divide(F.col(v), total) for v in values})


def segment_percent(counts: DataFrame, row: str) -> DataFrame:
    """Percentage of every segment that occurs, to one decimal."""
    shares = row_shares(counts.where(F.col("n") > 0), row, 100.0)
    return shares.withColumn("pct", F.round("share", 1)).drop("share")


def origin_by_sentiment(
    df: DataFrame, values: Sequence[str] | None = None, missing: str = fixed.MISSING_SENTIMENT
) -> DataFrame:
    """Origin by sentiment, a missing sentiment counted under its own name."""
    return crosstab(df.na.fill({"sentiment": missing}), "origin", "sentiment", values)


def origin_by_category(
    df: DataFrame, values: Sequence[str] | None = None, missing: str = fixed.MISSING_CATEGORY
) -> DataFrame:
    """Origin by category; no category list at all counts under its own name.

    An empty list is a list without categories and counts nowhere.
    """
    filled = df.withColumn("categorie", F.coalesce("categorie", F.array(F.lit(missing))))
    return crosstab(explode_categories(filled), "origin", "categorie", values)


def date_origin_counts(df: DataFrame, moment: str, origin: str = "origin") -> DataFrame:
    """Day, origin and rows, without a date filter."""
    return crosstab(df.withColumn("day", day_of(moment)), "day", origin).orderBy("day", origin)
