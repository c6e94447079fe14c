"""Quality predicates, profiles and censuses of an article table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import text as T
from newsloom.session import scratch_path


def _any(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


# --- predicates ---------------------------------------------------------------


def is_missing(column: Column) -> Column:
    """Null or the empty string; never null itself."""
    return column.isNull() | (F.coalesce(column, F.lit("")) == "")


def passes_gate(
    title: Column,
    content: Column,
    min_title: int = fixed.MIN_TITLE_LENGTH,
    min_content: int = fixed.MIN_CONTENT_LENGTH,
) -> Column:
    """Title and content long enough once stripped; a null fails, never nulls."""
    return F.coalesce(T.has_length(title, min_title), F.lit(False)) & F.coalesce(
        T.has_length(content, min_content), F.lit(False)
    )


# --- filters --------------------------------------------------------------------


def quality_gate(df: DataFrame, title: str = "titre", content: str = "contenu", **limits: int) -> DataFrame:
    """Rows whose raw title and content are long enough."""
    return df.where(passes_gate(F.col(title), F.col(content), **limits))


def with_missing(df: DataFrame, column: str) -> DataFrame:
    """Rows where the column is null or empty."""
    return df.where(is_missing(F.col(column)))


def with_id(df: DataFrame, column: str = "id_article") -> DataFrame:
    """Rows that carry an id."""
    return df.where(~is_missing(F.col(column)))


def invalid_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a null in any of the columns."""
    return df.where(_any([F.col(c).isNull() for c in columns]))


def drop_null_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null in the columns, or in any column at all."""
    return df.na.drop(subset=list(columns) if columns else None)


def short_content(df: DataFrame, column: str = "contenu", below: int = fixed.MIN_CONTENT_LENGTH) -> DataFrame:
    """Rows whose unstripped text is too short; a null is neither short nor long."""
    return df.where(F.length(column) < below)


def long_content(df: DataFrame, column: str = "contenu", least: int = fixed.MIN_CONTENT_LENGTH) -> DataFrame:
    """The other half of :func:`short_content`."""
    return df.where(F.length(column) >= least)


def date_range_filter(df: DataFrame, column: str, start: str, end: str | None = None) -> DataFrame:
    """Rows on or after ``start`` and, if given, on or before ``end`` (UTC)."""
    # Literals of the column's own type, so the bounds reach the Parquet scan.
    kind = df.schema[column].dataType.simpleString()
    moment = F.col(column)
    kept = df.where(moment >= F.lit(start).cast(kind))
    return kept if end is None else kept.where(moment <= F.lit(end).cast(kind))


def rows_with_value(df: DataFrame, value: str = fixed.BLANK_MASK) -> DataFrame:
    """Rows where any text column equals ``value``."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.where(_any([F.col(c).eqNullSafe(F.lit(value)) for c in texts]))


def null_content_sources(df: DataFrame, content: str = "contenu") -> DataFrame:
    """Source and address of the rows without content."""
    return df.where(F.col(content).isNull()).select("source", "url")


# --- profiles -------------------------------------------------------------------


def _long_counts(df: DataFrame, tests: dict[str, Column], name: str) -> DataFrame:
    """One pass over ``df``; one output row per test."""
    counts = df.agg(*[F.count_if(test).alias(column) for column, test in tests.items()])
    return counts.unpivot([], list(tests), "column_name", name)


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, in long form."""
    return _long_counts(df, {c: F.col(c).isNull() for c in df.columns}, "nulls")


def blank_counts(df: DataFrame) -> DataFrame:
    """Null, empty or blank texts, and null or empty lists, per column."""
    tests = {}
    for name, kind in df.dtypes:
        column = F.col(name)
        if kind == "string":
            tests[name] = T.is_blank(column)
        elif kind.startswith("array"):
            tests[name] = column.isNull() | (F.size(column) == 0)
        else:
            tests[name] = column.isNull()
    return _long_counts(df, tests, "blanks")


def column_profile(df: DataFrame) -> DataFrame:
    """Column, type and number of values that are there, in long form."""
    kinds = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    counts = _long_counts(df, {c: F.col(c).isNotNull() for c in df.columns}, "present")
    return counts.select("column_name", kinds[F.col("column_name")].alias("data_type"), "present")


def stored_type(json_column: str, field: str) -> Column:
    """The JSON type of a field of a dynamic document; MISSING where there is none."""
    value = F.try_variant_get(F.try_parse_json(json_column), f"$.{field}", "variant")
    kind = F.regexp_extract(F.schema_of_variant(value), r"^(\w+)", 1)
    return F.coalesce(kind, F.lit("MISSING"))


def type_census(df: DataFrame, json_column: str, field: str) -> DataFrame:
    """How often each JSON type occurs in a field of a dynamic document."""
    return df.groupBy(stored_type(json_column, field).alias("json_type")).agg(F.count("*").alias("n"))


def rows_of_type(df: DataFrame, json_column: str, field: str, *types: str) -> DataFrame:
    """The rows whose field is stored as one of the types."""
    return df.where(stored_type(json_column, field).isin(*types))


def length_summary(df: DataFrame, column: str = "contenu") -> DataFrame:
    """Count, mean, sample deviation, quartiles and extremes of a text length.

    Every task sums up its own rows: the deviation by the moments about its own
    mean, which merge without losing digits, the exact quartiles by one counted
    map of lengths.  What meets in the end is a row for each task.
    """
    chars = F.length(column)
    quartiles = F.percentile(chars, [0.25, 0.5, 0.75])
    summary = df.where(F.col(column).isNotNull()).agg(
        F.count("*").alias("n"),
        F.avg(chars).alias("mean"),
        F.stddev_samp(chars).alias("std"),
        F.min(chars).alias("min"),
        quartiles.alias("q"),
        F.max(chars).alias("max"),
    )
    named = [F.get("q", F.lit(k)).alias(name) for k, name in enumerate(("q25", "q50", "q75"))]
    return summary.select("n", "mean", "std", "min", *named, "max")


def count_all(df: DataFrame) -> DataFrame:
    """The number of rows."""
    return df.agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, column: str = "id_article") -> DataFrame:
    """The distinct non-null values of a column."""
    return df.where(F.col(column).isNotNull()).select(column).distinct()


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a total order."""
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, *order: str | Column) -> DataFrame:
    """The rows with ``position``, from 0, in a total order.

    The sorted ranges are numbered each by itself and written; the counts of the
    ranges, one row each, say where each begins.  No task sees all rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    place = F.monotonically_increasing_id()
    marked = df.orderBy(*order).select("*", place.alias("_place"))
    marked.write.parquet(path)
    rows = spark.read.schema(marked.schema).parquet(path)
    rows = rows.withColumn("_range", F.shiftright("_place", 33))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("_range", before.alias("_before"))
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(starts, "_range").withColumn("position", F.col("_before") + within).drop("_range", "_place", "_before")


def order_histogram(df: DataFrame, first: str, order: Column | str | None = None, ranges: int | None = None) -> DataFrame:
    """(place, low, high, nulls, n) of ``ranges`` ranges of a sort column, in its order.

    ``order`` is the column as it is sorted by, descending for instance; there are as
    many ranges as shuffle partitions unless more are asked for.  Of the table the one
    column is read and shuffled; equal values are in one range, so the counts
    say exactly how many rows come before a range.  Store it to look up more pages.
    """
    ranges = ranges or max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.select(first).repartitionByRange(ranges, first if order is None else order)
    return parts.groupBy(F.spark_partition_id().alias("place")).agg(
        F.min(first).alias("low"), F.max(first).alias("high"), (F.count("*") - F.count(first)).alias("nulls"), F.count("*").alias("n")
    )


def page_rows(
    df: DataFrame, skip: int, n: int, *order: str | Column, first: str | None = None, histogram: DataFrame | None = None
) -> DataFrame:
    """``n`` rows after the first ``skip``, in a total order; the skipped ones meet in no task.

    The rows of the ranges that the page lies in are read and put in order, no others:
    ``first`` names the column that the order begins with, where that is not a plain
    name, and ``histogram`` is a stored ``order_histogram`` of it.  Without a name the
    whole table is put in order.
    """
    first = first or (order[0] if isinstance(order[0], str) else None)
    if first is None:
        return numbered(df, *order).where(F.col("position").between(skip, skip + n - 1)).drop("position")
    ranges = histogram if histogram is not None else order_histogram(df, first, order[0])
    before, low, high, nulls, start = 0, [], [], False, None
    for row in ranges.orderBy("place").collect():  # one short row for each range
        if before < skip + n and before + row["n"] > skip:
            start = before if start is None else start
            low, high = [*low, row["low"]], [*high, row["high"]]
            nulls = nulls or row["nulls"] > 0
        before += row["n"]
    if start is None:
        return df.limit(0)
    column, within = F.col(first), F.lit(False)
    if any(v is not None for v in low):
        within = column.between(F.lit(min(v for v in low if v is not None)), F.lit(max(v for v in high if v is not None)))
    part = df.where(within | column.isNull() if nulls else within)
    return numbered(part, *order).where(F.col("position").between(skip - start, skip - start + n - 1)).drop("position")
