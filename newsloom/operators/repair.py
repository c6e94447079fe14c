"""Repairs of an article table: masks, fills, dates and coercions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import dates as D
from newsloom.functions import text as T
from newsloom.operators.quality import is_missing


def masked(column: Column, kind: str, mask: str = fixed.BLANK_MASK) -> Column:
    """Display form of one column of a Spark type given as text."""
    if kind.startswith("array"):
        joined = F.array_join(column, ", ")
        return F.when(column.isNull() | (F.size(column) == 0), mask).otherwise(joined)
    if kind == "string":
        return F.when(T.is_blank(column), mask).otherwise(column)
    return F.coalesce(column.cast("string"), F.lit(mask))


def mask_blanks(df: DataFrame, mask: str = fixed.BLANK_MASK) -> DataFrame:
    """Every blank shown as the mask, lists as text."""
    return df.select(*[masked(F.col(c), kind, mask).alias(c) for c, kind in df.dtypes])


def unmask_blanks(
    df: DataFrame, columns: Sequence[str] = ("titre", "contenu"), mask: str = fixed.BLANK_MASK
) -> DataFrame:
    """Masks and blanks in the columns back to null, other values untouched."""
    return df.withColumns(
        {c: F.when(~T.is_blank(F.col(c)) & (F.col(c) != mask), F.col(c)) for c in columns}
    )


def fill_created_at(df: DataFrame) -> DataFrame:
    """A missing creation date is taken from the publication date, if there is one."""
    published = F.col("date_publication")
    filled = F.when(is_missing(F.col("created_at")) & ~is_missing(published), published)
    return df.withColumn("created_at", filled.otherwise(F.col("created_at")))


def fill_source_type(df: DataFrame, value: str = "rss") -> DataFrame:
    """A missing source type becomes ``value``."""
    kind = F.col("source_type")
    return df.withColumn("source_type", F.when(is_missing(kind), value).otherwise(kind))


def source_type_of(
    source: Column,
    rules: Sequence[tuple[str, str, str]] = tuple(fixed.SOURCE_TYPE_RULES),
    default: str = fixed.DEFAULT_SOURCE_TYPE,
) -> Column:
    """Type of a source by prefix and containment rules; the first that fits wins.

    Neighbouring rules of one mode and type are tested as one array.
    """
    name = T.strip(F.coalesce(source, F.lit("")))
    runs: list[tuple[str, str, list[str]]] = []
    for mode, pattern, kind in rules:
        if runs and runs[-1][:2] == (mode, kind):
            runs[-1][2].append(pattern)
        else:
            runs.append((mode, kind, [pattern]))
    tests = {"prefix": F.startswith, "contains": F.contains}

    def fits(mode: str, patterns: list[str]) -> Column:
        return F.exists(F.array(*[F.lit(p) for p in patterns]), lambda p: tests[mode](name, p))

    typed = F.lit(default)
    for mode, kind, patterns in reversed(runs):
        typed = F.when(fits(mode, patterns), kind).otherwise(typed)
    return typed


def assign_source_type(df: DataFrame, **rules) -> DataFrame:
    """Missing source types worked out from the source; present ones kept."""
    kind = F.col("source_type")
    return df.withColumn(
        "source_type",
        F.when(is_missing(kind), source_type_of(F.col("source"), **rules)).otherwise(kind),
    )


def repair_dates(df: DataFrame, column: str = "date_publication", day_first: bool = False) -> DataFrame:
    """Text dates parsed; what cannot be read stays as it is and is flagged."""
    parsed = D.parse_mixed_date(F.col(column), day_first)
    return df.withColumn("parsed_date", parsed).withColumn(
        "date_ok", F.col("parsed_date").isNotNull()
    )


def coerce_timestamp(df: DataFrame, column: str, strict: bool = False) -> DataFrame:
    """Text to timestamp; unreadable text gives null, or an error when strict."""
    raw = F.col(column)
    parsed = D.iso_timestamp(raw)
    if strict:
        wrong = raw.isNotNull() & parsed.isNull()
        parsed = F.when(
            wrong, F.raise_error(F.concat(F.lit("not a timestamp: "), raw)).cast("timestamp")
        ).otherwise(parsed)
    return df.withColumn(column, parsed)


def categories_as_list(column: Column, kind: str) -> Column:
    """A list as it is but for nulls, a single value as a list of one, nothing as an empty list."""
    empty = F.array().cast("array<string>")
    if kind.startswith("array"):
        listed = F.coalesce(F.array_compact(column), empty)
    else:
        listed = F.when(is_missing(column), empty).otherwise(F.array(column))
    # Spark then knows that no element is null.
    return F.transform(listed, lambda c: F.coalesce(c, F.lit("")))


def explode_categories(df: DataFrame, column: str = "categorie") -> DataFrame:
    """One row per category; a null or empty list gives one row with null."""
    return df.withColumn(column, F.explode_outer(column))
