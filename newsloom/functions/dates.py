"""Dates that arrive as text, as column expressions in UTC.

A text is first tried as ISO 8601, also inside an extended-JSON wrapper.  If
that fails, the day, time and zone are looked for anywhere in it, so words
around them do not matter.  What is not understood becomes null; the caller
decides about defaults.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import let, without_marks

# The beginnings of month names, French and English, and their months.
MONTHS = {
    "jan": 1, "fev": 2, "feb": 2, "mar": 3, "avr": 4, "apr": 4, "mai": 5, "may": 5, "juin": 6, "jun": 6,
    "juil": 7, "jul": 7, "aou": 8, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
_ISO = r"^\s*\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?\s*(Z|[+-]\d{2}(:?\d{2})?)?)?\s*\z"
_NAMED = "|".join(MONTHS)
_MONTHS_TEXT = ",".join(f"{name}:{month}" for name, month in MONTHS.items())


def iso_timestamp(raw: Column) -> Column:
    """Extended-JSON or ISO text to a timestamp; no zone means UTC; else null."""
    wrapped = F.get_json_object(raw, "$.$date")
    plain = F.trim(F.when(raw.startswith("{"), wrapped).otherwise(raw))
    return F.when(plain.rlike(_ISO), F.try_to_timestamp(plain))


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _month_number(name: Column) -> Column:
    months = F.str_to_map(F.lit(_MONTHS_TEXT))
    found = [F.try_element_at(months, F.substring(name, 1, n)) for n in (4, 3)]
    return F.coalesce(*found).cast("int")


def loose_timestamp(raw: Column, day_first: bool = False) -> Column:
    """A day, and a time and zone if present, found anywhere in the text.

    In a numeric day such as 12/10/2025 the month comes first whenever it can,
    and second when the first number is over 12; ``day_first`` turns that round.
    """
    return let(without_marks(F.lower(raw)), lambda text: _loose(text, day_first))


def _loose(text: Column, day_first: bool) -> Column:
    slashed = r"(?<!\d)(\d{1,2})[/.\-](\d{1,2})[/.\-](\d{4})(?!\d)"
    day_name = rf"(?<!\d)(\d{{1,2}})(?:er|st|nd|rd|th)?[\s\-]+((?:{_NAMED})[a-z]*)\.?,?[\s\-]+(\d{{4}})"
    name_day = rf"((?:{_NAMED})[a-z]*)\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})"
    iso_day = r"(?<!\d)(\d{4})[/\-](\d{1,2})[/\-](\d{1,2})(?!\d)"

    one = _group(text, slashed, 1).cast("int")
    two = _group(text, slashed, 2).cast("int")
    if day_first:
        slash_month = F.when(two > 12, one).otherwise(two)
        slash_day = F.when(two > 12, two).otherwise(one)
    else:
        slash_month = F.when(one > 12, two).otherwise(one)
        slash_day = F.when(one > 12, one).otherwise(two)

    year = F.coalesce(
        _group(text, slashed, 3),
        _group(text, day_name, 3),
        _group(text, name_day, 3),
        _group(text, iso_day, 1),
    ).cast("int")
    month = F.coalesce(
        slash_month,
        _month_number(_group(text, day_name, 2)),
        _month_number(_group(text, name_day, 1)),
        _group(text, iso_day, 2).cast("int"),
    )
    day = F.coalesce(
        slash_day,
        _group(text, day_name, 1).cast("int"),
        _group(text, name_day, 2).cast("int"),
        _group(text, iso_day, 3).cast("int"),
    )
    clock = r"(?<!\d)(\d{1,2}):(\d{2})(?::(\d{2}))?\s*([ap]m)?"
    hour = F.coalesce(_group(text, clock, 1).cast("int"), F.lit(0))
    half = F.regexp_extract(text, clock, 4)
    hour = (
        F.when((half == "pm") & (hour < 12), hour + 12)
        .when((half == "am") & (hour == 12), 0)
        .otherwise(hour)
    )
    minute = F.coalesce(_group(text, clock, 2).cast("int"), F.lit(0))
    second = F.coalesce(_group(text, clock, 3).cast("int"), F.lit(0))
    zone = r":\d{2}(?:\.\d+)?\s*([+-])(\d{2}):?(\d{2})(?!\d)"
    offset = F.coalesce(
        (_group(text, zone, 2).cast("int") * 60 + _group(text, zone, 3).cast("int"))
        * F.when(_group(text, zone, 1) == "-", -1).otherwise(1),
        F.lit(0),
    )
    local = F.try_make_timestamp(
        years=year, months=month, days=day, hours=hour, mins=minute, secs=second.cast("decimal(16,6)")
    )
    return F.timestamp_add("MINUTE", -offset, local)


def parse_mixed_date(raw: Column, day_first: bool = False) -> Column:
    """ISO first, then the loose reading; null when neither works."""
    return F.coalesce(iso_timestamp(raw), loose_timestamp(raw, day_first))


def parse_date_or(raw: Column, default: Column, day_first: bool = False) -> Column:
    """As above with a default, usually the time of the run."""
    return F.coalesce(parse_mixed_date(raw, day_first), default)


def iso_text(moment: Column) -> Column:
    """ISO 8601 text in UTC, fractions only when there are any; null stays null."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssxxx")
    fine = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.extract(F.lit("SECOND"), moment) % 1 == 0, whole).otherwise(fine)
