"""Article ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed


def md5_id(address: Column) -> Column:
    """Feed articles: md5 of the address as it stands, blanks included."""
    return F.md5(address)


def sha256_id(address: Column) -> Column:
    """Page articles."""
    return F.sha2(address, 256)


def title_date_id(title: Column, date_text: Column) -> Column:
    """Block articles; null when either part is null."""
    return F.sha2(F.concat(title, F.lit("-"), date_text), 256)


def short_title_date_id(title: Column, date_text: Column) -> Column:
    """Message articles: the first characters of the same digest."""
    return F.substring(title_date_id(title, date_text), 1, fixed.SHORT_ID_CHARS)
