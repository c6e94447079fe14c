"""Chat messages to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import ids as I
from newsloom.functions import text as T


def message_articles(
    messages: DataFrame, run_time: Column, text: str = "text", meta: str | None = None
) -> DataFrame:
    """Articles of chat messages; the other columns stay.

    The first line is the title, the rest the content; a message of one line is
    both.  The date is the message's meta text, or the time of the run.
    """
    source, kind = fixed.MESSAGE_SOURCE
    now = D.iso_text(run_time)
    stamp = F.coalesce(F.nullif(F.col(meta), F.lit("")), now) if meta else now
    full = messages.withColumn("_full", T.strip(F.col(text))).where(
        T.has_length(F.col(text), fixed.MIN_MESSAGE_LENGTH)
    )
    line = F.substring_index("_full", "\n", 1)
    rest = T.strip(F.substring(F.col("_full"), F.length(line) + 2, F.length("_full")))
    shaped = full.withColumns(
        {
            "_title": T.strip(line),
            "contenu": F.coalesce(F.nullif(rest, F.lit("")), F.col("_full")),
            "date_publication": stamp,
        }
    )
    cleaned = H.clean_html_text(shaped, "contenu", "contenu")
    others = [c for c in messages.columns if c not in (text, meta)]
    return cleaned.select(
        *others,
        I.short_title_date_id(F.col("_title"), F.col("date_publication")).alias("id_article"),
        F.lit(source).alias("source"),
        F.lit(kind).alias("source_type"),
        F.substring("_title", 1, fixed.TITLE_CHARS).alias("titre"),
        "contenu",
        "date_publication",
        now.alias("created_at"),
    )
