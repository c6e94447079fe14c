"""Page blocks (title, date, full text) to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import fixed_values as fixed
from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import ids as I
from newsloom.functions import text as T


def block_articles(blocks: DataFrame, run_time: Column) -> DataFrame:
    """Articles of ``(page_num, block_pos, titre, date_text, raw_text)``.

    The body is the block's text without any occurrence of its title and date.
    A missing date is the time of the run, as ISO text.  Position columns stay,
    so that repeats can be reduced to the first with ``keys.keep_first``.
    """
    source, kind, address = fixed.BLOCK_SOURCE
    titled = blocks.withColumns(
        {
            "titre": T.strip(F.col("titre")),
            "date_publication": F.coalesce(T.strip(F.col("date_text")), D.iso_text(run_time)),
        }
    )
    bare = F.replace(
        F.replace(T.strip(F.col("raw_text")), F.col("titre"), F.lit("")),
        F.col("date_publication"),
        F.lit(""),
    )
    cleaned = H.clean_html_text(titled.withColumn("contenu", T.strip(bare)), "contenu", "contenu")
    return cleaned.select(
        I.title_date_id(F.col("titre"), F.col("date_publication")).alias("id_article"),
        F.lit(source).alias("source"),
        F.lit(kind).alias("source_type"),
        "titre",
        "contenu",
        F.concat(F.lit(address + "#page-"), F.col("page_num").cast("string")).alias("url"),
        "date_publication",
        D.iso_text(run_time).alias("created_at"),
        "page_num",
        "block_pos",
    )
