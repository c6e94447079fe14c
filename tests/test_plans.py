"""What the physical plans look like, and that skew and failures do no harm."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from newsloom.operators import keys as K
from newsloom.operators import language as G
from newsloom.operators import quality as Q
from newsloom.plans import enrich as E
from newsloom.plans import reports as R


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return plan(df)


def test_scan_reads_only_what_is_asked_for(spark, small):
    text = plan(entry.queries()["scan_projected"](spark, small))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in text


def test_date_filter_reaches_the_scan(spark, small):
    text = plan(Q.date_range_filter(spark.read.parquet(f"{small}/events.parquet"), "ts", "2024-01-05", "2024-01-20"))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_filters_reach_the_scan_through_the_enrichment(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet").select(
        "doc_id", "source", F.col("text").alias("contenu"), F.col("text").alias("titre")
    )
    text = plan(E.enrich_articles(documents).where(F.col("source") == "src1"))
    assert "EqualTo(source,src1)" in text and "Exchange" not in text


def test_each_text_pass_is_planned_once(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    model = G.language_weights(G.train_language_profiles(documents, "text", "lang"), 4)
    rows = documents.select("doc_id", "source", F.col("text").alias("contenu"), F.col("text").alias("titre"))
    text = plan(E.enrich_articles(rows, model, model))
    assert text.count("translate(") <= 2  # the plain and the Hangul branch
    assert text.count("array_intersect") <= 5


@pytest.mark.parametrize("keep", [1, 15])
def test_first_rows_are_cut_down_before_the_shuffle(spark, keep):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    text = plan(K.most_recent(df, "k", keep, F.desc("id")))
    below = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_no_cartesian_products(spark, small):
    for name in ("anti_join_existing", "run_counters", "daily_volume", "origin_share", "nearest_category", "keyed_update"):
        text = plan(entry.queries()[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_a_hot_key_is_split_in_the_known_id_join(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        # A third of all rows share one id.
        ids = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.md5(F.col("id").cast("string")))
        batch = spark.range(0, 60_000, 1, 16).select(ids.alias("id_article"), F.sha2(F.col("id").cast("string"), 512).alias("pad"))
        known = spark.range(100).select(F.md5(F.col("id").cast("string")).alias("id_article"))
        df = K.new_only(batch, known)
        assert df.count() == 60_000 - sum(1 for i in range(100) if i % 3)
        df.collect()
        assert "skew=true" in plan(df)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_unique_known_ids_are_shuffled_once(spark):
    ids = spark.range(100).select(F.col("id").cast("string").alias("id_article"))
    text = plan(K.new_only(ids, ids, unique=True))
    assert "HashAggregate" not in text and K.new_only(ids, ids, unique=True).count() == 0


def test_counts_combine_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("k"))
    text = plan(R.count_by(df, "k"))
    assert text.index("HashAggregate") < text.index("Exchange") < text.rindex("HashAggregate")
    assert "partial_count" in text


def test_tables_are_scanned_once(spark, small):
    for name in ("origin_share", "category_share", "daily_share", "reenrich"):
        text = final_plan(entry.queries()[name](spark, small))
        final = text[: text.index("== Initial Plan ==")] if "== Initial Plan ==" in text else text
        assert final.count("FileScan") <= 1 + final.count("ReusedSubquery") + final.count("Subquery"), name
    text = plan(entry.queries()["reenrich"](spark, small))
    assert text.count("FileScan") == 1 and "Exchange" not in text


@pytest.mark.parametrize("name", ["keyword_hits", "clean_html_text", "enrich_articles", "word_ngrams"])
def test_texts_are_worked_on_where_they_are_scanned(spark, small, name):
    assert "RoundRobinPartitioning" not in plan(entry.queries()[name](spark, small))


def test_shares_need_no_window_over_all_groups(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("k"))
    text = plan(R.value_shares(df, "k"))
    assert "Window" not in text and "subquery" in text.lower()
