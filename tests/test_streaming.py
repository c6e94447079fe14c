"""The streaming jobs: nothing twice, late rows dropped, same as batch."""

from pyspark.sql import functions as F
from pyspark.sql import types as t

from newsloom.operators import key_index as K
from newsloom.sources.versions import VersionedTable
from newsloom.streaming import ingest as I
from newsloom.streaming import volume as V

SCHEMA = t.StructType(
    [
        t.StructField("k", t.StringType()),
        t.StructField("ts", t.TimestampType()),
        t.StructField("n", t.LongType()),
    ]
)


def add(spark, folder, rows):
    df = spark.createDataFrame(rows, "k string, ts string, n long").withColumn("ts", F.col("ts").cast("timestamp"))
    df.coalesce(1).write.mode("append").parquet(folder)


def source(spark, folder, per_batch=None):
    reader = spark.readStream.schema(SCHEMA)
    return (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(folder)


def rows_of(spark, path):
    return sorted((r.k, r.n) for r in I.read_table(spark, path, SCHEMA).collect())


def test_every_key_once(spark, tmp_path):
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))

    def run():
        I.ingest_new(source(spark, folder, 1), table, check, "k", "n").awaitTermination()

    add(spark, folder, [("a", "2025-01-01", 2), ("a", "2025-01-01", 1), ("b", "2025-01-01", 3)])
    run()
    assert rows_of(spark, table) == [("a", 1), ("b", 3)]
    run()  # nothing new
    add(spark, folder, [("b", "2025-01-02", 0), ("c", "2025-01-02", 4)])
    run()
    assert rows_of(spark, table) == [("a", 1), ("b", 3), ("c", 4)]
    # A query with a new checkpoint sees all input again: nothing is added, nothing replaced.
    I.ingest_new(source(spark, folder), table, str(tmp_path / "new"), "k", "n").awaitTermination()
    assert rows_of(spark, table) == [("a", 1), ("b", 3), ("c", 4)]
    # Nor does one that only sees later input.
    later = str(tmp_path / "later")
    add(spark, later, [("d", "2025-01-03", 5), ("a", "2025-01-03", 6)])
    I.ingest_new(source(spark, later), table, str(tmp_path / "newer"), "k", "n").awaitTermination()
    assert rows_of(spark, table) == [("a", 1), ("b", 3), ("c", 4), ("d", 5)]
    assert "none" not in {r.query_id for r in I.read_table(spark, table, SCHEMA).collect()}


def test_a_batch_that_runs_again_adds_nothing(spark, tmp_path):
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))

    def run():
        I.ingest_new(source(spark, folder, 1), table, check, "k", "n").awaitTermination()

    add(spark, folder, [("a", "2025-01-01", 1)])
    run()
    add(spark, folder, [("a", "2025-01-02", 2), ("b", "2025-01-02", 3)])
    run()
    before = rows_of(spark, table)
    # As if the last batch had written its rows but not been marked as done.
    for mark in (tmp_path / "check" / "commits").glob("*1*"):
        mark.unlink()
    run()
    assert rows_of(spark, table) == before == [("a", 1), ("b", 3)]


def test_repeats_inside_the_watermark(spark, tmp_path):
    folder = str(tmp_path / "in")
    add(spark, folder, [("a", "2025-01-01", 1), ("a", "2025-01-01", 2), ("b", "2025-01-01", 3)])
    stream = I.without_repeats(source(spark, folder), "k", "ts", "1 day")
    stream.writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("firsts").count() == 2


def test_daily_counts_are_complete_and_drop_late_rows(spark, tmp_path):
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))

    def run():
        counts = V.daily_counts(source(spark, folder, 1), "ts", "k")
        V.write_daily_counts(counts, table, check, "k").awaitTermination()

    def days():
        schema = t.StructType().add("day", "date").add("k", "string").add("n", "long")
        rows = V.read_daily_counts(spark, table, schema, "k").collect()
        return sorted((str(r.day), r.k, r.n) for r in rows)

    add(spark, folder, [("a", "2025-01-01 10:00:00", 0), ("a", "2025-01-01 11:00:00", 0), ("a", "2025-01-04 00:00:00", 0)])
    run()
    assert days() == [("2025-01-01", "a", 2), ("2025-01-04", "a", 1)]
    # One row is later than the watermark, one is not and changes an open day.
    add(spark, folder, [("a", "2025-01-01 12:00:00", 0), ("a", "2025-01-04 09:00:00", 0), ("b", "2025-01-08 00:00:00", 0)])
    run()
    assert days() == [("2025-01-01", "a", 2), ("2025-01-04", "a", 2), ("2025-01-08", "b", 1)]


def test_files_of_daily_counts_stay_few(spark, tmp_path):
    """What readers read after many batches of one open day is what they read after a few."""
    table = VersionedTable(spark, str(tmp_path / "counts"))
    schema = t.StructType().add("day", "date").add("k", "string").add("n", "long")
    files = []
    for number in range(30):
        rows = spark.range(3).select(F.lit("2025-01-01").cast("date").alias("day"), F.concat(F.lit("k"), "id").alias("k"), F.lit(number + 1).cast("long").alias("n"))
        table.append(rows.withColumn(V.BATCH, F.lit(number).cast("long")).coalesce(1))
        table.merge(V._latest("k"), fan=4)
        files.append(table.manifest().count())
    assert max(files) <= 6
    got = V.read_daily_counts(spark, table.path, schema, "k").collect()
    assert sorted((r.k, r.n) for r in got) == [("k0", 30), ("k1", 30), ("k2", 30)]
    # A batch that runs again adds rows that change nothing.
    table.append(rows.withColumn(V.BATCH, F.lit(29).cast("long")))
    assert sorted((r.k, r.n) for r in V.read_daily_counts(spark, table.path, schema, "k").collect()) == [("k0", 30), ("k1", 30), ("k2", 30)]


def test_a_batch_reads_only_folders_that_can_hold_its_keys(spark, tmp_path):
    """A table of 200 folders with 2,000 keys each, and a batch of 1,000 keys."""
    table = str(tmp_path / "table")
    rows = spark.range(400_000).select(
        F.concat(F.lit("k"), "id").alias("k"), F.lit(None).cast("timestamp").alias("ts"), F.col("id").alias("n"),
        F.lit("q").alias(I.QUERY), (F.col("id") / 2000).cast("long").alias(I.BATCH),
    )
    rows.repartition(4, I.BATCH).write.partitionBy(I.QUERY, I.BATCH).parquet(table)
    every = I.folders_of(I.read_table(spark, table, SCHEMA))
    assert every == {("q", n) for n in range(200)}
    new = spark.range(1000).select(F.concat(F.lit("new"), "id").alias("k"))
    # Without filters everything is read.
    assert I.folders_of(I.known_part(spark, table, SCHEMA, new, "k")) == every
    I.index_table(spark, table, SCHEMA, "k")
    assert I.known_part(spark, table, SCHEMA, new, "k").count() == 0 or len(I.folders_of(I.known_part(spark, table, SCHEMA, new, "k"))) <= 20
    some = new.union(spark.createDataFrame([("k1",), ("k2",), ("k399999",), (None,)], "k string"))
    part = I.known_part(spark, table, SCHEMA, some, "k")
    folders = I.folders_of(part)
    assert {("q", 0), ("q", 199)} <= folders and len(folders) <= 20
    assert part.where("k IN ('k1', 'k2', 'k399999')").count() == 3
    # The key column and the folders are all that is read.
    scan = part.select("k")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:string>" in scan


def test_a_folder_without_a_whole_filter_is_read(spark, tmp_path):
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))
    add(spark, folder, [(f"k{n}", "2025-01-01 10:00:00", n) for n in range(50)])
    I.ingest_new(source(spark, folder), table, check, "k", "n").awaitTermination()
    asked = spark.createDataFrame([("other",)], "k string")
    assert I.folders_of(I.known_part(spark, table, SCHEMA, asked, "k")) == {("none", -1)}
    # As if the batch had failed before its filter was written, or half way through.
    (mine,) = (tmp_path / "table" / "_keys").glob("query_id=*/batch_id=0")
    parts = sorted(mine.glob("*.parquet"))
    held = spark.read.parquet(str(mine)).where("block < 0").collect()
    assert len(held) == 1 and held[0]["keys"] == 50
    for part in parts:
        part.unlink()
    assert len(I.folders_of(I.known_part(spark, table, SCHEMA, asked, "k"))) == 2
    # A query with a new checkpoint sees all input again and adds nothing.
    I.ingest_new(source(spark, folder), table, str(tmp_path / "new"), "k", "n").awaitTermination()
    assert len(rows_of(spark, table)) == 50


def test_batches_without_new_keys_have_whole_filters(spark, tmp_path):
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))
    for _ in range(2):
        add(spark, folder, [("a", "2025-01-01", 1), (None, "2025-01-01", 2)])
        I.ingest_new(source(spark, folder), table, check, "k", "n").awaitTermination()
    whole = K.whole_filters(I.read_index(spark, table), I.QUERY, I.BATCH)
    assert whole.count() == 2


def test_filters_have_no_false_negatives_and_few_false_positives(spark):
    sizes = {0: 0, 1: 1, 2: K.KEYS_PER_BLOCK, 3: K.KEYS_PER_BLOCK + 1, 4: 20_000}
    keys = spark.range(30_000).select(F.explode(F.array(*[F.lit(f) for f in sizes])).alias("f"), F.col("id"))
    keys = keys.where(F.expr(f"id < element_at(map({', '.join(f'{a}, {b}' for a, b in sizes.items())}), f)")).withColumn("k", F.concat("f", F.lit("-"), "id"))
    folders = spark.createDataFrame([(f,) for f in sizes], "f int")
    index = K.filters_of(keys, "k", folders).cache()
    assert {r["f"]: (r["level"], r["keys"]) for r in index.where("block = -1").collect()} == {
        0: (0, 0), 1: (0, 1), 2: (0, K.KEYS_PER_BLOCK), 3: (1, K.KEYS_PER_BLOCK + 1), 4: (4, 20_000)
    }
    assert K.whole_filters(index, "f").count() == 5
    for f in (1, 2, 3, 4):
        one = keys.where(F.col("f") == f).limit(1)
        assert f in {r["f"] for r in K.folders_with(index, one, "k", "f").collect()}
    # Each key is told apart by a folder column of its own.
    alone = index.where("f = 4").drop("f").withColumn("f", F.lit(4))
    strangers = spark.range(20_000).select(F.concat(F.lit("x"), "id").alias("k"))
    assert K.folders_with(alone, strangers.limit(1000), "k", "f").count() <= 1
    index.unpersist()


def test_the_parts_of_the_state_are_tasks_of_their_own(spark, tmp_path, monkeypatch):
    """One task that reads all parts keeps the buffers of all their aggregations until it ends."""
    folder, table, check = (str(tmp_path / x) for x in ("in", "table", "check"))
    add(spark, folder, [(k, f"2025-01-{d:02d} 10:00:00", 0) for k in "abc" for d in range(1, 9)])
    plans, append = [], VersionedTable.append

    def seen(self, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return append(self, df)

    monkeypatch.setattr(VersionedTable, "append", seen)
    counts = V.daily_counts(source(spark, folder), "ts", "k")
    V.write_daily_counts(counts, table, check, "k").awaitTermination()
    assert len(plans) > 1 and not any("Coalesce" in p for p in plans) and all("SinglePartition" in p or "REPARTITION_BY_NUM" in p for p in plans[1:])
    assert VersionedTable(spark, table).manifest().where("n > 0").count() == 1
    schema = t.StructType().add("day", "date").add("k", "string").add("n", "long")
    assert V.read_daily_counts(spark, table, schema, "k").count() == 24
