"""Versioned tables: only touched files are rewritten, readers see one version whole."""

import pytest
from pyspark.sql import functions as F

from newsloom.sources import files as H
from newsloom.sources.versions import NoVersionError, VersionedTable


@pytest.fixture
def numbers(spark):
    return spark.range(4000).select(F.format_string("k%05d", "id").alias("k"), F.col("id").alias("n"), (F.col("id") % 7).alias("m"))


@pytest.fixture
def table(spark, tmp_path, numbers):
    made = VersionedTable(spark, str(tmp_path / "table"), key="k")
    made.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    made.replace(numbers)
    made.spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    return made


def files(table, version=None):
    return {r["file"] for r in table.manifest(version).collect()}


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replace_and_read(table, numbers, spark):
    assert table.versions() == [1] and rows(table.read()) == rows(numbers)
    assert table.replace(numbers.where("n < 10")) == 2
    assert rows(table.read()) == rows(numbers.where("n < 10"))
    assert rows(table.read(1)) == rows(numbers)
    with pytest.raises(NoVersionError):
        table.read(3)
    with pytest.raises(NoVersionError):
        VersionedTable(spark, table.path + "-none").read()


def test_ranges_of_files_do_not_overlap(table):
    ranges = sorted((r["low"], r["high"], r["n"]) for r in table.manifest().collect())
    assert len(ranges) >= 4 and sum(n for _, _, n in ranges) == 4000
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_update_rewrites_only_files_that_hold_the_keys(table, numbers, spark):
    before = files(table)
    changes = spark.createDataFrame([("k00003", 1, -1), ("k00003", 2, -2), ("k00004", 1, -3), ("nowhere", 1, 0), (None, 1, 0)], "k string, step int, n long")
    assert len(table.candidates(1, changes)) < len(before)
    held = table.touched(1, changes)
    assert len(held) == 1
    assert table.update(changes, ["n"], "step") == 2
    assert before - files(table) == set(held)
    wanted = {"k00003": -2, "k00004": -3}
    assert rows(table.read()) == sorted((r["k"], wanted.get(r["k"], r["n"]), r["m"]) for r in numbers.collect())
    assert rows(table.read(1)) == rows(numbers)


def test_delete_and_append(table, numbers, spark):
    gone = spark.createDataFrame([("k00010",), ("k03999",), ("x",), (None,)], "k string")
    before = files(table)
    assert table.delete(gone) == 2 and len(before - files(table)) == 2
    assert table.read().count() == 3998
    assert table.append(numbers.where("n = 10").select("m", "k", "n").select("k", "n", "m")) == 3
    assert rows(table.read().where("k IN ('k00010', 'k03999')")) == [("k00010", 10, 3)]
    # Keys that are nowhere change nothing.
    assert table.delete(spark.createDataFrame([("x",), (None,)], "k string")) == 3
    assert table.versions() == [1, 2, 3]


def test_a_whole_file_may_go(table, numbers, spark):
    low = table.manifest().orderBy("low").first()
    assert table.delete(numbers.where(F.col("k") <= low["high"]).select("k")) == 2
    assert low["file"] not in files(table) and table.read().count() == 4000 - low["n"]
    table.delete(numbers.select("k"))
    assert table.read().count() == 0 and table.read().columns == ["k", "n", "m"]


def test_a_failed_write_leaves_the_old_version(table, numbers):
    broken = numbers.withColumn("n", F.when(F.col("n") == 3999, F.raise_error("lost")).otherwise(F.col("n")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert table.versions() == [1] and rows(table.read()) == rows(numbers)


def test_a_reader_keeps_the_version_it_began_with(table, numbers):
    reader = table.read()
    table.replace(numbers.where("n < 5"))
    assert reader.count() == 4000 and table.read().count() == 5


def test_the_slower_of_two_writers_starts_again(table, numbers, spark, monkeypatch):
    publish, met = table._publish, []

    def slow(before, manifest, schema):
        if not met:  # another writer is faster, once
            met.append(before)
            VersionedTable(spark, table.path, key="k").delete(numbers.where("n < 5").select("k"))
        return publish(before, manifest, schema)

    monkeypatch.setattr(table, "_publish", slow)
    assert table.update(spark.createDataFrame([("k00008", -8)], "k string, n long"), ["n"]) == 3
    assert table.read().count() == 3995 and table.read().where("n = -8").count() == 1


def test_a_name_is_taken_once(spark, tmp_path):
    path = str(tmp_path / "names" / "one")
    H.publish_text(spark, path, "a\né")
    with pytest.raises(H.NameTakenError):
        H.publish_text(spark, path, "b")
    assert H.read_text(spark, path) == "a\né"
    assert [n for n in H.names_in(spark, str(tmp_path / "names")) if not n.startswith(".")] == ["one"]
    assert H.names_in(spark, str(tmp_path / "nothing")) == []


def test_folders_by_a_column(spark, tmp_path, numbers):
    made = VersionedTable(spark, str(tmp_path / "by"), key="k", by="m")
    odd = numbers.select("m", "k", "n").withColumn("m", F.when(F.col("m") == 0, "a b/c=%1").when(F.col("m") > 1, F.col("m").cast("string")))
    made.replace(odd)
    assert made.read().columns == ["k", "n", "m"]
    assert rows(made.read().fillna("-")) == rows(odd.select("k", "n", "m").fillna("-"))
    made.update(spark.createDataFrame([("k00007", -7)], "k string, n long"), ["n"])
    assert made.read().where("k = 'k00007'").collect() == [("k00007", -7, "a b/c=%1")]
    assert "PartitionFilters: [isnotnull(m" in made.read().where("m = '3'")._jdf.queryExecution().executedPlan().toString()


def test_json_files(spark, tmp_path, numbers):
    made = VersionedTable(spark, str(tmp_path / "json"), fmt="json")
    made.replace(numbers)
    made.append(numbers)
    assert rows(made.read()) == sorted(rows(numbers) * 2)
    with pytest.raises(ValueError):
        made.delete(numbers)


def test_forget(table, numbers, spark):
    table.update(spark.createDataFrame([("k00003", -1)], "k string, n long"), ["n"])
    table.replace(numbers.where("n < 10"))
    assert table.forget(keep=1) == []  # everything is young
    gone = table.forget(keep=1, hours=-1.0)
    assert len(gone) == 2 and table.versions() == [3] and table.read().count() == 10
