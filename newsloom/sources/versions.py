"""A table of data files in versions: readers see one version whole, writers add the next.

A version is a manifest: a Parquet table with a row for each data file and the lowest
and highest key in it, named by a small file that appears in one step.  Readers take
the last version there is.  Data files never change:

* ``replace`` and ``append`` write new files and a manifest that lists them;
* ``update`` and ``delete`` look for the files that hold the named keys, first by the
  key ranges in the manifest, then by reading the key column of those; only these
  files are written anew, without or with the change, and take the old ones' places.

A writer that fails leaves files that no version lists, and the table as it was.  When
two writers meet, one of them finds its version's name taken and starts again from the
version that was there first.  Rows are sorted by key over the files, so the ranges of
files written together do not overlap.  ``forget`` removes what later versions do not
need.

What the driver holds is the list of data files, as for any scan, and a bounded number
of key ranges.  A null key is found by no update or delete.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_
from time import time
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.operators import keys as K
from newsloom.sources import files as H

#: The changes of one call are looked up by at most so many ranges of their keys.
KEY_RANGES = 256
#: Times a writer starts again when others were faster.
TRIES = 5

#: Each write has a folder of its own; readers do not see this column.
LOAD = "_load"
_FILE = rf"({LOAD}=.*)$"


class NoVersionError(ValueError):
    """The table has no such version."""


class VersionedTable:
    """The versioned table at ``path``; ``key`` names the column that updates go by, ``by`` one that folders go by.

    Rows of one folder are brought together before they are written, unless ``gather``
    is off because they are together already.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: str | None = None, by: str | None = None, fmt: str = "parquet", gather: bool = True
    ):
        self.spark, self.path, self.key, self.by, self.fmt, self.gather = spark, path.rstrip("/"), key, by, fmt, gather
        self.data, self.log = f"{self.path}/_data", f"{self.path}/_versions"

    # --- versions ----------------------------------------------------------

    def versions(self) -> list[int]:
        """All versions, oldest first."""
        return sorted(int(name) for name in H.names_in(self.spark, self.log) if name.isdigit())

    def _entry(self, version: int | None) -> dict:
        every = self.versions()
        if not every or (version is not None and version not in every):
            raise NoVersionError(f"{self.path} has no version {version if version is not None else ''}".rstrip())
        number = every[-1] if version is None else version
        return {"version": number, **json.loads(H.read_text(self.spark, f"{self.log}/{number:012d}"))}

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, n, low, high) of a version's data files."""
        return self.spark.read.parquet(f"{self.log}/{self._entry(version)['files']}")

    def _open(self, files: Sequence[str], schema: StructType) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.data).format(self.fmt)
        return reader.load([f"{self.data}/{unquote(f)}" for f in sorted(files)]).drop(LOAD)

    def read(self, version: int | None = None, files: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, the last one if none is named; of some of its files if they are given."""
        entry = self._entry(version)
        if files is None:
            files = [r["file"] for r in self.spark.read.parquet(f"{self.log}/{entry['files']}").select("file").collect()]
        return self._open(files, StructType.fromJson(entry["schema"]))

    def folder(self, version: int | None = None) -> str:
        """The one folder of a version that ``replace`` made, for readers that want a plain path."""
        entry = self._entry(version)
        if entry["load"] is None:
            raise ValueError(f"version {entry['version']} of {self.path} is spread over several folders")
        return f"{self.data}/{entry['load']}"

    # --- writing -----------------------------------------------------------

    def _write(self, df: DataFrame) -> tuple[str, DataFrame]:
        """Write rows as new data files; their folder and their part of a manifest."""
        load = f"{LOAD}={uuid.uuid4().hex}"
        if self.by is not None:
            (df.hint("rebalance", self.by) if self.gather else df).write.partitionBy(self.by).format(self.fmt).save(f"{self.data}/{load}")
        else:
            ordered = df.repartitionByRange(self.key).sortWithinPartitions(self.key) if self.key else df
            ordered.write.format(self.fmt).save(f"{self.data}/{load}")
        written = self.spark.read.schema(df.schema).option("basePath", self.data).format(self.fmt).load(f"{self.data}/{load}")
        key = F.col(self.key) if self.key else F.lit(None).cast("string")
        file = F.regexp_extract("_metadata.file_path", _FILE, 1)
        # Of the files just written the key column is read, and the ranges are a row for each file.
        manifest = written.select(file.alias("file"), key.alias("_key")).groupBy("file").agg(
            F.count("*").alias("n"), F.min("_key").alias("low"), F.max("_key").alias("high")
        )
        place = f"{self.log}/files-{uuid.uuid4().hex}"
        manifest.write.parquet(place)
        return load, self.spark.read.schema(manifest.schema).parquet(place)

    def _publish(self, before: int, manifest: DataFrame, schema: StructType, load: str | None = None) -> int:
        """Make a manifest the version after ``before``; fails when there is one by now."""
        files = f"files-{uuid.uuid4().hex}"
        manifest.coalesce(1).write.parquet(f"{self.log}/{files}")
        entry = {"files": files, "schema": schema.jsonValue(), "load": load}
        H.publish_text(self.spark, f"{self.log}/{before + 1:012d}", json.dumps(entry))
        return before + 1

    def _change(self, step: Callable[[int], int | None]) -> int:
        """Run a step from the last version until no other writer is faster."""
        for left in reversed(range(TRIES)):
            before = max(self.versions(), default=0)
            try:
                after = step(before)
                return before if after is None else after
            except H.NameTakenError:
                if not left:
                    raise
        raise AssertionError("unreachable")

    def replace(self, df: DataFrame) -> int:
        """Make the rows of ``df`` the table; the number of its version."""
        load, written = self._write(df)
        return self._change(lambda before: self._publish(before, written, self._schema(df), load))

    def append(self, df: DataFrame) -> int:
        """Add the rows of ``df``, which has the table's columns."""
        _, written = self._write(df)

        def step(before: int) -> int:
            if not before:
                return self._publish(before, written, self._schema(df))
            return self._publish(before, self.manifest(before).unionByName(written), self.read(before, []).schema)

        return self._change(step)

    def _schema(self, df: DataFrame) -> StructType:
        """The columns in the order in which they are read back: a folder's column comes last."""
        if self.by is None:
            return df.schema
        return StructType([f for f in df.schema.fields if f.name != self.by] + [df.schema[self.by]])

    def keep_folders(self, values: Sequence[str]) -> int:
        """Take out the files of all folders but those of these values of ``by``."""
        folder = F.regexp_extract("file", f"/{self.by}=([^/]*)/", 1)

        def step(before: int) -> int | None:
            manifest = self.manifest(before)
            gone = manifest.where(~folder.isin(list(values)))
            return None if gone.isEmpty() else self._publish(before, manifest.where(folder.isin(list(values))), self.read(before, []).schema)

        return self._change(step)

    def folder_values(self) -> set[str]:
        """The values of ``by`` that the last version has files of; none for a table without versions."""
        if not self.versions():
            return set()
        rows = self.manifest().select(F.regexp_extract("file", f"/{self.by}=([^/]*)/", 1).alias("value")).distinct().collect()
        return {r["value"] for r in rows}

    # --- changes by key ----------------------------------------------------

    def candidates(self, version: int, keys: DataFrame) -> list[str]:
        """Files whose key range meets a range of the keys; no data file is read."""
        named = keys.where(F.col(self.key).isNotNull()).select(self.key)
        parts = named.repartitionByRange(KEY_RANGES, self.key).groupBy(F.spark_partition_id().alias("part"))
        ranges = parts.agg(F.min(self.key).alias("low"), F.max(self.key).alias("high")).collect()  # KEY_RANGES at most
        if not ranges:
            return []
        meets = [(F.col("low") <= F.lit(r["high"])) & (F.col("high") >= F.lit(r["low"])) for r in ranges]
        return [r["file"] for r in self.manifest(version).where(reduce(or_, meets)).select("file").collect()]

    def touched(self, version: int, keys: DataFrame) -> list[str]:
        """Files that hold one of the keys; of the candidates the key column is read."""
        found = self.candidates(version, keys)
        if not found:
            return []
        held = self.read(version, found).select(self.key, F.regexp_extract("_metadata.file_path", _FILE, 1).alias("file"))
        return [r["file"] for r in K.known_only(held, keys.select(self.key), self.key).select("file").distinct().collect()]

    def _rewrite(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> int:
        if self.key is None:
            raise ValueError("the table has no key")

        def step(before: int) -> int | None:
            if not before:
                raise NoVersionError(f"{self.path} has no version")
            files = self.touched(before, keys)
            if not files:
                return None
            old = self.read(before, files)
            _, written = self._write(change(old))
            kept = self.manifest(before).where(~F.col("file").isin(files))
            return self._publish(before, kept.unionByName(written), old.schema)

        return self._change(step)

    def update(self, updates: DataFrame, columns: Sequence[str], *order: str | Column) -> int:
        """Set ``columns`` on the rows that ``updates`` names (see ``operators.keys.keyed_update``)."""
        return self._rewrite(updates, lambda old: K.keyed_update(old, updates, self.key, columns, *order))

    def delete(self, keys: DataFrame) -> int:
        """Take out the rows whose key is in ``keys``."""
        return self._rewrite(keys, lambda old: K.delete_keys(old, keys, self.key))

    # --- many small files ----------------------------------------------------

    def _full_tier(self, version: int, fan: int) -> list[str]:
        """The files of the smallest size class that has ``fan`` files; class k has up to fan ** k rows a file."""
        tiers: dict[int, list[str]] = {}
        for row in self.manifest(version).select("file", "n").collect():
            tier = 0
            while fan**tier < row["n"]:
                tier += 1
            tiers.setdefault(tier, []).append(row["file"])
        return next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= fan), [])

    def merge(self, change: Callable[[DataFrame], DataFrame] = lambda rows: rows, fan: int = 8) -> int:
        """Replace small files by one of their rows together, as often as ``fan`` files have a size alike.

        ``change`` works on the rows that are merged, to drop those that others stand
        for.  Each row is merged once for each size class, and after n appends of a few
        rows there are about fan * log(n) files, each written once for each class.
        """

        def step(before: int) -> int | None:
            files = self._full_tier(before, fan) if before else []
            if not files:
                return None
            old = self.read(before, files)
            # A shuffle, so that what ``change`` adds up is added up in tasks of its own.
            _, written = self._write(change(old).repartition(1))
            kept = self.manifest(before).where(~F.col("file").isin(files))
            return self._publish(before, kept.unionByName(written), old.schema)

        last = -1
        while last != (now := self._change(step)):
            last = now
        return last

    # --- old versions ------------------------------------------------------

    def forget(self, keep: int = 2, hours: float = 24.0) -> list[str]:
        """Remove all but the last ``keep`` versions, and loads that those do not list; the loads' names.

        A load or manifest younger than ``hours`` stays: a writer may not have published it yet.
        """
        every = self.versions()
        kept = every[-max(keep, 1) :]
        for version in every[: -max(keep, 1)]:
            H.delete_folder(self.spark, f"{self.log}/{version:012d}")
        lists = {self._entry(v)["files"] for v in kept}
        used = set()
        for name in lists:
            loads = self.spark.read.parquet(f"{self.log}/{name}").select(F.regexp_extract("file", "^([^/]*)/", 1).alias("load"))
            used |= {r["load"] for r in loads.distinct().collect()}
        gone, limit = [], 1000 * (time() - 3600 * hours)
        for folder, needed in ((self.log, lists), (self.data, used)):
            for name in H.names_in(self.spark, folder):
                if name in needed or name.isdigit() or H.modified(self.spark, f"{folder}/{name}") > limit:
                    continue
                H.delete_folder(self.spark, f"{folder}/{name}")
                gone += [name] if folder == self.data else []
        return gone
