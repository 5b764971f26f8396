"""A keyed Parquet table: immutable unique folders and one pointer.

Plain Parquet has no MERGE, and a plan must never read and overwrite the
same path. Every write of this table goes to new folders
``data/day=<day>/attempt=<unique>``; a *version* then lists the (day,
attempt) folders that make up the table. Readers take the highest version
whose listing is complete, so a write that fails, is repeated or races with a
reader leaves the table as it was. Nothing is ever overwritten.

A write may carry a *commit*, the pair (writer, batch): the listing keeps the
last batch of each writer, and a batch that is in the table already is not
applied again. Versions count the table's own writes, whoever made them, so
batch runs, several streams and a stream that starts anew (another writer) can
share a table. (A caller may still name the ``version`` itself: the write then
merges into the version before it.)

A merge reads and writes the days of its batch only (of epoch milliseconds, or
of a date column; a folder may hold ``unit_days`` of them). Tables without a time
column have one day, 0. Listings beyond the last ``keep`` versions that are
also older than ``retain_hours``, and the folders that only they name, are
deleted after a write. One write at a time is assumed.

Where a table format with MERGE (Delta, Iceberg) is available, use its
``MERGE INTO`` instead; the semantics in ``tickroll.operators.merge`` are the
same.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickroll.operators import merge as M
from tickroll.session import stage

KEEP = 20
NO_DAY = "__HIVE_DEFAULT_PARTITION__"     # Spark's folder name for a NULL partition value
LISTING = "day string, attempt string, schema string, commits string"


def _done(commits: dict[str, int], commit: tuple[str, int] | None) -> bool:
    return commit is not None and commits.get(commit[0], -1) >= commit[1]


def _with(commits: dict[str, int], commit: tuple[str, int] | None) -> dict[str, int]:
    return commits if commit is None else {**commits, commit[0]: commit[1]}


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, keys, ts_col: str | None = None, keep: int = KEEP,
                 retain_hours: float = 0, unit_days: int = 1):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = list(keys)
        self.ts_col = ts_col
        self.keep = keep
        self.retain_hours = retain_hours
        self.unit_days = unit_days

    # ------------------------------------------------------------ listings
    def _files(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self) -> list[str]:
        """Complete listings, oldest first (a folder name each; at most a few more than ``keep``)."""
        fs, root = self._files(f"{self.path}/versions")
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        return sorted(n for n in names if fs.exists(self._files(f"{self.path}/versions/{n}/_SUCCESS")[1]))

    def versions(self) -> list[int]:
        """Version numbers that can be read."""
        return sorted({int(n.split("-")[0]) for n in self._names()})

    def current(self, before: int | None = None) -> int | None:
        """Highest version (below ``before`` when given)."""
        return max((v for v in self.versions() if before is None or v < before), default=None)

    def _listing(self, version: int | None) -> tuple[list[tuple[str, str]], T.StructType | None]:
        """((day, attempt) pairs, schema) of a version; of several attempts at one, the last name's."""
        return self._state(version)[:2]

    def _state(self, version: int | None) -> tuple[list[tuple[str, str]], T.StructType | None, dict[str, int]]:
        """((day, attempt) pairs, schema, last batch by writer) of a version."""
        if version is None:
            return [], None, {}
        name = [n for n in self._names() if int(n.split("-")[0]) == version][-1]
        rows = self.spark.read.schema(LISTING).parquet(f"{self.path}/versions/{name}").collect()
        head = next(r for r in rows if r["schema"])
        return (sorted((r["day"], r["attempt"]) for r in rows if r["attempt"]),
                T.StructType.fromJson(json.loads(head["schema"])), json.loads(head["commits"] or "{}"))

    def committed(self, writer: str) -> int | None:
        """The last batch of a writer that is in the table."""
        return self._state(self.current())[2].get(writer)

    def _publish(self, entries: list[tuple[str, str]], schema: T.StructType, version: int, commits: dict[str, int]) -> None:
        rows = [(d, a, None, None) for d, a in entries] + [(None, None, schema.json(), json.dumps(commits))]
        self.spark.createDataFrame(rows, LISTING).coalesce(1).write.parquet(
            f"{self.path}/versions/{version:012d}-{uuid.uuid4().hex[:8]}")
        self._expire()

    def _expire(self) -> None:
        """Delete old listings and the folders that no kept listing names."""
        names = self._names()
        keep = sorted({int(n.split("-")[0]) for n in names})[-self.keep:]
        before = (time.time() - self.retain_hours * 3600) * 1000
        old = [n for n in names if int(n.split("-")[0]) not in keep and self._written_ms(n) <= before]
        if not old:
            return
        read = lambda some: {(r["day"], r["attempt"]) for r in self.spark.read.schema(LISTING).parquet(
            *[f"{self.path}/versions/{n}" for n in some]).where("attempt is not null").distinct().collect()}
        gone = read(old) - read([n for n in names if n not in old])
        for path in [*(f"data/day={d}/attempt={a}" for d, a in gone), *(f"versions/{n}" for n in old)]:
            fs, p = self._files(f"{self.path}/{path}")
            fs.delete(p, True)

    def _written_ms(self, name: str) -> int:
        fs, p = self._files(f"{self.path}/versions/{name}")
        return fs.getFileStatus(p).getModificationTime()

    # --------------------------------------------------------------- reads
    def _day(self, schema: T.StructType) -> Column:
        if not self.ts_col:
            return F.lit(0)
        if isinstance(schema[self.ts_col].dataType, T.DateType):
            return F.expr(f"unix_date(`{self.ts_col}`) div {self.unit_days}").cast("int")
        return F.expr(f"`{self.ts_col}` div {86_400_000 * self.unit_days}").cast("int")

    def _frame(self, entries: list[tuple[str, str]], schema: T.StructType) -> DataFrame:
        if not entries:
            empty = self.spark.createDataFrame([], schema)
            return empty.withColumn("day", F.lit(None).cast("int")) if self.ts_col else empty
        df = (self.spark.read.schema(schema).option("basePath", f"{self.path}/data")
              .parquet(*[f"{self.path}/data/day={d}/attempt={a}" for d, a in entries]).drop("attempt"))
        return df if self.ts_col else df.drop("day")

    def read(self, version: int | None = None, days: tuple[int, int] | None = None) -> DataFrame | None:
        """The table (with its ``day`` if it has a time column); ``days`` opens those folders only. None before the first write."""
        entries, schema = self._listing(self.current() if version is None else version)
        if schema is None:
            return None
        if days is not None:
            first, last = (d // self.unit_days for d in days)
            entries = [(d, a) for d, a in entries if d != NO_DAY and first <= int(d) <= last]
        return self._frame(entries, schema)

    # -------------------------------------------------------------- writes
    def _write(self, df: DataFrame) -> list[tuple[str, str]]:
        """Write rows as a new attempt; returns its folders."""
        attempt = "a" + uuid.uuid4().hex
        (df.withColumn("day", self._day(df.schema)).withColumn("attempt", F.lit(attempt))
         .write.mode("append").partitionBy("day", "attempt").parquet(f"{self.path}/data"))
        fs, pattern = self._files(f"{self.path}/data/day=*/attempt={attempt}")
        found = fs.globStatus(pattern) or []
        return [(s.getPath().getParent().getName()[len("day="):], attempt) for s in found]

    def _next(self, version: int | None) -> int:
        return (self.current() or 0) + 1 if version is None else version

    def replace(self, df: DataFrame, version: int | None = None, commit: tuple[str, int] | None = None) -> int:
        """The whole table anew (truncate, then load); an empty frame empties it."""
        version = self._next(version)
        commits = self._state(self.current(before=version))[2]
        if _done(commits, commit):
            return self.current()
        df = df.drop("day") if self.ts_col else df
        self._publish(self._write(df), df.schema, version, _with(commits, commit))
        return version

    def merge(self, batch: DataFrame, policy: str = "update", order: str | None = None, keep: str | None = None,
              unique: bool = False, version: int | None = None, mapped=None,
              commit: tuple[str, int] | None = None) -> DataFrame:
        """Merge ``batch`` into the version before ``version`` (the current one by default).

        Rows that share a key are reduced by ``order`` first; without one the
        caller says that keys are ``unique``. Returns the rows that the merge
        wrote for the batch (inserted and updated), read from the staged batch;
        none if the table has its ``commit`` already.
        """
        M.check_policy(policy)
        if order is None and not unique:
            raise ValueError("merge needs an order for rows that share a key (or unique=True)")
        version = self._next(version)
        entries, schema, commits = self._state(self.current(before=version))
        if _done(commits, commit):
            columns = list(mapped) if mapped else [c for c in batch.columns if c not in (order, "day")]
            return self.spark.createDataFrame([], batch.select(*columns).schema)
        commits = _with(commits, commit)
        if order is not None:
            batch = M.dedupe(batch, self.keys, order, keep or ("last" if policy == "update" else "first"))
        columns = list(mapped) if mapped else [c for c in batch.columns if c not in (order, "day")]
        rows = stage(batch.select(*columns), "merge-batch")
        if schema is None:
            self._publish(self._write(rows), rows.schema, version, commits)
            return rows
        days = {NO_DAY if r[0] is None else str(r[0]) for r in rows.select(self._day(rows.schema).alias("d")).distinct().collect()}
        touched = [(d, a) for d, a in entries if d in days]
        target = self._frame(touched, schema).select(*schema.fieldNames())
        if policy == "update":
            merged = M.upsert_update(target, rows, self.keys, order=None)
            entries = [e for e in entries if e not in touched] + self._write(merged)
        else:
            # an insert adds folders and leaves the stored ones as they are
            rows = stage(M.align(rows.join(target.select(*self.keys), self.keys, "left_anti"), schema), "merge-inserts")
            entries = entries + self._write(rows)
        self._publish(entries, schema, version, commits)
        return rows
