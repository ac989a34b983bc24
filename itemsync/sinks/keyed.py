"""A keyed table that takes upserts and deletes as commits of plain parquet.

Layout: ``base`` holds one row per key, ``changes`` what later commits did, both
in folders by commit and attempt; ``log`` gets one row when a commit is done,
naming the attempt. Nothing is overwritten: a repeated commit writes another
attempt, and the last attempt in the log counts. Rows of attempts that broke off
are never read.

The table gives out commit numbers. A commit belongs to its ``writer``, a name
that stays the same when a run is repeated: the same writer gets its number
again, and a number of another writer is refused. The log remembers writers for
good, so a writer's commit that a base holds already is done: repeating it writes
nothing. Other numbers at or below a base are refused.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from itemsync.operators.dedup import latest_computed, met
from itemsync.sources.tables import read_or_empty

UPSERT, DELETE = "upsert", "delete"
BASE, CHANGES = "base", "changes"
LOG = "kind STRING, commit BIGINT, attempt STRING, writer STRING, place BIGINT"


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, schema: str, key: list[str], order: list[str] | None = None):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.fields = spark.createDataFrame([], schema).schema.fields
        self.key, self.order = key, order or []

    def create(self) -> None:
        """Declare the table; an existing one is left alone."""
        if not self._log():
            self._finish(self.spark.createDataFrame([], self.schema), BASE, 0, "create")

    def upsert(self, rows: DataFrame, commit: int | None = None, writer: str = "") -> int:
        """Insert or replace by key; of several rows with one key the latest is taken. Returns the commit."""
        return self.change(rows, None, commit, writer)

    def delete(self, keys: DataFrame, commit: int | None = None, writer: str = "") -> int:
        return self.change(None, keys, commit, writer)

    def change(
        self, upserts: DataFrame | None, deletes: DataFrame | None, commit: int | None = None, writer: str = ""
    ) -> int:
        """Delete keys, then upsert rows, as one commit. Returns its number.

        Nothing is computed or written for a commit that a base holds already.
        """
        done = self._done()
        commit = self._number(done, commit, writer)
        if commit <= self._base(done):
            return commit
        rows = None
        if upserts is not None:
            named = upserts.select(*[field.name for field in self.fields])
            rows = latest_computed(named, self.key, self.order).withColumn("op", F.lit(UPSERT))
        if deletes is not None:
            blank = {f.name: F.lit(None).cast(f.dataType) for f in self.fields if f.name not in self.key}
            gone = deletes.select(*self.key).distinct()
            if rows is not None:
                gone = gone.join(rows.select(*self.key), self.key, "left_anti")
            gone = gone.withColumns({**blank, "op": F.lit(DELETE)})
            rows = gone if rows is None else rows.unionByName(gone)
        self._finish(rows, CHANGES, commit, writer)
        return commit

    def number(self, commit: int | None, writer: str) -> int:
        """The commit number of a writer: the asked-for one, its own, or the next free one."""
        return self._number(self._done(), commit, writer)

    def _number(self, done: dict, commit: int | None, writer: str) -> int:
        if commit is None:
            own = [n for n, row in done.items() if row["writer"] == writer and writer]
            commit = own[0] if own else max(done, default=0) + 1
        folded = commit in done and done[commit]["kind"] == CHANGES and done[commit]["writer"] == writer and writer
        if commit <= self._base(done) and not folded:
            raise ValueError(f"commit {commit} is not above the base of {self.path}")
        if commit not in done and commit < max(done, default=0):
            raise ValueError(f"commit {commit} of {self.path} would come before one that is done")
        if commit in done and done[commit]["writer"] != writer:
            raise ValueError(f"commit {commit} of {self.path} belongs to {done[commit]['writer']!r}, not to {writer!r}")
        return commit

    def changes(self, commit: int) -> DataFrame:
        """What one commit wrote."""
        attempt = self._done()[commit]["attempt"]
        return self.spark.read.schema(self.schema + ", op STRING").parquet(self._folder(CHANGES, commit, attempt))

    def read(self, before: int | None = None, keys: DataFrame | None = None) -> DataFrame:
        """The current rows, or those as of all commits below ``before``; with ``keys`` only rows of these.

        A run reads the state before its own commit, so it may be repeated. Only
        the keys of changes since the base meet the base, in an anti join that is
        broadcast while they are few; the base itself is not shuffled then.
        Each commit is one folder to read until ``compact`` folds them, which
        whoever runs the jobs calls from time to time. ``keys`` are looked up before
        anything is shuffled, so that a small batch does not move the table.
        """
        done = {n: row for n, row in self._done().items() if before is None or n < before}
        base = self._base(done)
        rows = self.spark.createDataFrame([], self.schema)
        if base in done:
            rows = self.spark.read.schema(self.schema).parquet(self._folder(BASE, base, done[base]["attempt"]))
        if keys is not None:
            rows = met(rows, keys, self.key, "left_semi")
        later = sorted(n for n, row in done.items() if n > base and row["kind"] == CHANGES)
        if not later:
            return rows
        # one scan however many commits there are, so that a plan does not grow with them
        folders = [self._folder(CHANGES, n, done[n]["attempt"]) for n in later]
        marked = self.spark.read.schema(self.schema + ", op STRING, commit BIGINT, attempt STRING")
        recent = marked.option("basePath", f"{self.path}/{CHANGES}").parquet(*folders).drop("attempt")
        if keys is not None:
            recent = met(recent, keys, self.key, "left_semi")
        latest = latest_computed(recent, self.key, ["commit"])
        kept = rows.join(latest.select(*self.key), self.key, "left_anti")
        return kept.unionByName(latest.filter(F.col("op") == UPSERT).drop("op", "commit"))

    def compact(self, commit: int | None = None) -> int:
        """Fold all finished changes below ``commit`` (default: all, under the next number) into a new base."""
        commit = self.number(None, "") if commit is None else self.number(commit, "compact")
        self._finish(self.read(commit), BASE, commit, "compact")
        return commit

    def _folder(self, kind: str, commit: int, attempt: str) -> str:
        return f"{self.path}/{kind}/commit={commit}/attempt={attempt}"

    def _log(self) -> list:
        """A row per finished attempt: as many as there were commits and repeats."""
        return read_or_empty(self.spark, f"{self.path}/log", LOG).collect()

    def _done(self) -> dict:
        """Finished commits with their last attempt."""
        out: dict = {}
        for row in sorted(self._log(), key=lambda r: r["place"]):
            out[row["commit"]] = row
        return out

    @staticmethod
    def _base(done: dict) -> int:
        return max((n for n, row in done.items() if row["kind"] == BASE), default=0)

    def _finish(self, rows: DataFrame, kind: str, commit: int, writer: str) -> None:
        attempt = uuid.uuid4().hex
        rows.write.parquet(self._folder(kind, commit, attempt))
        mark = [(kind, commit, attempt, writer, len(self._log()))]
        self.spark.createDataFrame(mark, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")


def upserted(target: DataFrame, rows: DataFrame, key: list[str], order: list[str] | None = None) -> DataFrame:
    """The target after an upsert, as one plan; of several rows with one key the last by ``order``."""
    latest = latest_computed(rows, key, order or [])
    return target.join(latest.select(*key), key, "left_anti").unionByName(latest)


def removed(target: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """The target after a delete, as one plan."""
    return target.join(keys.select(*key).distinct(), key, "left_anti")
