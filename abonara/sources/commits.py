"""Saved periods with a commit record each: what was written, from what, with which parameters.

Every run of a period writes a folder of its own and then appends one commit row. Readers take the
latest committed run of each period, so rows of a lost or killed run are never seen, and a re-run
replaces a period in one step. A commit names the runs it read. A period is *stale* when one of
them has been replaced since, or is stale itself; a later script that needs it is refused until it
is run again. Everything goes through Spark's readers and writers, so any store that Spark reaches
will do.

The driver sees commit rows only: one per run, whatever the size of the tables.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Mapping
from datetime import date
from typing import NamedTuple
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

_SCHEMA = ("name STRING, period DATE, run STRING, at LONG, rows LONG, parameters STRING, columns STRING, "
           "inputs ARRAY<STRUCT<name: STRING, period: DATE, run: STRING>>")


class NotReady(ValueError):
    """A period is missing or stale."""


class Commit(NamedTuple):
    name: str
    period: date
    run: str
    at: int
    rows: int
    parameters: dict
    columns: str
    inputs: tuple[tuple[str, date, str], ...]


class PeriodStore:
    """Tables by period below one folder of a shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._log = f"{path}/commits"
        # The folder must be there to be read; an empty append makes it and changes nothing else.
        spark.createDataFrame([], _SCHEMA).write.mode("append").parquet(self._log)

    def _folder(self, name: str, period: date, run: str) -> str:
        return f"{self.path}/{name}/period={period}/run={run}"

    def commits(self) -> dict[tuple[str, date], Commit]:
        """The latest commit of every table and period."""
        latest: dict[tuple[str, date], Commit] = {}
        for row in self.spark.read.schema(_SCHEMA).parquet(self._log).collect():
            key = row.name, row.period
            if key not in latest or (row.at, row.run) > latest[key][3:1:-1]:
                inputs = tuple(tuple(i) for i in row.inputs)
                latest[key] = Commit(*key, row.run, row.at, row.rows, json.loads(row.parameters), row.columns, inputs)
        return latest

    def problems(self, name: str, period: date, commits: Mapping | None = None) -> list[str]:
        """Why the period may not be read: never committed, or built from runs that are not the latest."""
        commits = self.commits() if commits is None else commits
        commit = commits.get((name, period))
        if commit is None:
            return [f"{name} {period} has no finished run"]
        found, seen, todo = [], {(name, period)}, [commit]
        while todo:
            for of, when, run in todo.pop().inputs:
                now = commits.get((of, when))
                if now is None or now.run != run:
                    found.append(f"{name} {period} is stale: {of} {when} was run again")
                elif (of, when) not in seen:
                    seen.add((of, when))
                    todo.append(now)
        return found

    def save(self, name: str, period: date, rows: DataFrame, inputs: Iterable[tuple[str, date]] = (),
             parameters: Mapping | None = None, replace: bool = True) -> bool:
        """Write a period and commit it; tells whether it wrote.

        ``inputs`` are the saved periods that ``rows`` was computed from; missing and stale ones are
        refused, and with the run named (see :meth:`runs`) also one replaced since it was read. Without ``replace`` a period that is committed, fresh and has the same parameters
        is left alone, and ``rows`` is not computed.
        """
        commits, parameters, inputs = self.commits(), dict(parameters or {}), list(inputs)
        used = self._used(inputs, commits)
        old = commits.get((name, period))
        if not replace and old is not None and old.parameters == parameters and not self.problems(name, period, commits):
            return False
        run, seen = uuid4().hex, Observation()
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(self._folder(name, period, run))
        # An input replaced while the rows were written makes this run stale, not wrong.
        self._commit([(name, period, run, time.time_ns(), seen.get["rows"], json.dumps(parameters, sort_keys=True),
                       rows.schema.json(), used)])
        return True

    def save_all(self, name: str, rows: DataFrame, inputs: Iterable[tuple[str, date]] = (),
                 parameters: Mapping | None = None) -> list[date]:
        """Write and commit every ``period`` found in ``rows`` with one job; returns the periods.

        Other periods of the table stay as they are. All periods are committed at once: readers see
        none of them or all.
        """
        run = uuid4().hex
        used = self._used(list(inputs), self.commits())
        found = rows.withColumn("run", F.lit(run))
        found.write.mode("append").partitionBy("period", "run").parquet(f"{self.path}/{name}")
        held = (self.spark.read.schema(found.schema).parquet(f"{self.path}/{name}").where(F.col("run") == run)
                .groupBy("period").agg(F.count("*").alias("rows")).collect())
        columns, settings, at = rows.drop("period").schema.json(), json.dumps(dict(parameters or {}), sort_keys=True), time.time_ns()
        if held:
            self._commit([(name, r.period, run, at, r.rows, settings, columns, used) for r in held])
        return sorted(r.period for r in held)

    def runs(self, inputs: Iterable[tuple[str, date]]) -> list[tuple[str, date, str]]:
        """The runs that a reader of these periods gets now, for ``inputs`` of a later save."""
        return self._used(list(inputs), self.commits())

    def _used(self, inputs: list[tuple], commits: Mapping) -> list[tuple[str, date, str]]:
        self._require([i[:2] for i in inputs], commits)
        wrong = [f"{i[0]} {i[1]} was run again" for i in inputs if len(i) > 2 and commits[i[:2]].run != i[2]]
        if wrong:
            raise NotReady("; ".join(wrong))
        return [(of, when, commits[of, when].run) for of, when, *_ in inputs]

    def _require(self, inputs: Iterable[tuple[str, date]], commits: Mapping) -> None:
        wrong = [p for of, when in inputs for p in self.problems(of, when, commits)]
        if wrong:
            raise NotReady("; ".join(wrong))

    def _commit(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, _SCHEMA).coalesce(1).write.mode("append").parquet(self._log)

    def read(self, name: str, first: date | None = None, last: date | None = None,
             only: Iterable[date] | None = None) -> DataFrame:
        """The committed rows of the periods from ``first`` to ``last``, or of ``only`` some, with their ``period``.

        Only the folders of those periods are listed and scanned. Columns that an older run lacks
        are null. Stale and missing periods are refused; without bounds all committed ones are read.
        """
        commits, wanted = self.commits(), None if only is None else set(only)
        chosen = sorted((c for (of, p), c in commits.items() if of == name and (first is None or p >= first)
                         and (last is None or p <= last) and (wanted is None or p in wanted)), key=lambda c: c.period)
        if first is not None and first == last:
            self._require([(name, first)], commits)
        if not chosen:
            raise NotReady(f"{name} has no finished run in the wanted periods")
        self._require([(name, c.period) for c in chosen], commits)
        fields = {f.name: f for c in chosen for f in StructType.fromJson(json.loads(c.columns)).fields}
        schema = StructType(list(fields.values()))
        base = f"{self.path}/{name}"
        rows = (self.spark.read.schema(schema.add("period", "date").add("run", "string")).option("basePath", base)
                .parquet(*[self._folder(name, c.period, c.run) for c in chosen]))
        return rows.drop("run")

    def periods(self, name: str) -> list[date]:
        return sorted(p for of, p in self.commits() if of == name)
