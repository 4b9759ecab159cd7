"""Runs over very many tables or rules: planned and written in groups, failures become notes.

A run is a folder. Each group of units (tables, keys, rules) is one plan whose result is written
once and read back, so no plan and no driver state grows with the number of units but their names. If
a group fails it is halved until the unit that fails is alone; that unit gets a note and all
others their rows. A run that was broken off goes on after the last group written when it
is called again with the same folder; units with a failure are tried again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqloom.sources.registry import TableKey, TableRegistry

NOTE_SCHEMA = "name string, unit string, part string, attempt int, failure string"
LONGEST_NOTE = 500  # characters of a failure's message that a note shows


@dataclass(frozen=True)
class GroupedRun:
    """Results and notes of one run below ``folder``; ``size`` units make a group."""

    spark: SparkSession
    folder: str
    size: int = 50

    def rows(
        self, name: str, units: Mapping[str, Any], build: Callable[[list[Any]], DataFrame]
    ) -> DataFrame:
        """``build`` over all units, group by group; the rows of the units that did not fail.

        Units are handed to ``build`` in the order of their names, so what is named alike shares a plan.
        """
        if not units:
            raise ValueError(f"Nothing to run for {name}")
        tried = self._tried(name)
        open_units = sorted(u for u in units if tried.get(u, (0, ""))[1] is not None)
        attempts = {u: tried[u][0] + 1 if u in tried else 1 for u in open_units}
        for at in range(0, len(open_units), self.size):
            self._group(name, open_units[at : at + self.size], units, build, attempts)
        parts = self._parts(name, units)
        if not parts:
            failure = self.notes().filter(F.col("name") == name).first()["failure"]
            raise ValueError(f"Every unit of {name} failed, the first with: {failure}")
        return self.spark.read.parquet(*parts)

    def opened(self, registry: TableRegistry, keys: Sequence[TableKey] | None = None) -> list[TableKey]:
        """The tables whose schema can be read; the others get a note."""
        good, lost = [], []
        for key in registry.keys() if keys is None else keys:
            try:
                registry.table(*key).schema  # noqa: B018
                good.append(key)
            except Exception as problem:
                self._still_alive(problem)
                lost.append((".".join(key), problem))
        tried = self._tried("open")
        noted = [
            ("open", unit, None, tried.get(unit, (0, None))[0] + 1, _message(problem))
            for unit, problem in lost
        ]
        noted += [
            ("open", unit, None, tried[unit][0] + 1, None)
            for unit in map(".".join, good) if tried.get(unit, (0, None))[1] is not None
        ]
        if noted:
            self._note(noted)
        return good

    def notes(self) -> DataFrame:
        """``name, unit, failure`` of the units whose last attempt failed."""
        return self._latest().filter(F.col("failure").isNotNull()).select("name", "unit", "failure")

    def _latest(self) -> DataFrame:
        try:
            found = self.spark.read.schema(NOTE_SCHEMA).parquet(f"{self.folder}/notes")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], NOTE_SCHEMA)
        last = F.max_by(F.struct("part", "attempt", "failure"), "attempt").alias("last")
        return found.groupBy("name", "unit").agg(last).select("name", "unit", "last.*")

    def _tried(self, name: str) -> dict[str, tuple[int, str | None]]:
        found = self._latest().filter(F.col("name") == name)
        return {row["unit"]: (row["attempt"], row["failure"]) for row in found.collect()}

    def _parts(self, name: str, units: Mapping[str, Any]) -> list[str]:
        found = self._latest().filter((F.col("name") == name) & F.col("failure").isNull())
        held: dict[str, set[str]] = {}
        for row in found.select("unit", "part").collect():
            held.setdefault(row["part"], set()).add(row["unit"])
        foreign = sorted(u for group in held.values() for u in group if u not in units)
        if foreign:
            raise ValueError(f"The run in {self.folder} holds other units of {name}: {', '.join(foreign[:5])}")
        return [f"{self.folder}/rows/{name}/{part}" for part in sorted(held)]

    def _group(self, name, group, units, build, attempts) -> None:
        part = hashlib.sha256("\n".join(group).encode()).hexdigest()[:32]
        try:
            frame = build([units[u] for u in group])
            # overwritten, as a broken run may have left files that no note names
            frame.write.mode("overwrite").parquet(f"{self.folder}/rows/{name}/{part}")
        except Exception as problem:
            self._still_alive(problem)
            if len(group) > 1:
                half = len(group) // 2
                self._group(name, group[:half], units, build, attempts)
                self._group(name, group[half:], units, build, attempts)
            else:
                self._note([(name, group[0], None, attempts[group[0]], _message(problem))])
            return
        # only now do the rows count
        self._note([(name, u, part, attempts[u], None) for u in group])

    def _note(self, rows: list[tuple]) -> None:
        noted = self.spark.createDataFrame(rows, NOTE_SCHEMA).coalesce(1)
        noted.write.mode("append").parquet(f"{self.folder}/notes")

    def _still_alive(self, problem: Exception) -> None:
        """A stopped session says nothing about the table that was being read."""
        context = self.spark.sparkContext._jsc
        if context is None or context.sc().isStopped():
            raise problem


def _message(problem: Exception) -> str:
    lines = [line.strip() for line in str(problem).splitlines() if line.strip()]
    return (lines[0] if lines else type(problem).__name__)[:LONGEST_NOTE]


def each_table(keys: Sequence[TableKey]) -> dict[str, TableKey]:
    """Tables as units of a run."""
    return {".".join(key): key for key in keys}
