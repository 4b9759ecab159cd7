"""Key ranges in which a large table is read by many tasks, whatever its source.

A range planner works on any frame: rows and bounds come from one aggregate, cuts from a quantile
sketch of fixed size in a second pass that reads the key alone. So uneven keys (a gap, an outlier, a
dense stretch) still give ranges of about equal rows, where equal steps between the bounds would put
nearly all rows into one. The ranges are predicates; every row, those with a NULL key too, satisfies
exactly one of them. One key value can't be split: its rows are one range.

Keys are numbers, dates or timestamps; others are an error. A table without rows, or with NULL keys
alone, is one range.
"""

from __future__ import annotations

import datetime
import decimal
import math
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dqloom.functions.text import quoted

ROWS_PER_TASK = 1_000_000
ACCURACY = 20  # quantiles are off by at most a twentieth of a range
SPLITTABLE = (T.IntegralType, T.DecimalType, T.DoubleType, T.FloatType, T.DateType, T.TimestampType,
              T.TimestampNTZType)


def literal(value: object) -> str:
    """A key value in SQL that databases and Spark read alike."""
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, float):
        if not math.isfinite(value):
            raise ValueError(f"A range can't end at {value}")
        return repr(value)
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    raise ValueError(f"Tables can't be split by values like {value!r}")


def cut_points(keys: DataFrame, column: str, parts: int) -> list:
    """Values at which ranges begin, rising and distinct: at most one less than ``parts``."""
    kind = keys.schema[column].dataType
    if not isinstance(kind, SPLITTABLE):
        raise ValueError(f"Tables can't be split by {column}: {kind.simpleString()}")
    if parts < 2:
        return []
    key = F.col(quoted(column))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        key = F.when(~F.isnan(key) & (F.abs(key) < float("inf")), key)
    shares = [i / parts for i in range(1, parts)]
    points = keys.agg(F.percentile_approx(key, shares, ACCURACY * parts).alias("cuts"), F.min(key).alias("low")).first()
    return [cut for cut in sorted(set(points["cuts"] or [])) if cut > points["low"]]


def predicates(column: str, cuts: list) -> list[str]:
    """One condition for each range; ``column`` is the name as SQL has it. NULL keys are in the first."""
    if not cuts:
        return ["1 = 1"]
    texts = [literal(cut) for cut in cuts]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(texts, texts[1:])]
    return [f"({column} < {texts[0]} OR {column} IS NULL)", *between, f"{column} >= {texts[-1]}"]


def planned(keys: DataFrame, column: str, rows: int, rows_per_task: int, name: str) -> list[str]:
    """Ranges of about ``rows_per_task`` rows of a frame that has (at least) the key column."""
    if rows_per_task < 1:
        raise ValueError("rows_per_task must be positive")
    return predicates(name, cut_points(keys, column, -(-rows // rows_per_task)))


def planned_for(frame: DataFrame, column: str, rows_per_task: int = ROWS_PER_TASK) -> list[str]:
    """Ranges of a Spark frame, as conditions that Spark reads."""
    rows = frame.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    return planned(frame.select(quoted(column)), column, rows, rows_per_task, quoted(column))


@dataclass(frozen=True)
class JdbcTable:
    """A database table, opened through ``open_options`` (Spark's JDBC source if unset)."""

    spark: SparkSession
    schema: str
    table: str
    url: str
    properties: Mapping[str, str]
    open_options: Callable[[dict[str, str]], DataFrame] | None = None
    open_ranges: Callable[[dict[str, str], list[str]], DataFrame] | None = None

    @property
    def name(self) -> str:
        return f"{named(self.schema)}.{named(self.table)}"

    def bounds_options(self, column: str) -> dict[str, str]:
        """One row from the database: least and greatest key, rows."""
        key = named(column)
        return {"url": self.url, **self.properties,
                "query": f"SELECT min({key}) AS low, max({key}) AS high, count(*) AS row_count FROM {self.name}"}

    def keys_options(self, column: str, low: object, high: object, parts: int) -> dict[str, str]:
        """The key column alone, in equal steps between the bounds: good enough to draw the sketch from."""
        options = {"url": self.url, **self.properties,
                   "dbtable": f"(SELECT {named(column)} FROM {self.name}) key_values"}
        # Spark steps by whole numbers, days or seconds
        if isinstance(low, float):
            low, high = math.floor(low), math.ceil(high)
        if isinstance(low, decimal.Decimal):
            low, high = int(low.to_integral_value(decimal.ROUND_FLOOR)), int(high.to_integral_value(decimal.ROUND_CEILING))
        if parts < 2 or low == high:
            return options
        return options | {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
                          "numPartitions": str(parts)}

    def _open(self, options: dict[str, str]) -> DataFrame:
        if self.open_options:
            return self.open_options(options)
        return self.spark.read.format("jdbc").options(**options).load()

    def load(self, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
        """The whole table in planned ranges."""
        found = self._open(self.bounds_options(column)).first()
        rows = int(found["row_count"])
        options = {"url": self.url, "dbtable": self.name, **self.properties}
        parts = -(-rows // rows_per_task)
        if parts < 2 or found["low"] is None:
            return self._open(options)
        keys = self._open(self.keys_options(column, found["low"], found["high"], parts))
        conditions = planned(keys, column, rows, rows_per_task, named(column))
        if self.open_ranges:
            return self.open_ranges(options, conditions)
        return self.spark.read.jdbc(self.url, self.name, predicates=conditions, properties=dict(self.properties))


def named(name: str) -> str:
    """A name as SQL quotes it."""
    return '"' + name.replace('"', '""') + '"'
