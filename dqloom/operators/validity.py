"""Validity: column groups and format, range and length rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed
from dqloom.functions import naming
from dqloom.functions.numbers import pct
from dqloom.functions.text import quoted

EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
PHONE = r"^\+?[0-9][0-9 .-]{6,18}[0-9]$"

CONTACT_PARTS = ("phone", "mobile", "tel", "email", "address", "dien_thoai", "dia_chi", "url")
CODE_PARTS = ("code", "key", "number", "ma_", "so_")


def column_group(column: Column, data_type: Column) -> Column:
    """date, contact, identifier, category, measure, text or other."""
    is_text = naming.is_type(data_type, fixed.TEXT_TYPES)
    return naming.first_label(
        [
            (naming.is_type(data_type, fixed.DATE_TYPES), "date"),
            (is_text & naming.has_part(column, CONTACT_PARTS), "contact"),
            (naming.looks_like_key(column) | (F.lower(column) == "id")
             | naming.has_part(column, CODE_PARTS), "identifier"),
            (naming.has_part(column, (*fixed.ENUM_TOKENS, "type", "flag", "lang")), "category"),
            (naming.is_type(data_type, fixed.NUMERIC_TYPES), "measure"),
            (is_text, "text"),
        ],
        "other",
    )


@dataclass(frozen=True)
class ValidityRule:
    """A technical rule for one column.

    ``kind`` is date_range, number_range, length_range (``low`` and ``high``, either may be
    None), pattern, email, phone (``pattern``) or enum (``allowed``).
    """

    rule_id: str
    column: str
    kind: str
    low: Any = None
    high: Any = None
    pattern: str | None = None
    allowed: tuple = ()

    def broken(self) -> Column:
        value = F.col(quoted(self.column))
        if self.kind in ("date_range", "number_range", "length_range"):
            if self.kind == "length_range":
                value = F.char_length(value)
            wrong = F.lit(False)
            for bound, outside in ((self.low, value.__lt__), (self.high, value.__gt__)):
                if bound is not None:
                    limit = F.lit(bound)
                    if self.kind == "date_range":
                        limit = limit.cast("timestamp_ntz")
                    wrong = wrong | outside(limit)
            return wrong
        if self.kind == "enum":
            return ~value.isin(list(self.allowed))
        pattern = {"email": EMAIL, "phone": PHONE}.get(self.kind, self.pattern)
        if pattern is None:
            raise ValueError(f"Rule {self.rule_id}: unknown kind {self.kind}")
        return ~value.rlike(pattern)


def validity_checks(frame: DataFrame, rules: Sequence[ValidityRule]) -> DataFrame:
    """Checked and broken values of every rule, in one pass over the table."""
    aggregates = []
    for i, rule in enumerate(rules):
        aggregates += [
            F.count(F.col(quoted(rule.column))).alias(f"c{i}"),
            F.count_if(rule.broken()).alias(f"v{i}"),
        ]
    rows = F.array(*[
        F.struct(
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.column).alias("column_name"),
            F.lit(rule.kind).alias("kind"),
            F.col(f"c{i}").alias("checked_count"),
            F.col(f"v{i}").alias("violation_count"),
            pct(F.col(f"v{i}"), F.col(f"c{i}")).alias("violation_pct"),
        )
        for i, rule in enumerate(rules)
    ])
    return frame.agg(*aggregates).select(F.inline(rows))


def reported(results: DataFrame, threshold_pct: float) -> DataFrame:
    """Results of tier 1 and of any tier above the threshold."""
    return results.filter(
        naming.is_tier_one(F.col("tier")) | (F.col("violation_pct") > threshold_pct)
    )


def summarised(results: DataFrame, threshold_pct: float) -> DataFrame:
    """The other results, added up per tier."""
    rest = results.filter(
        ~(naming.is_tier_one(F.col("tier")) | (F.col("violation_pct") > threshold_pct))
    )
    summed = rest.groupBy("tier").agg(
        F.count(F.lit(1)).alias("checks"),
        F.sum("checked_count").alias("checked_count"),
        F.sum("violation_count").alias("violation_count"),
    )
    return summed.withColumn("violation_pct", pct(F.col("violation_count"), F.col("checked_count")))
