"""Classification of schemas, tables and columns by name and type."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed


def _any_of(words: Iterable[str]) -> str:
    return "|".join(re.escape(word) for word in words)


def has_token(name: Column, tokens: Iterable[str]) -> Column:
    """Whole token, bounded by the ends of the name or an underscore; case is ignored."""
    kept = [token for token in tokens if token]
    if not kept:
        return F.lit(False)
    return name.rlike(rf"(?i)(?:^|_)(?:{_any_of(kept)})(?:_|$)")


def has_part(name: Column, parts: Iterable[str]) -> Column:
    """Plain substring, case ignored."""
    kept = [part for part in parts if part]
    return F.lower(name).rlike(_any_of(kept)) if kept else F.lit(False)


def has_pattern(name: Column, patterns: Iterable[str]) -> Column:
    """Any unanchored regular expression, case ignored."""
    kept = list(patterns)
    return name.rlike("(?i)" + "|".join(f"(?:{p})" for p in kept)) if kept else F.lit(False)


def first_label(cases: Iterable[tuple[Column, object]], default: object = None) -> Column:
    """The value of the first condition that holds."""
    chosen = None
    for condition, value in cases:
        chosen = F.when(condition, F.lit(value)) if chosen is None else chosen.when(
            condition, F.lit(value)
        )
    return F.lit(default) if chosen is None else chosen.otherwise(F.lit(default))


def suggested_tier(table: Column, keywords=fixed.TIER_KEYWORDS) -> Column:
    """Tier 3 or 2 by keyword token, else NULL; tier 1 is never suggested."""
    return first_label(
        (has_token(table, [word.strip("_") for word in words]), tier)
        for tier, words in keywords
    ).cast("int")


def normalized_tier(value: Column) -> Column:
    """1, 2 or 3, else NULL."""
    tier = value.try_cast("int")
    return F.when(tier.between(1, 3), tier)


def is_tier_one(value: Column) -> Column:
    """True for 1, ``1.0`` and labels such as ``Tier 1``."""
    bare = F.trim(F.regexp_replace(F.lower(value.cast("string")), "nhóm|tier", ""))
    return F.coalesce(bare.isin("1", "1.0"), F.lit(False))


def null_class(column: Column, rules=fixed.NULL_NAME_PATTERNS) -> Column:
    """NULL classification suggested by the column name, else NULL."""
    return first_label((has_pattern(column, patterns), label) for label, patterns in rules).cast(
        "string"
    )


def table_label(
    table: Column, rules: Iterable[tuple[str, Iterable[str]]],
    default: str = fixed.DEFAULT_TAXONOMY_LABEL,
) -> Column:
    """Label of the first rule (label, parts of names) that fits the table's name.

    The rules belong to the user's domain, so there are none by default.
    """
    return first_label(((has_part(table, words), label) for label, words in rules), default)


def schema_purpose(
    schema: Column, rules=fixed.SCHEMA_PURPOSES, default: str = fixed.DEFAULT_PURPOSE
) -> Column:
    return first_label(((has_part(schema, words), label) for label, words in rules), default)


def is_personal(
    schema: Column,
    table: Column,
    column: Column,
    patterns: Iterable[str] = fixed.PII_PATTERNS,
    extra: Iterable[str] = (),
) -> Column:
    """The name looks personal, or the full column name is in ``extra``."""
    listed = list(extra)
    by_name = has_pattern(column, patterns)
    return by_name | F.concat_ws(".", schema, table, column).isin(listed) if listed else by_name


def is_type(data_type: Column, family: Iterable[str]) -> Column:
    """Type name in a family; lengths and precisions are ignored."""
    return F.regexp_replace(F.lower(data_type), r"\(.*\)", "").isin(list(family))


def is_technical_column(column: Column, data_type: Column, primary_key: Column) -> Column:
    name = F.lower(column)
    return (
        F.coalesce(primary_key, F.lit(False))
        | is_type(data_type, fixed.TECHNICAL_TYPES)
        | (name == "id")
        | name.endswith("_id")
        | has_part(name, fixed.TECHNICAL_COLUMN_PARTS)
    )


def is_excluded_table(table: Column) -> Column:
    return has_part(table, fixed.EXCLUDED_TABLE_PARTS)


def is_timestamp_column(column: Column, data_type: Column) -> Column:
    return is_type(data_type, fixed.DATE_TYPES) & has_part(column, fixed.TIMESTAMP_NAME_PARTS)


def looks_like_key(column: Column) -> Column:
    return column.rlike(rf"(?i)_(?:{_any_of(fixed.KEY_SUFFIXES)})$")


def likely_table(column: Column) -> Column:
    """The column name without its key suffix."""
    return F.regexp_replace(column, rf"(?i)_(?:{_any_of(fixed.KEY_SUFFIXES)})$", "")


def null_warning(null_pct: Column, tier: Column) -> Column:
    """CRITICAL for tier 1 above 5 %, SUSPECT for tiers 2 and 3 above 90 %, else OK."""
    tier_text = tier.cast("string")
    return (
        F.when((tier_text == "1") & (null_pct > fixed.CRITICAL_NULL_PCT), F.lit("CRITICAL"))
        .when(tier_text.isin("2", "3") & (null_pct > fixed.SUSPECT_NULL_PCT), F.lit("SUSPECT"))
        .otherwise(F.lit("OK"))
    )


def is_dirty(value: Column, type_name: str, by_value: bool = False) -> Column | None:
    """Condition for a placeholder value, or None when the type is not checked.

    Numbers are compared as text, so only integers match unless ``by_value`` is set.
    """
    family = re.sub(r"\(.*\)", "", type_name.lower())
    if family in fixed.TEXT_TYPES:
        return F.lower(F.trim(value)).isin(*fixed.DIRTY_TEXT)
    if family in fixed.NUMERIC_TYPES:
        if by_value:
            return value.isin(*[int(number) for number in fixed.DIRTY_NUMBERS])
        return value.cast("string").isin(*fixed.DIRTY_NUMBERS)
    if family in fixed.DATE_TYPES:
        text = value.cast("string")
        first, second = fixed.DIRTY_DATE_PREFIXES
        return text.startswith(first) | text.startswith(second)
    return None
