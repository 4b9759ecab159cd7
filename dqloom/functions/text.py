"""Cell cleaning, masking and compact grouping keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dqloom.functions import fixed_values as fixed


def clean_cell(value: Column, max_chars: int | None = fixed.MAX_CELL_CHARS) -> Column:
    """Drop control characters, turn line breaks into one blank, cut to a report cell."""
    text = F.regexp_replace(value, fixed.CONTROL_CHARS, "")
    text = F.regexp_replace(text, r"\r\n|\r|\n", " ")
    return text if max_chars is None else F.left(text, F.lit(max_chars))


def masked(value: Column) -> Column:
    """First two characters and ``***``; short values vanish entirely."""
    return F.when(
        F.char_length(value) > 2, F.concat(F.left(value, F.lit(2)), F.lit("***"))
    ).otherwise(F.when(value.isNotNull(), F.lit("***")))


def mask_sample(sample: Column) -> Column:
    """Mask each part of a ``a | b | c`` sample."""
    parts = F.split(sample, r" \| ")
    return F.array_join(
        F.transform(parts, lambda part: masked(F.trim(part))), fixed.SAMPLE_SEPARATOR
    )


def compact_key(value: Column, is_text: bool, longest: int = 64) -> Column:
    """A grouping key that stays small when text is long.

    Texts of at most ``longest`` bytes are kept, longer ones become a 71-byte SHA-256
    label, so equal keys mean equal texts and whole documents are never shuffled.
    """
    if not is_text:
        return value
    return F.when(F.octet_length(value) <= longest, value).otherwise(
        F.concat(F.lit("sha256:"), F.sha2(value, 256))
    )


def full_column(*parts: Column) -> Column:
    return F.concat_ws(".", *parts)


def edge_label(from_parts: list[Column], to_parts: list[Column]) -> Column:
    """``s.t.c -> s.t.c``."""
    return F.concat_ws(" -> ", full_column(*from_parts), full_column(*to_parts))


def reference_error(value: Column, parts: int) -> Column:
    """NULL for a well-formed dotted reference, else what is wrong with it."""
    shape = "schema.table" if parts == 2 else "schema.table.column"
    pieces = F.split(value, r"\.")
    good = (F.size(pieces) == parts) & F.forall(pieces, lambda piece: piece != "")
    return F.when(F.coalesce(good, F.lit(False)), F.lit(None).cast("string")).otherwise(
        F.concat(F.lit(f"expected {shape}: "), F.coalesce(value, F.lit("missing")))
    )


def quoted(name: str) -> str:
    """A column name that may hold dots, blanks or backticks, for ``F.col``."""
    return "`" + name.replace("`", "``") + "`"
