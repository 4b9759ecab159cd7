"""License scans: MinHash bands over overlapping text windows, then exact containment.

All DataFrame expressions, row by row: nothing is shuffled. Words are runs of letters and digits (all beyond ASCII
count as letters), A-Z lower-cased. A template is the set of its shingles of ``WORDS`` words (all its words as one if
it has fewer). Texts are read in windows of ``WINDOW`` shingles that overlap by half; a template's own windows are
taken at every place. A window has ``BANDS`` bands of one minimum each, every band with a hash of its own, and
retrieves the templates that one of its bands agrees with. A template of more than ``WINDOW`` shingles that lies whole
in a text has a window equal to one of the text's, which always collides. Shorter ones may lie across windows: they
are retrieved by any one of their shingles. So every whole occurrence is retrieved. Of an altered one, a window that
shares three of four shingles with the template collides with probability 1 - 0.4**BANDS (1 - 6.6e-4).

Retrieved templates are verified exactly: the share of the template's shingles that the text holds must reach
``SHARE``. A document gives one row for each template found, with the first word of its first shingle found
(from 1).

Null and empty texts and templates hold nothing. Repeated documents give repeated rows; templates with equal ids are
templates of their own. Columns of the documents come back in ``row``. Templates are few by nature: beyond
``AT_ONCE`` they are looked for in groups, one pass each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import in_rows

WORDS = 3
WINDOW = 4
BANDS = 8
SHARE = 0.75
AT_ONCE = 32
UPPER, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text, as an array."""
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER_LETTERS)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of all shingles, in order; of all words if there are fewer.

    ``words`` is a column of its own: an expression would be computed anew for every shingle.
    """
    some = F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(words) - WORDS, F.lit(0))),
        lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(WORDS)]),
    )
    return F.when(F.size(words) > 0, some).otherwise(F.array().cast("array<bigint>"))


def windows_of(hashes: Column) -> Column:
    """Windows of shingles that overlap by half, as structs h0, h1, ...; null past the end."""
    step = WINDOW // 2
    last = F.greatest(F.ceil((F.size(hashes) - WINDOW) / step), F.lit(0)).cast("int")
    some = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(*[F.get(hashes, i * step + j).alias(f"h{j}") for j in range(WINDOW)]),
    )
    return F.when(F.size(hashes) > 0, some)


def agrees(window: Column, keys: list[set[int]]) -> Column:
    """Whether a band of the window has one of the keys for that band."""
    tests = []
    for band, wanted in enumerate(keys):
        least = F.least(*[window[f"h{j}"][f"b{band}"] for j in range(WINDOW)])
        tests.append(least.isin(sorted(wanted)))
    return F.coalesce(reduce(lambda a, b: a | b, tests), F.lit(False))


def band_ranks(hashes: Column) -> Column:
    """For every shingle, its place in the order of each band, as structs b0, b1, ..."""
    return F.transform(hashes, lambda h: F.struct(*[F.xxhash64(h, F.lit(b)).alias(f"b{b}") for b in range(BANDS)]))


def band_keys(ranks: list) -> list[set[int]]:
    """The keys of all windows of a template, by band."""
    windows = [ranks[i : i + WINDOW] for i in range(max(1, len(ranks) - WINDOW + 1))]
    return [{min(r[b] for r in w) for w in windows} for b in range(BANDS)]


def is_short(hashes: list[int]) -> bool:
    """Whether a template can lie in a text without an equal window."""
    return len(hashes) <= WINDOW


def find_licenses(docs: DataFrame, templates: DataFrame) -> DataFrame:
    """``row``, license, first_word, n_matched, n_template, containment, for every license of every document.

    ``templates`` has the columns license and text.
    """
    read = templates.select("license", words_of(F.col("text")).alias("words"))
    hashed = read.select("license", shingle_hashes(F.col("words")).alias("h"))
    ranked = hashed.select("license", "h", band_ranks(F.col("h")).alias("ranks")).collect()
    known = sorted(((r["license"], list(r["h"]), band_keys(r["ranks"])) for r in ranked if r["h"]), key=repr)
    groups = [known[i : i + AT_ONCE] for i in range(0, len(known), AT_ONCE)] or [[]]
    return reduce(DataFrame.unionByName, [_scan(docs, group) for group in groups])


def _scan(docs: DataFrame, known: list[tuple[str, list[int], list[set[int]]]]) -> DataFrame:
    read = in_rows(docs).select("row", words_of(F.col("text")).alias("words"))
    hashed = read.select("row", shingle_hashes(F.col("words")).alias("h"))
    ranked = hashed.select("row", "h", band_ranks(F.col("h")).alias("ranks"))
    every = [set().union(*(keys[b] for _, _, keys in known)) for b in range(BANDS)]
    short = sorted({h for _, hashes, _ in known if is_short(hashes) for h in hashes})
    near = ranked.select(
        "row", "h", _holds_one(short).alias("shared"),
        F.filter(windows_of(F.col("ranks")), lambda w: agrees(w, every)).alias("near"),
    )
    kind = "array<struct<license:string,first_word:bigint,n_matched:bigint,n_template:bigint,containment:double>>"
    found = [_verified(*template) for template in known]
    listed = F.array_compact(F.array(*found)) if found else F.array()
    some = F.when((F.size("near") > 0) | F.col("shared"), listed).cast(kind)
    return near.select("row", some.alias("found")).select("row", F.inline_outer("found")).where("n_template IS NOT NULL")


def _holds_one(hashes: list[int]) -> Column:
    """Whether the text has one of the shingles."""
    return F.arrays_overlap("h", F.array(*[F.lit(h) for h in hashes]).cast("array<bigint>"))


def _verified(name: str, hashes: list[int], keys: list[set[int]]) -> Column:
    """The result for one template, null if it isn't retrieved or not contained."""
    own = sorted(set(hashes))
    template = F.array(*[F.lit(h) for h in own])
    matched = F.size(F.array_intersect(F.col("h"), template))
    places = F.transform(template, lambda x: F.nullif(F.array_position("h", x), F.lit(0)))
    result = F.struct(
        F.lit(name).cast("string").alias("license"),
        F.array_min(places).cast("long").alias("first_word"),
        matched.cast("long").alias("n_matched"),
        F.lit(len(own)).cast("long").alias("n_template"),
        (matched / F.lit(len(own))).cast("double").alias("containment"),
    )
    retrieved = F.coalesce(F.exists("near", lambda w: agrees(w, keys)), F.lit(False))
    if is_short(hashes):
        retrieved = _holds_one(own) | retrieved
    return F.when(retrieved, F.when(matched >= SHARE * len(own), result))
