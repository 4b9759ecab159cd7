"""URL filter: a cascade of Bloom filters, exact over the corpus's own keys, without joins.

The keys are host and path of a url. Level 0 holds the listed keys; level 1 the keys of the corpus
that pass level 0 without being listed; level 2 the listed keys that pass level 1; and so on with ever
fewer keys, until no key is mistaken. As the levels are built over the complete key universe of the
corpus, the first level that a key doesn't pass says for certain whether it is listed. Each level is a
bit array of ``BITS_PER_KEY`` bits a key, made by an aggregation, and reaches the scan as a scalar
subquery: no join, no Python.

A level's size follows the number of its keys and is checked: up to ``MOST_BITS`` bits it is sent to
the tasks. More listed keys are dealt by hash into slices whose levels stay below that; pages are written
by slice of their keys, and each slice has a cascade of its own, over its keys only, with the same results.

Few rules (host, path prefix, verdict) stand before the filter: a rule fits its host and all its
subdomains if the url's path starts with the rule's; the longest rule wins.
Of rules of equal length that fit, the one with the longer host wins; those with hosts of equal length too are the
same rule, of which the verdict given last holds. A url without rule is blocked if its key is listed, else allowed. Null urls and urls without ``://``
have an empty host and path, and an empty key, which is never listed. Repeated pages are judged each
for itself; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import cut, quoted
from dqloom.operators.keyed import union_all

BITS_PER_KEY = 10
HASHES = 7
MOST_BITS = 1 << 26
UPPER, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]  # host, path, verdict


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds host and path."""
    text = F.coalesce(F.col(url), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return pages.withColumn("host", F.translate(host, UPPER, LOWER_LETTERS)).withColumn("path", path)


def key_of(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("/"), path)


# --- one Bloom filter -----------------------------------------------------------------------


def _bits(count: int) -> int:
    """Bits of a level: a multiple of 64."""
    return 64 * max(1, math.ceil(count * BITS_PER_KEY / 64))


def _places(key: Column, level: int, bits: int) -> list[Column]:
    """The bit places of a key: each hash has its own seed."""
    return [F.pmod(F.xxhash64(F.lit(level * HASHES + i), key), F.lit(bits)) for i in range(HASHES)]


def build(keys: DataFrame, level: int, bits: int) -> DataFrame:
    """One row with the filter's words as an array."""
    places = keys.select(F.explode(F.array(*_places(F.col("key"), level, bits))).alias("bit"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("bit", F.lit(64)).cast("int"))
    words = places.groupBy(F.floor(F.col("bit") / 64).cast("int").alias("word")).agg(
        F.bit_or(one).alias("value")
    )
    every = keys.sparkSession.range(bits // 64).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("value")
    )
    full = words.union(every).groupBy("word").agg(F.bit_or("value").alias("value"))
    listed = full.agg(F.sort_array(F.collect_list(F.struct("word", "value"))).alias("all"))
    return listed.select(F.col("all.value").alias("words"))


def passes(key: Column, words: DataFrame, level: int, bits: int) -> Column:
    """Whether a key passes the level: all its bits are set."""
    held = words.scalar()

    def is_set(place: Column) -> Column:
        word = F.get(held, F.floor(place / 64).cast("int"))
        return F.call_function("bit_get", word, F.pmod(place, F.lit(64)).cast("int")) == 1

    return reduce(lambda a, b: a & b, [is_set(p) for p in _places(key, level, bits)])


# --- the cascade ----------------------------------------------------------------------------


class Cascade:
    """Filter levels over a key universe. ``listed`` and ``universe`` have one column ``key``; listed keys are distinct."""

    def __init__(self, listed: DataFrame, universe: DataFrame) -> None:
        self.levels: list[tuple[DataFrame, int]] = []
        self.listed = listed
        inside, outside = self.listed, None
        count = inside.count()
        while count:
            self._add(inside, count)
            if outside is None:
                # the only pass over the corpus: its keys that pass level 0, listed or not
                through = universe.where(self._through(0)).select("key", F.lit(0).alias("is_listed"))
                both = through.unionByName(self.listed.select("key", F.lit(1).alias("is_listed")))
                outside = both.groupBy("key").agg(F.max("is_listed").alias("m")).where("m = 0").select("key")
            else:
                outside = outside.where(self._through(len(self.levels) - 1))
            outside = cut(outside, "mistaken-keys")
            inside, outside, count = outside, inside, outside.count()

    def _add(self, keys: DataFrame, count: int) -> None:
        bits = _bits(count)
        self.levels.append((cut(build(keys, len(self.levels), bits), "filter-level"), bits))

    def _through(self, level: int) -> Column:
        words, bits = self.levels[level]
        return passes(F.col("key"), words, level, bits)

    def mark(self, frame: DataFrame) -> DataFrame:
        """Adds ``is_listed`` by ``key``; exact for all keys of the universe and of the list."""
        # stopped at level n: listed if n is odd; past all n levels: listed if n is odd
        verdict = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            verdict = F.when(~self._through(level), F.lit(level % 2 == 1)).otherwise(verdict)
        return frame.withColumn("is_listed", verdict)


def marked(frame: DataFrame, listed: DataFrame) -> DataFrame:
    """Adds ``is_listed`` by ``key``, by one cascade or one for each slice of the keys."""
    known = cut(listed.where("key is not null").select("key").distinct(), "listed-keys")
    slices = -(-_bits(known.count()) // MOST_BITS)
    if slices < 2:
        return Cascade(known, frame.select("key")).mark(frame)
    # slices are even, but not equal: a quarter more of them keeps each below the limit
    slices += -(-slices // 4)
    number = F.pmod(F.xxhash64(F.lit(-1), F.col("key")), F.lit(slices)).cast("int")
    spread = F.pmod(F.xxhash64(F.lit(-2), F.col("key")), F.lit(16))
    known = cut(known.withColumn("_slice", number), "listed-slices", by="_slice")
    pages = frame.withColumn("_slice", number).repartition(F.col("_slice"), spread)
    pages = cut(pages, "pages-by-slice", by="_slice")
    found = []
    for i in range(slices):
        own = pages.where(F.col("_slice") == i).drop("_slice")
        cascade = Cascade(known.where(F.col("_slice") == i).select("key"), own.select("key"))
        found.append(cascade.mark(own))
    return union_all(found)


# --- rules and verdicts ---------------------------------------------------------------------


def rule_name(host: str, path: str) -> str:
    return f"{host}{path}"


def best_rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits host and path, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, action in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), len(r[0]))):
        fits = (F.col("host") == host) | F.endswith("host", F.lit("." + host))
        fits = fits & F.startswith("path", F.lit(path)) if path else fits
        name = F.when(fits, F.lit(rule_name(host, path))).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


RESULT = ("host", "path", "rule", "verdict", "is_listed")


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Pages with host, path, rule, verdict and whether the key is listed.

    Columns of the pages that have these names are replaced.
    """
    kept = [pages[quoted(c)] for c in pages.columns if c not in RESULT]
    keyed = with_parts(pages.select(F.struct(*kept).alias("row"), "url"))
    keyed = keyed.withColumn("key", key_of(F.col("host"), F.col("path")))
    name, verdict = best_rule(rules)
    found = F.when(F.col("is_listed"), F.lit("block")).otherwise("allow")
    return marked(keyed, listed).select(
        "row.*", "host", "path", name.alias("rule"), F.coalesce(verdict, found).alias("verdict"), "is_listed"
    )
