"""Benchmark decontamination: a broadcast set of hashed test n-grams, verified hits.

Words are runs of letters and digits (all beyond ASCII count as letters), A-Z lower-cased. A window
is ``window`` consecutive words of a benchmark item; an item with fewer words, but not none, is one
window. The windows are hashed; every window of the training words is looked up in the sorted hashes
and verified against the words themselves. A document word inside any occurrence is hit.

The benchmark's windows are broadcast as they are: their total is counted first, and beyond
``BROADCAST_WINDOWS`` the benchmark is looked up in slices of that many windows, one pass over the
documents for each, whose hits are merged. So the broadcast stays bounded and no item is left out.

Null and empty texts have no words and no hits. Items without id hit words, but are neither counted
nor listed. Items with the same id count once. Repeated documents are judged each for itself. Further
columns of the input are ignored, except by ``clean_documents``, which keeps them all.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqloom.llm.common import LOWER, arrow_pass, carrying, in_rows, mix, slices

WINDOW = 10
BROADCAST_WINDOWS = 2_000_000
#: ASCII other than letters and digits parts words; every byte beyond ASCII belongs to one.
APART = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER)
SCHEMA = (
    "n_words long, n_hit long, hit_words array<struct<first:long,last:long>>, "
    "hit_bytes array<struct<first:long,last:long>>, item_ids array<string>, n_items long"
)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, in order."""
    return (text or "").encode().translate(APART).split()


class Index:
    """Hashed windows of benchmark items, by window length."""

    def __init__(self, items: list[tuple[object, str | None]], window: int) -> None:
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set]] = defaultdict(dict)
        for item, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            width = min(window, len(ids))
            for i in range(len(ids) - width + 1 if width else 0):
                key = tuple(ids[i : i + width])
                by_length[width].setdefault(key, set()).add(None if item is None else str(item))
        self.by_length = dict(by_length)
        self.hashes = {}
        for width, windows in by_length.items():
            codes = np.array(list(windows), np.uint64).reshape(-1)
            self.hashes[width] = np.unique(self.rolled(codes, width)[::width])

    @staticmethod
    def rolled(codes: np.ndarray, width: int) -> np.ndarray:
        """Hash of every run of ``width`` numbers."""
        spread = mix(codes + np.uint64(1))
        n = len(codes) - width + 1
        total = np.zeros(max(0, n), np.uint64)
        for j in range(width):
            total = total * np.uint64(0x9E3779B97F4A7C15) + spread[j : j + n]
        return mix(total)

    def hits(self, codes: np.ndarray) -> list[tuple[int, int, set]]:
        """First word, number of words and items of every verified occurrence."""
        out = []
        for width, hashes in self.hashes.items():
            if len(codes) < width:
                continue
            found = self.rolled(codes, width)
            at = np.searchsorted(hashes, found)
            at[at == len(hashes)] = 0
            for i in np.flatnonzero(hashes[at] == found).tolist():
                items = self.by_length[width].get(tuple(codes[i : i + width].tolist()))
                if items is not None:
                    out.append((i, width, items))
        return out


def _runs(hits: list[tuple[int, int, set]]) -> list[tuple[int, int]]:
    """Maximal runs of hit words, ends included."""
    runs: list[list[int]] = []
    for start, width, _ in sorted(hits, key=lambda h: h[:2]):
        if runs and start <= runs[-1][1] + 1:
            runs[-1][1] = max(runs[-1][1], start + width - 1)
        else:
            runs.append([start, start + width - 1])
    return [tuple(r) for r in runs]


@functools.lru_cache(maxsize=2)
def _index(items: tuple, window: int) -> Index:
    return Index(list(items), window)


def _scan(docs: DataFrame, items: tuple, window: int, id_column: str, carried: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((items, window))

    def make(batch):
        index = _index(*shared.value)
        number = index.numbers.get
        texts = batch.column(0).to_pylist()
        rows = []
        for a, b in slices(np.array([len(t or "") for t in texts]), 1_000_000):
            words = [words_of(t) for t in texts[a:b]]
            # texts are laid end to end, parted by a number no window holds
            codes = np.array([c for ws in words for c in (*(number(w, 0) for w in ws), 0)], np.uint64)
            place = np.cumsum([0, *(len(ws) + 1 for ws in words)])
            hits = index.hits(codes)
            owner = np.searchsorted(place, [h[0] for h in hits], "right") - 1
            of: dict[int, list] = defaultdict(list)
            for doc, (i, width, found) in zip(owner.tolist(), hits):
                of[doc].append((i - int(place[doc]), width, found))
            for d, ws in enumerate(words):
                own = of.get(d, [])
                runs = _runs(own)
                names = sorted({x for h in own for x in h[2] if x is not None})
                spans = []
                if runs:
                    at = [m.span() for m in WORD.finditer((texts[a + d] or "").encode().translate(LOWER))]
                    spans = [(at[x][0], at[y][1]) for x, y in runs]
                rows.append((len(ws), sum(y - x + 1 for x, y in runs), runs, spans, names))
        pair = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        dicts = [[{"first": x, "last": y} for x, y in r[2]] for r in rows]
        byte_dicts = [[{"first": x, "last": y} for x, y in r[3]] for r in rows]
        yield {
            **{name: batch.column(k + 1) for k, name in enumerate(carried)},
            "n_words": pa.array([r[0] for r in rows], pa.int64()),
            "n_hit": pa.array([r[1] for r in rows], pa.int64()),
            "hit_words": pa.array(dicts, pair),
            "hit_bytes": pa.array(byte_dicts, pair),
            "item_ids": pa.array([r[4] for r in rows], pa.list_(pa.string())),
            "n_items": pa.array([len(r[4]) for r in rows], pa.int64()),
        }

    return arrow_pass(
        docs.select(F.col("text").alias("_text"), *carried), make, carrying(docs, carried, SCHEMA)
    )


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    carried: list[str] | None = None,
) -> DataFrame:
    """Words, hit words, their runs (in words and in UTF-8 bytes) and items, per document."""
    carried = carried or [id_column]
    spark = docs.sparkSession
    letters = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    size = benchmark.agg(
        F.sum(F.greatest(F.lit(1), F.size(F.regexp_extract_all("text", F.lit(letters), F.lit(0)))))
    ).first()[0]
    parts = max(1, -(-(size or 0) // BROADCAST_WINDOWS))
    items = benchmark.select(F.col(item_column).cast("string"), "text")
    if parts == 1:
        rows = tuple(sorted(map(tuple, items.collect()), key=repr))
        return _scan(docs, rows, window, id_column, carried)
    return _in_slices(docs, items, parts, window, id_column, carried)


def _in_slices(docs, items, parts, window, id_column, carried):
    """One pass for each slice of the benchmark; hits of a document are merged in its row."""
    part = F.pmod(F.xxhash64(*items.columns), F.lit(parts))
    out, kept = docs, carried
    for k in range(parts):
        rows = tuple(sorted(map(tuple, items.where(part == k).collect()), key=repr))
        found = _scan(out, rows, window, id_column, ["text", *kept] if k + 1 < parts else kept)
        if k:
            found = _merged(found)
        out = found.select(
            *(["text"] if k + 1 < parts else []),
            *[c for c in carried],
            *[F.col(c).alias(f"_{c}") if k + 1 < parts else F.col(c) for c in RESULT],
        )
        kept = [*carried, *[f"_{c}" for c in RESULT]]
    return out


RESULT = ("n_words", "n_hit", "hit_words", "hit_bytes", "item_ids", "n_items")


def _merged(found: DataFrame) -> DataFrame:
    """Hits of this pass and, in ``_`` columns, of the passes before."""

    def united(name: str, gap: int):
        both = F.array_sort(F.concat(F.col(name), F.col(f"_{name}")))
        empty = F.array().cast(found.schema[name].dataType)

        def add(runs, x):
            last = F.try_element_at(runs, F.lit(-1))
            joins = (F.size(runs) > 0) & (x["first"] <= last["last"] + gap)
            longer = F.struct(
                last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last")
            )
            return F.when(joins, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(longer))).otherwise(
                F.concat(runs, F.array(x))
            )

        return F.aggregate(both, empty, add)

    words = united("hit_words", 1)
    names = F.array_sort(F.array_distinct(F.concat("item_ids", "_item_ids")))
    return (
        found.withColumn("hit_bytes", united("hit_bytes", 1))
        .withColumn("hit_words", words)
        .withColumn("item_ids", names)
        .withColumn("n_hit", F.aggregate("hit_words", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1))
        .withColumn("n_items", F.size("item_ids").cast("long"))
    )


def items_digest(names) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without any hit word, with all their columns."""
    found = find_leaks(in_rows(docs), benchmark, window, carried=["row"])
    return found.where("n_hit = 0").select("row.*")


def without_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, hit words and what lies between them cut out of ``text``."""
    found = find_leaks(in_rows(docs), benchmark, window, carried=["row"])
    data = F.encode("row.text", "UTF-8")
    kept = F.aggregate(
        "hit_bytes",
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda s, x: F.struct(
            x["last"].alias("at"),
            F.concat(s["out"], F.decode(F.substring(data, (s["at"] + 1).cast("int"), (x["first"] - s["at"]).cast("int")), "UTF-8")).alias("out"),
        ),
        lambda s: F.concat(s["out"], F.decode(F.substring(data, (s["at"] + 1).cast("int"), F.lit(2**31 - 1)), "UTF-8")),
    )
    text = F.when(F.size("hit_bytes") > 0, kept).otherwise(F.col("row.text"))
    return found.withColumn("row", F.col("row").withField("text", text)).select("row.*")
