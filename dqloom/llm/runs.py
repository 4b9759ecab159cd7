"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q, at least ``max(12, 2 q)`` long, that no neighbouring word
extends. Documents of a task are laid one after the other with marks between them that equal nothing, long
ones first, and all steps work on the whole array.

Periods up to 10 are found by comparing the array with itself, shifted. Periods from 3t-1 to 6t-2, for t = 4, 8,
16, ..., are proposed by a synchronising set of scale t: each place whose t-gram, or that t
further, has the smallest hash of the t-grams from one to the other. Whether a place belongs depends on its 2t words only,
so a run has equal places a period apart; all pairs of places with equal 2t words in that distance propose
it. t-grams of a period up to t/3 have no hash, so equal places are more than t/3 apart and the
pairs stay few. Where such highly periodic regions hide the places of a run's beginning, the regions, known as runs of
smaller scales, propose it: by the distance of two ends, or, where two regions of one period
touch or overlap, by the distances at which both are in step.

Proposals are extended by searching with hashes and compared word by word; where one fails, its period is searched
for word by word, so results are exact. Of equal stretches the smallest period is the run's.

Null and empty texts have no words and no runs. Rows are independent: repeated rows and ids give
repeated results. Columns to keep come back in the struct ``row``. Memory follows ``WORDS`` words, or the longest text
where that is larger (some 100 bytes a word).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dqloom.functions.text import quoted
from dqloom.llm.blocks import Numbers, edges
from dqloom.llm.common import arrow_pass, mix, slices

WORDS = 500_000
LEAST = 12
SHIFTED = 10  # periods found by shifting; the first scale, 4, goes on from there
FIRST_SCALE = 4
_BASE = 0x9E3779B97F4A7C15 | 1
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
Runs = tuple[np.ndarray, np.ndarray, np.ndarray]  # start, end, period


class Hashes:
    """Hashes of ranges of an array of numbers: polynomials modulo 2**64."""

    def __init__(self, words: np.ndarray) -> None:
        def powers(base: int) -> np.ndarray:
            full = np.full(len(words) + 1, np.uint64(base))
            full[0] = 1
            return np.multiply.accumulate(full)

        self.power, self.inverse = powers(_BASE), powers(pow(_BASE, -1, 1 << 64))
        self.sums = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(mix(words.astype(np.uint64) + np.uint64(_BASE)) * self.power[:-1], out=self.sums[1:])

    def all(self, width: int, end: int) -> np.ndarray:
        """Of every range of one width up to ``end``."""
        return mix((self.sums[width : end + 1] - self.sums[: end + 1 - width]) * self.inverse[: end + 1 - width])

    def at(self, start: np.ndarray, width: int) -> np.ndarray:
        return mix((self.sums[start + width] - self.sums[start]) * self.inverse[start])

    def equal(self, start: np.ndarray, width: np.ndarray, shift: np.ndarray) -> np.ndarray:
        """Whether ranges equal those ``shift`` further."""
        here = (self.sums[start + width] - self.sums[start]) * self.power[shift]
        return here == self.sums[start + shift + width] - self.sums[start + shift]


def _unique(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
    """Each stretch once, with its smallest period, in order."""
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _joined(parts: list[Runs]) -> Runs:
    return _unique(*(np.concatenate(x) for x in zip(*parts)))


def _shifted(words: np.ndarray, period: int) -> Runs:
    """Stretches of one period, by comparison; from 4 words on, as later scales need short ones too."""
    differ = np.flatnonzero(words[period:] != words[:-period])
    bounds = np.concatenate([[-1], differ, [max(0, len(words) - period)]])
    length = np.diff(bounds) - 1
    own = np.flatnonzero(length >= max(4, 2 * period) - period)
    start = bounds[own] + 1
    return start, start + length[own] + period, np.full(len(own), period)


def _places(hashes: Hashes, runs: Runs, scale: int, end: int) -> np.ndarray:
    """The synchronising set of a scale."""
    grams = hashes.all(scale, end)
    start, stop, period = runs
    own = (3 * period <= scale) & (stop - start >= scale) & (stop <= end)
    step = np.zeros(len(grams) + 1, np.int32)
    np.add.at(step, start[own], 1)
    np.add.at(step, stop[own] - scale + 1, -1)
    grams[np.cumsum(step[:-1]) > 0] = _NONE
    least, width = grams, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    return np.flatnonzero(((least == grams[:n]) | (least == grams[scale : scale + n])) & (least != _NONE))


def _near_pairs(key: np.ndarray, at: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal keys, ``least`` to ``most`` places apart: the first place and the distance."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    first, found = np.arange(len(at)), []
    k = 1
    while len(first):
        first = first[first + k < len(at)]
        first = first[(key[first] == key[first + k]) & (at[first + k] - at[first] <= most)]
        apart = at[first + k] - at[first]
        own = apart >= least
        found.append((at[first[own]], apart[own]))
        k += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _from_regions(
    words: np.ndarray, runs: Runs, scale: int, end: int
) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods that highly periodic regions propose."""
    start, stop, period = runs
    least, most = 3 * scale - 1, 6 * scale - 2
    own = (3 * period <= scale) & (stop - start >= least) & (stop <= end)
    start, stop, period = start[own], stop[own], period[own]
    at, apart = _near_pairs(period, stop, least, most)
    places, periods = [at - 1], [apart]
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    touching = (period[1:] == period[:-1]) & (start[1:] <= stop[:-1])
    for i in np.flatnonzero(touching).tolist():
        q, a, b, c, d = (int(x) for x in (period[i], start[i], stop[i], start[i + 1], stop[i + 1]))
        root = words[c : c + q]
        window = np.lib.stride_tricks.sliding_window_view(words[b - 2 * q + 1 : b], q)
        same = np.flatnonzero((window == root).all(axis=1))
        if len(same):
            apart = c - (b - 2 * q + 1 + int(same[0]))
            first = apart + max(0, -(-(least - apart) // q)) * q
            steps = np.arange(first, min(most, (d - a) // 2) + 1, q)
            places.append(np.maximum(a, c - steps))
            periods.append(steps)
    return np.concatenate(places), np.concatenate(periods)


def _extended(
    words: np.ndarray, hashes: Hashes, at: np.ndarray, period: np.ndarray, limits: np.ndarray
) -> Runs:
    """Longest stretches of these periods around these places, from two periods on.

    ``limits`` are the marks between documents, before the first and after the last one.
    """
    doc = np.searchsorted(limits, at, "right")
    first, last = limits[doc - 1] + 1, limits[doc]
    inside = (at >= first) & (at + period < last)
    at, period, first, last = at[inside], period[inside], first[inside], last[inside]

    def search(most: np.ndarray, holds) -> np.ndarray:
        low, high = np.zeros(len(most), np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            good = holds(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    right = search(last - at - period, lambda n: hashes.equal(at, n, period))
    left = search(at - first, lambda n: hashes.equal(at - n, n, period))
    long = left + right >= period
    start, end, period = _unique_periods(at[long] - left[long], (at + right)[long] + period[long], period[long])
    good, again = np.ones(len(start), bool), []
    for i, (s, e, p) in enumerate(zip(start.tolist(), end.tolist(), period.tolist())):
        doc = int(np.searchsorted(limits, s, "right"))
        first, last = int(limits[doc - 1]) + 1, int(limits[doc])
        good[i] = (
            (words[s : e - p] == words[s + p : e]).all()
            and (s == first or words[s - 1] != words[s - 1 + p])
            and (e == last or words[e] != words[e - p])
        )
        if not good[i]:
            again.append((first, last, p))
    found = [(start[good], end[good], period[good])]
    for first, last, p in sorted(set(again)):  # hashes that agree by chance: the document once more, by words
        s, e, q = _shifted(words[first:last], p)
        found.append((s + first, e + first, q))
    return tuple(np.concatenate(x) for x in zip(*found))


def _unique_periods(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> Runs:
    """Each stretch and period once."""
    if not len(start):
        return start, end, period
    rows = np.unique(np.stack([start, end, period]), axis=1)
    return rows[0], rows[1], rows[2]


def all_runs(words: np.ndarray, lengths: np.ndarray) -> Runs:
    """All runs of documents laid one after the other, long ones first, with one mark after each."""
    if not len(lengths):
        return (np.zeros(0, np.int64),) * 3
    limits = np.concatenate([[-1], np.cumsum(lengths + 1) - 1])
    found = [_shifted(words, p) for p in range(1, min(SHIFTED, len(words) - 1) + 1)]
    runs = _joined(found)
    scale = FIRST_SCALE
    if 2 * (3 * scale - 1) <= lengths[0]:
        hashes = Hashes(words)
    while 2 * (3 * scale - 1) <= lengths[0]:
        least, most = 3 * scale - 1, 6 * scale - 2
        documents = int((lengths >= 2 * least).sum())
        end = int(limits[documents])
        places = _places(hashes, runs, scale, end)
        at, period = _near_pairs(hashes.at(places, 2 * scale), places, least, most)
        more_at, more_period = _from_regions(words, runs, scale, end)
        at, period = np.concatenate([at, more_at]), np.concatenate([period, more_period])
        if len(at):
            runs = _joined([runs, _extended(words, hashes, at, period, limits[: documents + 1])])
        scale *= 2
    own = runs[1] - runs[0] >= LEAST
    return tuple(x[own] for x in runs)


def _of_texts(texts: list[str | None]) -> tuple[list[np.ndarray], list[bytes]]:
    """Runs (rows of start, length, period) and kept words of every text."""
    words = [(text or "").encode().split() for text in texts]
    found = [np.zeros((0, 3), np.int64)] * len(words)
    kept = [None] * len(words)
    order = sorted((i for i, own in enumerate(words) if len(own) >= LEAST), key=lambda i: -len(words[i]))
    numbers = Numbers()
    arrays, lengths = [], np.array([len(words[i]) for i in order], np.int64)
    for i in order:
        arrays.append(np.fromiter(map(numbers.__getitem__, words[i]), np.int64, len(words[i])))
    many = len(numbers)
    marked = [part for k, own in enumerate(arrays) for part in (own, [many + k])]
    start, end, period = all_runs(np.concatenate(marked) if marked else np.zeros(0, np.int64), lengths)
    offsets = edges(lengths + 1)
    doc = np.searchsorted(offsets, start, "right") - 1
    at = np.searchsorted(doc, np.arange(len(order) + 1))
    for k, i in enumerate(order):
        a, b = at[k], at[k + 1]
        if a == b:
            continue
        own = np.stack([start[a:b] - offsets[k], end[a:b] - start[a:b], period[a:b]], axis=1)
        found[i] = own[np.lexsort((own[:, 2], own[:, 0]))]
        step = np.zeros(len(words[i]) + 1, np.int64)
        np.add.at(step, own[:, 0] + own[:, 2], 1)
        np.add.at(step, own[:, 0] + own[:, 1], -1)
        kept[i] = compress(words[i], (np.cumsum(step[:-1]) == 0).tolist())
    return found, [b" ".join(words[i] if own is None else own) for i, own in enumerate(kept)]


def find_runs(docs: DataFrame, column: str, keep: list[str]) -> DataFrame:
    """``row``, all ``runs`` (start, length, period; by start, then period), the ``best`` one and the text without repeats.

    The best has the greatest length, then the smallest start, then the smallest period. ``collapsed`` holds,
    joined by one blank, the words that no run contains after its first period.
    """
    row = F.struct(*[F.col(quoted(c)) for c in keep]).alias("row")
    given = docs.select(F.col(quoted(column)).alias("value"), row)
    run = "struct<start:long,length:long,period:long>"
    schema = StructType([given.schema["row"], *StructType.fromDDL(f"runs array<{run}>, best {run}, collapsed string")])

    def structs(rows: np.ndarray) -> pa.StructArray:
        return pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(3)], ["start", "length", "period"])

    def make(batch: pa.RecordBatch) -> Iterator[dict[str, pa.Array]]:
        texts = batch.column(0)
        sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts])
        for a, b in slices(sizes, 6 * WORDS):
            found, collapsed = _of_texts(texts[a:b].to_pylist())
            counts = [len(x) for x in found]
            every = np.concatenate(found)
            best = [x[np.lexsort((x[:, 2], x[:, 0], -x[:, 1]))[0]] if len(x) else (0, 0, 0) for x in found]
            none = pa.array([n == 0 for n in counts])
            first = structs(np.array(best, np.int64).reshape(-1, 3))
            yield {
                "row": batch.column(1)[a:b],
                "runs": pa.ListArray.from_arrays(pa.array(edges(counts), pa.int32()), structs(every)),
                "best": pa.StructArray.from_arrays([first.field(k) for k in range(3)], ["start", "length", "period"], mask=none),
                "collapsed": pa.array(collapsed, pa.string()),
            }

    return arrow_pass(given, make, schema)
