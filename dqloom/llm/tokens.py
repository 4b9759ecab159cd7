"""Token counts: byte-pair merging with a heap and a linked list.

A text is cut into pieces by the tokenizer's own pattern. For each piece the lowest-ranked pair
of neighbours is popped from a heap and merged in a linked list until no pair has a rank; the
count is the initial symbols minus the merges. No identifiers are made. A worker remembers the
counts of pieces it has met, up to ``REMEMBERED``; the memory is emptied when full, which costs
time, never rows.

Null and empty texts have 0 tokens. Added special strings inside a text are one token each, as the
library reads them by default. Rows are independent: repeated rows and ids give repeated results,
and further columns of the input are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
import re

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from dqloom.llm.common import arrow_pass, texts_of

REMEMBERED = 400_000
_SPACE = r"\t-\r \x85\xa0  -     　"
_ENDINGS = r"'s|'t|'re|'ve|'m|'ll|'d"
#: The byte-level pattern with white space spelt out as the Unicode property has it.
FULL = regex.compile(
    rf"{_ENDINGS}| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
#: The same for texts of Latin letters and ASCII digits only, with the faster standard module; words, which no ending
#: begins like, are tried first.
LATIN = re.compile(
    rf" ?[^\W\d_]+|{_ENDINGS}| ?\d+| ?(?:[^{_SPACE}\w]|_)+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
NOT_LATIN = re.compile("[^\x00-\xb1\xb4-\xb8\xba\xbb\xbf-ɏ‐-‧€]")


def pieces(text: str) -> list[str]:
    """The pieces of a text that byte pairs are merged within."""
    return (FULL if NOT_LATIN.search(text) else LATIN).findall(text)


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(rest)) for b in range(256)]


def merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Tokens left after all merges of one piece."""
    n = len(symbols)
    if n < 2:
        return n
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    parts: list[str | None] = list(symbols)
    heap = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            heap.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, first, second = heapq.heappop(heap)
        j = right[i]
        if parts[i] != first or j >= n or parts[j] != second:
            continue  # one of them has been merged since
        joined = first + second
        parts[i], parts[j] = joined, None
        right[i] = k = right[j]
        merges += 1
        if k < n:
            left[k] = i
            rank = ranks.get((joined, parts[k]))
            if rank is not None:
                heapq.heappush(heap, (rank, i, joined, parts[k]))
        h = left[i]
        if h >= 0:
            rank = ranks.get((parts[h], joined))
            if rank is not None:
                heapq.heappush(heap, (rank, h, parts[h], joined))
    return n - merges


class PieceCounts(dict):
    """Token counts by piece, counted when first asked for."""

    def __init__(self, ranks: dict[tuple[str, str], int]) -> None:
        super().__init__()
        self.ranks, self.letters = ranks, byte_letters()

    def __missing__(self, piece: str) -> int:
        letters = self.letters
        count = merge_count([letters[b] for b in piece.encode()], self.ranks)
        if len(self) >= REMEMBERED:
            self.clear()
        self[piece] = count
        return count


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> tuple[PieceCounts, re.Pattern | None]:
    """Merge ranks and the pattern of special strings of a byte-level vocabulary file."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    merges = content["model"]["merges"]
    pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in merges]
    special = sorted((t["content"] for t in content["added_tokens"]), key=len, reverse=True)
    pattern = re.compile("|".join(map(re.escape, special))) if special else None
    return PieceCounts({pair: rank for rank, pair in enumerate(pairs)}), pattern


def count_tokens(text: str, path: str) -> int:
    """Tokens of one text."""
    counts, special = vocabulary(path)
    parts = special.split(text) if special else [text]
    total = len(parts) - 1
    for part in parts:
        if part:
            total += sum(map(counts.__getitem__, pieces(part)))
    return total


def with_token_counts(docs: DataFrame, path: str, limit: int, id_column: str = "doc_id") -> DataFrame:
    """Id, UTF-8 length, tokens, and whether they are over the limit, of every text."""

    def make(batch):
        texts = texts_of(batch.column(1))
        sizes = [len(text.encode()) for text in texts]
        counts = [count_tokens(text, path) for text in texts]
        yield {
            id_column: batch.column(0),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_tokens": pa.array(counts, pa.int64()),
            "over_limit": pa.array([n > limit for n in counts], pa.bool_()),
        }

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return arrow_pass(docs.select(id_column, "text"), make, schema)
