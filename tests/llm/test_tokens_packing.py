from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from dqloom.llm import packing, tokens
from dqloom.llm.registered import BYTE_BPE

SCHEMA = "doc_id long, text string, n_tokens string, ids string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def hard_texts() -> list[str]:
    random.seed(3)
    pool = "aé ßñ _-'\n\t\r\x0b\x1c\x1d\x85\xa0  　½²٣字😀<|endoftext|>'s'll12  ZÀ́؀\x00"
    made = ["".join(random.choice(pool) for _ in range(random.randint(0, 60))) for _ in range(300)]
    latin = "aé ß'_-1\n\t\x1c\x85\xa0 ·«»x"
    made += ["".join(random.choice(latin) for _ in range(random.randint(0, 60))) for _ in range(300)]
    return made + ["", " ", "  a", "a" * 5000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "ab " * 3000, "\n\n \n"]


def test_counts_are_those_of_the_library(spark, library):
    texts = hard_texts()
    rows = [(i, t, "clash", None) for i, t in enumerate(texts)] + [(None, None, None, None), (1, "again", None, None)]
    found = tokens.with_token_counts(spark.createDataFrame(rows, SCHEMA), BYTE_BPE, 4).collect()
    assert len(found) == len(rows)
    for row in found:
        if row.doc_id is None:
            assert (row.n_bytes, row.n_tokens, row.over_limit) == (0, 0, False)
    got = {(r.doc_id, r.n_bytes): r for r in found}
    for i, text in enumerate(texts):
        row = got[i, len(text.encode())]
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids), repr(text)
        assert row.over_limit == (row.n_tokens > 4)


def test_counts_of_an_empty_table(spark):
    assert tokens.with_token_counts(spark.createDataFrame([], SCHEMA), BYTE_BPE, 4).count() == 0


def test_merging_follows_ranks():
    ranks = {("a", "b"): 1, ("b", "c"): 0, ("a", "bc"): 2, ("abc", "abc"): 3}
    assert tokens.merge_count(list("abcabc"), ranks) == 1
    assert tokens.merge_count(list("aab"), ranks) == 2
    assert tokens.merge_count([], ranks) == 0


def packed_sequences(rows, most):
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at and r.length > 0
            at += r.length
        assert at == own[0].sequence_length <= most
    return sequences


def padding(sequences, most):
    lengths = [s[0].sequence_length for s in sequences.values()]
    return sum(most - n for n in lengths if n & (n - 1)) / max(1, sum(lengths))


def test_every_id_lies_in_one_piece(spark, library):
    texts = hard_texts()
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(None, None, None, None), (9000, "twin", None, None), (9000, "twin", None, None)]
    found = packing.pack_documents(spark.createDataFrame(rows, SCHEMA), BYTE_BPE, 256, 1).collect()
    of = {}
    for r in found:
        of.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        own = sorted(of[i], key=lambda r: r.start)
        assert [x for r in own for x in r.ids] == ids
        at = 0
        for r in own:
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
    assert [list(r.ids) for r in of[None]] == [[1]]
    assert len(of[9000]) >= 2
    assert padding(packed_sequences(found, 256), 256) < 0.03


def test_packing_an_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), BYTE_BPE).count() == 0


def test_best_fit_takes_the_tightest_window():
    items = [(0, 0, 70), (1, 0, 60), (2, 0, 40), (3, 0, 30)]
    windows = packing.best_fit(items, 100)
    assert [[p[0] for p in w] for w in windows] == [[0, 3], [1, 2]]


@pytest.mark.parametrize("most", [7, 64, 2048])
def test_tree_against_a_plain_search(most):
    random.seed(most)
    tree, rooms = packing.CapacityTree(most), {}
    for window in range(400):
        room = random.randint(1, most)
        tree.put(room, window)
        rooms[window] = room
        need = random.randint(1, most)
        fitting = [r for r in rooms.values() if r >= need]
        found = tree.take(need)
        if not fitting:
            assert found is None
        else:
            assert found[0] == min(fitting) and rooms.pop(found[1]) == found[0]


@pytest.mark.parametrize("lengths", [[], [1], [2048], [5000, 1, 1], [1100] * 400, list(range(1, 2049)), [1500, 600] * 300])
def test_little_padding_for_any_mix(lengths):
    windows = packing.pack_lengths(lengths, 2048)
    used = [sum(p[2] for p in w) for w in windows]
    assert sum(used) == sum(lengths) and all(0 < n <= 2048 for n in used)
    covered = sorted((row, s, n) for w in windows for row, s, n in w)
    at = {}
    for row, s, n in covered:
        assert at.get(row, 0) == s
        at[row] = s + n
    assert all(at[i] == n for i, n in enumerate(lengths))
    assert sum(2048 - n for n in used if n & (n - 1)) <= 0.03 * sum(lengths) + 2048


def test_pieces_are_asked_for_once(monkeypatch):
    """Pieces were gathered in sets first and looked up again; each went through the whole tokenizer."""
    encode = packing.PieceIds(BYTE_BPE)
    texts = [t or "" for t in hard_texts()]
    plain = [t for t in texts if not any(s in t for s in encode.special)]
    want = [np.array(encode.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in plain]
    monkeypatch.setattr(encode, "_library", None)
    for _ in range(2):
        assert all(np.array_equal(a, b) for a, b in zip(encode(plain), want, strict=True))
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    again = packing.PieceIds(BYTE_BPE)
    assert all(np.array_equal(a, b) for a, b in zip(again(plain), want, strict=True))
    assert len(again.known) <= 3
