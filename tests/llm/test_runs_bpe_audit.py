from __future__ import annotations

import hashlib
import random
import zlib
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import Row
from tokenizers import Tokenizer

from dqloom.llm import audit, blocks, bpe, registered, runs
from dqloom.llm.registered import BYTE_BPE

CLASH = "doc_id long, text string, lang string, source string, n_chars long, block string, runs string, ids string"


def plain_runs(words):
    """All runs by trying every period at every place."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def made(rng):
    """Words with many periods: small alphabets, powers of powers, Fibonacci words, regions in step."""
    n, kind = rng.randint(0, 300), rng.random()
    words = [str(rng.randrange(rng.choice([1, 2, 3, 50]))) for _ in range(n)]
    if kind < 0.3 and n:
        p = rng.randint(1, n)
        words = [words[i % p] for i in range(n)]
        words[rng.randrange(n)] = "x"
    elif kind < 0.6:
        words = []
        while len(words) < n:
            words += [str(rng.randrange(3)) for _ in range(rng.randint(1, 6))] * rng.randint(1, 30)
            words += words[-rng.randint(1, len(words)):]
    elif kind < 0.7:
        a, words = ["a"], ["a", "b"]
        while len(words) < n:
            a, words = words, words + a
    elif kind < 0.8:
        root = [str(rng.randrange(2)) for _ in range(rng.randint(1, 3))] * 60
        words = root[: rng.randint(5, 90)] + root[rng.randint(0, 2):][: rng.randint(5, 90)]
        words *= rng.randint(1, 3)
    return words[:300]


def test_runs_are_those_of_a_plain_search():
    rng = random.Random(5)
    for _ in range(60):
        texts = [made(rng) for _ in range(rng.randint(1, 12))]
        found, collapsed = runs._of_texts([" ".join(w) for w in texts])
        for words, own, kept in zip(texts, found, collapsed):
            plain = plain_runs(words)
            assert [tuple(r) for r in own.tolist()] == plain
            assert kept.decode() == plain_collapse(words, plain)


def test_wrong_hashes_change_nothing(monkeypatch):
    """Where hashes agree by chance, words decide."""
    whole = runs.Hashes.equal
    monkeypatch.setattr(runs.Hashes, "equal", lambda self, start, width, shift: whole(self, start, width, shift) | (width % 7 > 2))
    rng = random.Random(6)
    for _ in range(20):
        texts = [made(rng) for _ in range(4)]
        found, _ = runs._of_texts([" ".join(w) for w in texts])
        assert [[tuple(r) for r in own.tolist()] for own in found] == [plain_runs(w) for w in texts]


def test_runs_of_a_table(spark):
    texts = ["", " \t\n", "a " * 12, "a " * 11, "a b " * 6 + "a", "ü\x0bß\x0c " * 40, ("lorem ipsum " * 30).upper()]
    rows = [(i, t, None, "s", 1, "b", "r", "i") for i, t in enumerate(texts)]
    rows += [(7, None, *[None] * 6), (None, "a " * 12, *[None] * 6), (2, "a " * 12, None, "s", 1, "b", "r", "i")]
    found = runs.find_runs(spark.createDataFrame(rows, CLASH), "text", ["doc_id", "runs"]).collect()
    assert len(found) == len(rows)
    of = {r.row.doc_id: r for r in found}
    for i, text in [*enumerate(texts), (7, ""), (None, "a " * 12)]:
        words = [w.decode() for w in text.encode().split()]
        plain = plain_runs(words)
        assert [tuple(r) for r in of[i].runs] == plain
        assert of[i].collapsed == plain_collapse(words, plain)
        assert of[i].best == (Row(start=0, length=len(words), period=plain[0][2]) if plain else None)
    assert runs.find_runs(spark.createDataFrame([], CLASH), "text", ["doc_id"]).count() == 0


def test_the_best_run_is_the_longest_then_the_first(spark):
    words = ["a"] * 14 + ["x"] + ["b"] * 14 + ["y"] + ["c"] * 13
    best = runs.find_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string"), "text", ["doc_id"]).first().best
    assert tuple(best) == (0, 14, 1)


def test_runs_of_a_very_long_text():
    rng = random.Random(7)
    words = [str(rng.randrange(10**6)) for _ in range(200_000)]
    text = words + words[-60_000:] + words[-60_000:][:5_000] + ["end"] * 1000
    (found,), (kept,) = runs._of_texts([" ".join(text)])
    assert [tuple(r) for r in found.tolist()] == [(140_000, 125_000, 60_000), (265_000, 1000, 1)]
    assert kept.decode() == " ".join(words + ["end"])


def expected_runs(doc_id, text):
    """The digest columns of a document, by the plain search."""
    words = [w.decode() for w in (text or "").encode().split()]
    n, check = len(words), zlib.crc32(str(doc_id).encode())
    if check % 10 == 0 and n:
        g = check // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (
        doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(plain_collapse(words, found).encode()).hexdigest(),
    )


def test_query_of_runs(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, " ".join(made(rng))) for i in range(120)] + [(200 + i, None) for i in range(15)]
    rows += [(300 + i, " ".join(str(rng.randrange(40)) for _ in range(200))) for i in range(120)]
    frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    found = registered.op11(spark, str(tmp_path))
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected_runs(i, t) for i, t in rows)


def hard_texts():
    rng = random.Random(3)
    pool = "aé ßñ _-'\n\t\r\x0b\x1c\x1d\x85\xa0  　½²٣字😀<|endoftext|>'s'll12  ZÀ́؀\x00"
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    return made + ["", " ", "  a", "a" * 5000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "ab " * 3000, "\n\n \n"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.mark.parametrize("block", [blocks.BLOCK_BYTES, 300])
def test_ids_and_texts_are_those_of_the_library(spark, library, monkeypatch, block):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block)
    monkeypatch.setattr(blocks, "BUCKET_WORDS", block)
    texts = hard_texts()
    rows = [(i, t, None, "s", 1, "b", "r", "clash") for i, t in enumerate(texts)]
    rows += [(-1, None, *[None] * 6), (None, "twin", *[None] * 6), (None, "twin", *[None] * 6)]
    docs = spark.createDataFrame(rows, CLASH).repartition(3)
    both = bpe.encode_and_decode(docs, BYTE_BPE, ["doc_id", "ids", "block"]).collect()
    assert len(both) == len(rows)
    of = {r.row.doc_id: r for r in both}
    for i, text in [*enumerate(texts), (-1, ""), (None, "twin")]:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bytes(of[i].ids) == np.array(ids, "<u4").tobytes(), repr(text)
        assert of[i].decoded == library.decode(ids, skip_special_tokens=False), repr(text)


def test_decoding_any_ids(spark, library):
    rng = random.Random(4)
    lists = [[rng.randrange(50257) for _ in range(rng.randint(0, 40))] for _ in range(60)] + [[], [50256], [99999, 5]]
    rows = [(i, bytearray(np.array(ids, "<u4").tobytes())) for i, ids in enumerate(lists)] + [(-1, None)]
    found = bpe.decode(spark.createDataFrame(rows, "doc_id long, ids binary"), BYTE_BPE, ["doc_id"])
    of = {r.row.doc_id: r.decoded for r in found.collect()}
    assert of.pop(-1) == ""
    assert of == {i: library.decode(ids, skip_special_tokens=False) for i, ids in enumerate(lists)}


def test_encoding_an_empty_table_and_texts_without_words(spark):
    empty = spark.createDataFrame([], CLASH)
    assert bpe.encode_and_decode(empty, BYTE_BPE, ["doc_id"]).count() == 0
    blank = bpe.encode(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string"), BYTE_BPE, ["doc_id"])
    assert [bytes(r.ids) for r in blank.collect()] == [b"", b""]


def test_texts_of_some_megabytes(spark, library):
    rng = random.Random(9)
    long = " ".join(str(rng.randrange(10**5)) for _ in range(900_000))
    rows = [(1, long), (2, "x" * 200_000), (3, "short")]
    found = bpe.encode_and_decode(spark.createDataFrame(rows, "doc_id long, text string"), BYTE_BPE, ["doc_id"])
    of = {r.row.doc_id: r for r in found.collect()}
    for i, text in rows:
        assert of[i].decoded == text
        assert len(of[i].ids) == 4 * len(library.encode(text, add_special_tokens=False).ids)


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28 - 1, 2**28, 2**31])
    data, sizes = blocks.packed(numbers)
    assert blocks.unpacked(data.tobytes()).tolist() == numbers.tolist()
    assert sizes.tolist() == [1, 1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def plain_audit(docs, labels):
    """Rows of the audit, by judging every document for every order."""
    least, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    for i, quality, bad in labels:
        good |= {i} if quality == 1 else set()
        toxic |= {i} if bad == 1 else set()

    def fails(i, text):
        words = text.encode().split()
        return {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > least.get(text, i),
        }

    judged = [(source or "", i, fails(i, text or "")) for i, text, source in docs]
    rows = {}
    for order in map("".join, permutations("ABCDE")):
        for part in {j[0] for j in judged}:
            for step, f in enumerate(order):
                own = [(i, x) for p, i, x in judged if p == part]
                left = [(i, x) for i, x in own if not any(x[e] for e in order[:step])]
                removed = [i for i, x in left if x[f]]
                rows[part, order, step + 1, f] = [
                    len(left) - len(removed), len(removed), sum(x[f] for _, x in own) - len(removed),
                    sum(x[f] and sum(x.values()) == 1 for _, x in own),
                    sum(i in good for i in removed if i is not None), sum(i in toxic for i in removed if i is not None),
                ]
    total = {}
    for (part, _, _, f), values in rows.items():
        total[part, f] = total.get((part, f), 0) + values[1]
    return sorted((*key, *values, total[key[0], key[3]]) for key, values in rows.items())


def test_audit_is_that_of_every_order(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(blocks, "BUCKET_WORDS", 90)
    monkeypatch.setattr(audit, "LONG", 700)
    rng = random.Random(11)
    pool = [" ".join(rng.choice(["a", "b", "Cap", "d#", "é", f"w{rng.randrange(500)}"]) for _ in range(rng.randint(0, 140))) for _ in range(40)]
    pool += [" " * 2000, "x" * 2000, "A\x0b" * 900, " ".join(f"v{i}" for i in range(400)), None, ""]
    docs = [(i, rng.choice(pool), rng.choice(["s", "t", "", None])) for i in range(160)]
    docs += [(None, pool[0], "s"), (None, pool[0], "s"), (3, docs[3][1], "s"), (3, "other", "t")]
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i in range(0, 160, 2)] + [(4, 1, None), (4, None, 1), (None, 1, 1)]
    table = spark.createDataFrame([(i, t, s, "clash") for i, t, s in docs], "doc_id long, text string, source string, mask string").repartition(3)
    found = audit.audit(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(docs, labels)


def test_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audit.audit(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_the_matrix_has_the_words_of_the_documents(spark):
    texts = ["b a b", "", "a c", "c c c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    (shard,) = audit.term_matrix(docs, ["doc_id"]).collect()
    assert shard.pointers == [0, 2, 2, 4, 5] and sorted(set(shard.columns)) == [0, 1, 2]
    assert [r.row.doc_id for r in shard.rows] == [0, 1, 2, 3]
    cells = {}
    for i in range(4):
        for k in range(shard.pointers[i], shard.pointers[i + 1]):
            cells[i, shard.columns[k]] = shard.counts[k]
    a = next(c for c in range(3) if cells.get((0, c)) == 1)
    assert sum(cells.values()) == 8 and (2, a) in cells and max(cells.values()) == 3
