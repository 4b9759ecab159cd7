from __future__ import annotations

import random

import numpy as np
import pytest

from dqloom.llm import ann, suffix_dedup

L = suffix_dedup.LENGTH


def plain(rows):
    """Removed bytes of every row, by looking up all strings."""
    first = {}
    for i, text in rows:
        data = (text or "").encode()
        for s in range(len(data) - L + 1 if i is not None else 0):
            key = data[s:s + L]
            first[key] = min(i, first.get(key, i))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - L + 1 if i is not None else 0):
            if first[data[s:s + L]] < i:
                gone[s:s + L] = b"\1" * L
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(data), sum(gone), spans, kept))
    return sorted(out, key=repr)


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdé ñ."
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [text(n) for n in (30, 48, 49, 50, 51, 52, 80, 300, 2000)]
    rows = []
    for i in range(60):
        parts = [rng.choice([text(rng.randrange(120)), rng.choice(passages), rng.choice(passages)[5:]]) for _ in range(rng.randrange(8))]
        rows.append((rng.choice([i * 3, 100 - i]), "".join(parts)))
    rows += [(500, rows[3][1]), (501, rows[3][1] + "x"), (502, "ab" * 3000), (503, "b" + "ab" * 100), (503, "ab" * 90), (504, "z" * 49), (505, "z" * 50), (506, "z" * 51)]
    return rows + [(507, None), (508, ""), (None, "ab" * 60), (None, None), (7, passages[-1]), (7, passages[-1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_removed_bytes_against_all_strings(spark, monkeypatch, seed):
    monkeypatch.setattr(suffix_dedup, "HELD", 3000)
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, kept string, rid int")
    found = suffix_dedup.remove_repeats(docs).collect()
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == plain(rows)
    clean = suffix_dedup.without_repeats(docs)
    assert clean.columns == docs.columns
    whole = sorted(((r.doc_id, r.text) for r in clean.collect() if r.doc_id in (502, 504, 507, 508) or r.doc_id is None), key=repr)
    assert whole == sorted(((i, t) for i, t in rows if i in (502, 504, 507, 508) or i is None), key=repr)


def test_runs_of_strings_travel_packed(spark, monkeypatch):
    """A footer in all documents gives each some runs; they must not become rows of their own."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    footers = [text(90), text(300)]
    rows = [(i, text(100) + rng.choice(footers) + text(rng.randrange(60))) for i in range(400)]
    rows += [(500, None), (None, rows[0][1]), (7, rows[8][1])]
    written = {}
    cut = suffix_dedup.cut

    def counted(frame, name, *more):
        table = cut(frame, name, *more)
        written[name] = table.count()
        return table

    monkeypatch.setattr(suffix_dedup, "cut", counted)
    monkeypatch.setattr(suffix_dedup, "BUNDLE", 10_000, raising=False)
    monkeypatch.setattr(suffix_dedup, "SLICE", 20_000, raising=False)
    found = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted(((r.row.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in found), key=repr)
    assert got == plain(rows)
    assert sum(n for name, n in written.items() if name not in ("phrases", "parsed")) < 2 * len(rows), written


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(docs).count() == suffix_dedup.without_repeats(docs).count() == 0


def test_every_string_lies_in_a_phrase():
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 100, n, dtype=np.uint8)) for n in (0, 49, 50, 700, 5000)]
    buffer = suffix_dedup.Buffer(texts)
    owner, start, end = suffix_dedup.phrase_bounds(buffer)
    for k, text in enumerate(texts):
        inside = {s for o, a, b in zip(owner, start - buffer.starts[owner], end - buffer.starts[owner]) if o == k for s in range(a, b - L + 1)}
        assert inside == set(range(max(0, len(text) - L + 1)))


# --- nearest neighbours ---------------------------------------------------------------------


def brute(rows, queries, k):
    best = {}
    for q, v in rows:
        if q in queries:
            for i, w in rows:
                if i != q:
                    s = float((np.array(v, float) * np.array(w, float)).sum())
                    best.setdefault(q, {})[i] = max(s, best.get(q, {}).get(i, -9e9))
    return {q: sorted(((-s, i) for i, s in c.items()))[:k] for q, c in best.items()}


def test_small_tables_ties_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(60)]
    rows += [(i, rows[3][1]) for i in range(100, 140)]  # a very common vector
    rows += [(7, rows[8][1])]
    odd = [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (205, [1.0] * 7), (206, []), (None, [1.0] * 8)]
    table = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], "vec_id long, embedding array<float>, v int, list string")
    found = ann.search(table, ann.F.col("id") % 20 == 0, 20).collect()
    want = brute(rows, {0, 20, 40, 100, 120}, 20)
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits / 100 >= 0.9
    assert got[100] == want[100]  # all copies tie: the smallest ids, in order
    for q, pairs in got.items():
        scores = {i: s for s, i in brute(rows, {q}, 500)[q]}
        assert pairs == sorted(pairs) and all(abs(s - scores[i]) < 1e-12 for s, i in pairs)


def test_recall_on_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = ann.search(table, ann.F.col("id") % 20 == 0, 20).collect()
    rows = table.collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = {}
    for r in found:
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for i in np.flatnonzero(ids % 20 == 0):
        score = x @ x[i]
        score[i] = -np.inf
        recall.append(len(got[ids[i]] & set(ids[np.lexsort((ids, -score))[:20]].tolist())) / 20)
    assert np.mean(recall) >= 0.95


def test_lists_in_parts_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 7)
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(table, ann.F.col("id") % 2 == 0, 5).collect()
    want = brute(rows, set(range(0, 150, 2)), 5)
    hits = sum((-r.score, r.vec_id) in [(pytest.approx(s), i) for s, i in want[r.query_id]] for r in found)
    assert len(found) == 75 * 5 and hits / len(found) >= 0.9


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), ann.F.col("id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], schema)
    assert ann.search(one, ann.F.col("id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 1.0])], schema)
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in ann.search(two, ann.F.col("id") % 20 == 0).collect()] == [(0, 1, 1, 5.0)]
