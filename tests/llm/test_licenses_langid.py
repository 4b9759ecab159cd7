from __future__ import annotations

import random

import numpy as np
import pytest

from dqloom.llm import langid, licenses
from dqloom.llm.license_notices import NOTICES

LONG = dict(NOTICES)["MIT-text"]


def scan(spark, rows, templates=NOTICES):
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, license string, h int")
    found = licenses.find_licenses(docs, spark.createDataFrame(list(templates), "license string, text string"))
    return sorted(((r.row.doc_id, r.license, r.first_word, r.n_matched, r.n_template) for r in found.collect()), key=repr)


@pytest.mark.parametrize("at_once", [licenses.AT_ONCE, 3])
def test_notices_in_texts(spark, monkeypatch, at_once):
    monkeypatch.setattr(licenses, "AT_ONCE", at_once)
    filler = "le la mais " * 40_000
    rows = [
        (1, "x RELEASED under, the MIT\nLicense. y"), (1, "x RELEASED under, the MIT\nLicense. y"),
        (2, "Released under the MIT"), (3, None), (4, ""), (5, "..."), (None, "Licensed under CC BY-NC 4.0"),
        (6, filler + LONG), (7, "the license"), (8, LONG.replace("charge", "cost")),
    ]
    found = scan(spark, rows)
    of = {}
    for doc, name, first, matched, n in found:
        of.setdefault((doc, name), []).append((first, matched, n))
    assert of[1, "MIT"] == [(2, 3, 3)] * 2
    assert of[None, "CC-BY-NC-4.0"] == [(1, 5, 5)]
    assert of[6, "MIT-text"][0][0] == 120_001 and of[6, "MIT-text"][0][1] == of[6, "MIT-text"][0][2]
    assert of[8, "MIT-text"][0][1] == of[8, "MIT-text"][0][2] - 3
    assert {k[0] for k in of} == {1, None, 6, 8}


def test_empty_tables(spark):
    assert scan(spark, []) == []
    assert scan(spark, [(1, "Released under the MIT License")], [("none", None), ("blank", " . ")]) == []


def test_any_place_is_retrieved(spark):
    random.seed(2)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for i in range(300):
        text = [random.choice(words) for _ in range(random.randint(0, 30))]
        at = random.randint(0, len(text))
        rows.append((i, " ".join([*text[:at], "released under the mit license", *text[at:]])))
    assert [r[0] for r in scan(spark, rows, NOTICES[:1])] == sorted(range(300), key=str)


def test_any_short_template_is_retrieved(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    templates, rows = [], []
    for t in range(120):
        own = " ".join(rng.choice(words) for _ in range(3 + t % 5))
        templates.append((f"t{t}", own))
        for k in range(20):
            before, after = ([rng.choice(words) for _ in range(rng.randint(0, 12))] for _ in range(2))
            rows.append((t * 20 + k, " ".join([*before, own, *after])))
    found = {(doc, name) for doc, name, *_ in scan(spark, rows, templates)}
    assert {(doc, f"t{doc // 20}") for doc, _ in rows} <= found


LINES = {
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "All-rights-reserved": "All rights reserved.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
}


def test_license_lines_of_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    found = licenses.find_licenses(docs, spark.createDataFrame(NOTICES, "license string, text string"))
    of = {}
    for r in found.select("row.doc_id", "license").collect():
        of.setdefault(r.license, set()).add(r.doc_id)
    texts = docs.collect()
    for name, line in LINES.items():
        plain = {r.doc_id for r in texts if line in (r.text or "")}
        assert plain and plain <= of.get(name, set()), name


def test_every_notice_finds_itself(spark):
    found = scan(spark, [(i, f"some words {text} and more") for i, (_, text) in enumerate(NOTICES)])
    whole = {(doc, name) for doc, name, _, matched, n in found if matched == n}
    assert {(i, name) for i, (name, _) in enumerate(NOTICES)} <= whole
    assert len({name for name, _ in NOTICES}) == len(NOTICES)


# --- language identification ----------------------------------------------------------------


def labelled(n=240):
    random.seed(4)
    pools = {"aa": "lorem ipsum dolor sit amet".split(), "bb": "žluť kůň úpěl ďábel ódy".split(), "cc": "хлеб соль вода небо".split()}
    rows = []
    for i in range(n):
        lang = random.choice(list(pools))
        rows.append((i, " ".join(random.choice(pools[lang]) for _ in range(random.randint(3, 120))), lang, 9.0))
    return rows


def test_languages_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 120)
    rows = labelled()
    extra = [(1000, None, "aa", 1.0), (1001, "", "bb", 1.0), (1002, "123 ... 😀", "cc", 1.0), (1003, "хлеб" * 30_000, None, None), (None, "вода небо соль", None, None), (None, "вода небо соль", None, None)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, lang string, score double")
    model = langid.train(docs, langid.learnable())
    assert model.languages == ("aa", "bb", "cc")
    found = langid.with_language(docs.select("doc_id", "text", "lang"), model, ["doc_id", "lang"]).collect()
    assert len(found) == len(rows) + len(extra)
    known = [r for r in found if r.doc_id is not None and r.doc_id < 1000]
    assert sum(r.lang_pred == r.lang for r in known) / len(known) > 0.98
    assert all(0 <= r.score <= 1 for r in found)
    others = {r.doc_id: (r.lang_pred, r.score) for r in found if r.doc_id is None or r.doc_id >= 1000}
    assert others[1000] == others[1001] == others[1002] == ("und", 0.0)
    assert others[1003][0] == others[None][0] == "cc"
    again = langid.with_language(docs.select("doc_id", "text"), langid.train(docs, langid.learnable()), ["doc_id"])
    assert sorted(map(repr, again.select("lang_pred", "score").collect())) == sorted(repr(type(r)(lang_pred=r.lang_pred, score=r.score)) for r in again.collect())


def test_training_never_sees_the_held_out_fold(spark):
    rows = spark.range(2000).withColumn("out", langid.held_out("id")).collect()
    import zlib

    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(0, "some text", None)], "doc_id long, text string, lang string")
    model = langid.train(docs, langid.learnable())
    assert langid.with_language(docs, model, ["doc_id"]).first().lang_pred == "und"
    assert langid.with_language(docs.limit(0), model, ["doc_id"]).count() == 0


def test_held_out_accuracy_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, langid.learnable())
    found = langid.with_language(docs, model, ["doc_id", "lang"]).where(langid.held_out()).collect()
    right = sum(r.lang == r.lang_pred for r in found) / len(found)
    assert right > 0.95


def _plain_prediction(model, text):
    """Language and score of one text, window by window, straight from the weights."""
    data, w = text.encode(), model.weights
    scores, weights = [], []
    for start in range(0, len(data), langid.WINDOW):
        window = data[start : start + langid.WINDOW]
        vectors = [w["embedding"][b] for b in window.ljust(langid.WINDOW, b"\0")]
        features = []
        for width in langid.WIDTHS:
            out = [
                sum(vectors[i + j] @ w[f"filter{width}"][j] for j in range(width)) + w[f"bias{width}"]
                for i in range(langid.WINDOW - width + 1)
            ]
            features.append(np.max(out, axis=0))
        z = np.maximum(np.concatenate(features), 0) @ w["out"] + w["out_bias"]
        e = np.exp(z - z.max())
        scores.append(e / e.sum())
        weights.append(len(window))
    mean = np.average(scores, axis=0, weights=weights)
    return model.languages[int(mean.argmax())], float(mean.max())


def test_predictions_equal_the_plain_forward_pass(spark):
    rng = random.Random(4)
    words = {"aa": "the of and house river", "bb": "der und haus fluss nicht", "cc": "la casa el río que"}
    rows = [(i, " ".join(rng.choices(words[lang].split(), k=40)), lang)
            for i, lang in enumerate(rng.choices(sorted(words), k=90))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, langid.learnable())
    texts = [rows[0][1], rows[1][1] * 9, "x", "río " * 200, "日本 text " * 70, "a" * 256, "b" * 257, "der " + "\0" * 300]
    frame = spark.createDataFrame(list(enumerate([*texts, None, "", "12 34 !"])), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in langid.with_language(frame, model, ["doc_id"]).collect()}
    for i, text in enumerate(texts):
        lang, score = _plain_prediction(model, text)
        assert found[i][0] == lang and found[i][1] == pytest.approx(score, abs=1e-5)
    assert [found[i] for i in range(len(texts), len(texts) + 3)] == [(langid.UNKNOWN, 0.0)] * 3


def test_ties_go_to_the_language_that_sorts_first(spark):
    model = langid.fit([b"abc"], ["zz"])
    weights = {name: np.zeros_like(value) for name, value in model.weights.items()}
    weights["out"] = np.zeros((weights["out"].shape[0], 3))
    weights["out_bias"] = np.zeros(3)
    even = langid.Model(("aa", "mm", "zz"), weights)
    frame = spark.createDataFrame([(1, "any text"), (2, "any text")], "doc_id long, text string")
    found = langid.with_language(frame, even, ["doc_id"]).collect()
    assert {(r.doc_id, r.lang_pred, round(r.score, 6)) for r in found} == {(1, "aa", 0.333333), (2, "aa", 0.333333)}
