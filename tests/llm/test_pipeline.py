from __future__ import annotations

import random

import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from dqloom.llm import langid
from dqloom.llm.registered import BYTE_BPE
from tests_support import edited, plain_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, row string, kept int, rid long"


def documents(seed=0):
    rng = random.Random(seed)
    pools = {"aa": [f"wo{i}rd" for i in range(400)], "bb": [f"čí{i}šče" for i in range(400)]}
    rows, clean = [], []

    def add(i, text, lang="aa"):
        rows.append((i, text, lang, "src", len(text or ""), 1.0, "clash", 7, None))

    for i in range(80):
        lang = rng.choice(list(pools))
        add(i, " ".join(rng.choice(pools[lang]) for _ in range(rng.randrange(30, 200))), lang)
        clean.append(i)
    item = " ".join(rng.choice(pools["aa"]) for _ in range(25))
    passage = " ".join(rng.choice(pools["aa"]) for _ in range(60))
    own = lambda n: " ".join(rng.choice(pools["aa"]) for _ in range(n))
    add(100, rows[5][1], rows[5][2])  # exact copy
    add(101, " ".join(edited(rows[6][1].split() * 2, 2, rng)))
    add(102, " ".join(edited(rows[101 - 20][1].split(), 1, rng)))  # near copy of 101
    add(103, own(50) + " " + item + " " + own(50))  # leak
    add(104, own(300) + " " + passage + " " + own(300))
    add(105, own(300) + " " + passage + " " + own(300))  # the passage goes here
    add(106, None)
    add(107, "")
    add(108, "12 34 ... !!")
    add(None, own(40))
    add(104, own(10))  # an id that repeats
    return rows, clean, item, passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, _, item, _ = documents()
    place = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def test_stages_work_on_what_is_kept(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 120)
    rows, clean, item, passage = documents()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append((name, before, docs.collect()))
        if k < len(pipeline.STAGES) - 1:
            assert docs.columns == columns
    (_, given, spoken), (_, _, single), (_, _, cut), (_, _, safe), (_, packed_from, pieces) = seen
    gone = {r.doc_id for r in given} - {r.doc_id for r in spoken}
    assert gone == {106, 107, 108} and set(clean) <= {r.doc_id for r in spoken}
    kept = {i for i, _, c in plain_groups([(r.doc_id, r.text) for r in spoken]) if c == i}
    assert {r.doc_id for r in single} == kept and 100 not in kept and 102 not in kept and set(clean) <= kept
    texts = {r.doc_id: r.text for r in cut if r.doc_id != 104}
    assert passage not in texts[105] and len(texts[105]) > 1000
    assert all(r.text == texts[r.doc_id] for r in single if r.doc_id in clean)
    assert {r.doc_id for r in cut} - {r.doc_id for r in safe} == {103}
    library = Tokenizer.from_file(BYTE_BPE)
    ids = {}
    for r in pieces:
        ids.setdefault(r.doc_id, []).append((r.start, list(r.ids)))
    for r in packed_from:
        if r.doc_id != 104:
            joined = [x for _, part in sorted(ids[r.doc_id]) for x in part]
            assert joined == [*library.encode(r.text, add_special_tokens=False).ids, 1]
    assert set(ids) == {r.doc_id for r in packed_from}


def test_run_and_empty_tables(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(langid, "STEPS", 60)
    assert pipeline.run(spark, folder).count() > 0
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0
