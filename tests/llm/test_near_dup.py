from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dqloom.llm import near_dup
from dqloom.llm.components import components, local_forest
from tests_support import edited, plain_groups, plain_sets


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for _ in range(40):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([4, 5, 9, 40, 200, 900]))]
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = " ".join(edited(words, rng.randrange(0, 1 + len(words) // 25), rng))
            rows.append((len(rows) * 3 + 7, text.upper() if rng.random() < 0.3 else text.replace(" ", "\n\t")))
    base = [f"h{rng.randrange(3000)}" for _ in range(120)]
    for i in range(60):  # chains: every copy is edited from the one before
        base = edited(base, 2, rng)
        rows.append((5000 - i, " ".join(base)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_all_pairs(spark, seed):
    rows = corpus(seed)
    odd = [(9000, None), (9001, ""), (9002, " \n\t"), (None, rows[0][1]), (9003, "one"), (9004, "ONE"), (9005, "x " * 50_000), (9006, "x x x x x"), (9007, "a b c d e f")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows + odd], "doc_id long, text string, bands string, rep int")
    found = near_dup.find_groups(docs).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=repr)
    assert got == sorted(plain_groups(rows + odd), key=repr)
    assert all(r.kept == (r.doc_id == r.component_id or r.doc_id is None) for r in found)
    kept = near_dup.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r.doc_id for r in found if r.kept), key=repr)


def test_ids_that_repeat(spark):
    a, b = "a b c d e f g h", "p q r s t u v w"
    docs = spark.createDataFrame([(1, a), (3, b), (3, a), (5, b), (5, b), (7, "z")], "doc_id long, text string")
    found = {(r.doc_id, r.component_id) for r in near_dup.find_groups(docs).collect()}
    assert found == {(1, 1), (3, 1), (5, 1), (7, 7)}
    assert sorted(r.doc_id for r in near_dup.keep_first(docs).collect()) == [1, 3, 7]
    unlike = spark.createDataFrame([(1, a, "x"), (1, b, "y"), (None, a, "z"), (2, None, "v")], "doc_id long, text string, row string")
    assert sorted(r.row for r in near_dup.keep_first(unlike).collect()) == ["v", "x", "y", "z"]
    alone = spark.createDataFrame([(5, b), (5, b)], "doc_id long, text string")
    assert near_dup.keep_first(alone).count() == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_dup.find_groups(docs).count() == near_dup.keep_first(docs).count() == 0


def sequential(elements, m):
    """SuperMinHash of one set, element by element, as published."""
    signature = [float("inf")] * m
    for element in elements:
        order = list(range(m))
        for j in range(m):
            k, fraction = near_dup._step(np.array([element], np.uint64), j, m)
            order[j], order[int(k[0])] = order[int(k[0])], order[j]
            signature[order[j]] = min(signature[order[j]], j + float(fraction[0]))
    return signature


def test_early_stopping_changes_nothing():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (0, 1, 3, 30, 400)]
    fast = near_dup.super_min_hash(sets, 16)
    for signature, elements in zip(fast, sets):
        assert np.array_equal(signature, sequential(elements, 16))


def test_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    agreed = []
    for _ in range(60):
        common, one, two = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (60, 20, 20))
        a, b = near_dup.super_min_hash([np.concatenate([common, one]), np.concatenate([common, two])])
        agreed.append((a == b).mean())
    assert abs(np.mean(agreed) - 0.6) < 0.03
    assert np.var(agreed) < 0.6 * 0.4 / near_dup.REGISTERS  # lower than of independent minima


def test_components(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1200)] + [(5, 5)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    links = spark.createDataFrame(pairs, "a long, b long").repartition(7)
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert local_forest(links.limit(0)).count() == components(links.limit(0)).count() == 0


def test_texts_are_not_shuffled(spark, tmp_path):
    """Whole texts once went through the join with the ids that are wanted; a bitmap picks them before."""
    rows = [(i, f"word{i} " * 20 if i % 9 else None) for i in range(400)] + [(None, "a b c d e f")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    wanted = [3, 4, 77, 395]
    ids = spark.createDataFrame([(i,) for i in wanted], "doc_id long")
    sets = near_dup._sets_of(docs, ids)
    plan = sets._jdf.queryExecution().sparkPlan().toString()
    assert plan.index("Join") < plan.index("MapInArrow")  # the join reads sets
    found = {r.doc_id: [s % 2**64 for s in r.shingles] for r in sets.collect()}
    texts = dict(rows)
    assert found == {i: near_dup.shingle_sets([texts[i]])[0].tolist() for i in wanted}
    bits, blocks = near_dup._marks(spark.range(50_000).select((F.col("id") * 10**12).alias("doc_id")))
    assert bits == 2**21 and all(len(data) == 4096 for data in blocks.values())


def test_bounds_of_both_members(spark):
    """Members that share much with others, yet too little for any pair, are not paired."""
    members = [(1, "k", i, 100) for i in range(40)]
    frame = spark.createDataFrame(members, "band int, key string, rep long, n long").withColumn("component", F.col("rep"))
    reach = frame.select("rep", F.lit(80).alias("c"))
    assert near_dup._pairs(frame, frame, reach).count() == 0  # 80 in common at most, of 120
    near = frame.select("rep", F.when(F.col("rep") < 2, 90).otherwise(80).alias("c"))
    assert [tuple(r) for r in near_dup._pairs(frame, frame, near).collect()] == [(1, 0)]


def test_large_group_is_not_paired(spark):
    """Copies just too unlike to be linked were paired with every member of a large group."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    texts = [base]
    for i in range(160):
        words = list(base)
        inside = i % 2
        for place in rng.sample(range(15, 145), 4 if inside else 5):
            words[place] = f"own{i}at{place}"
        if not inside:  # an edit of several copies keeps the bound on what occurs elsewhere from ruling them out
            words[5] = f"pool{i % 4}"
        texts.append(words)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)] + [(7, " ".join(base[:60]))]  # an id with two sets
    groups = plain_groups(rows)
    component = {i: c for i, _, c in groups}
    members = [("k", i, n, 0) for i, n, _ in groups]
    shared = spark.createDataFrame(members, "key string, rep long, n long, first long").selectExpr("1 AS band", "*")
    inside = [(i, 0) for i, c in component.items() if c == 0]
    labels = spark.createDataFrame(inside, "node long, component long")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    outside, n_inside = len(component) - len(inside), len(inside)
    assert outside > 50 and n_inside > 50
    pairs = {tuple(r) for r in near_dup._across(docs, shared, labels, []).collect()}
    assert len(pairs) < outside * n_inside / 20
    # a copy that two members inside are similar to is found when the labels don't know yet
    lost = inside[-1][0]
    labels = labels.where(f"node <> {lost}")
    pairs = {tuple(r) for r in near_dup._across(docs, shared, labels, []).collect()}
    sets = plain_sets([t for _, t in rows])
    near = [i for i, _ in inside if i != lost and 7 * len(sets[i] & sets[lost]) >= 3 * len(sets[i]) + 3 * len(sets[lost])]
    assert near and all((max(i, lost), min(i, lost)) in pairs for i in near)
