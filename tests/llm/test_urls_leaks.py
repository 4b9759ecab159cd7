from __future__ import annotations

import pytest

from dqloom.llm import decontaminate, urls
from dqloom.llm.registered import RULES

PAGES = [
    (1, "https://WWW.Example.org/es/x?q=1"), (2, "http://example.org/en/12#a"), (3, "http://example.org"),
    (4, "http://a.com/fr/1"), (5, "http://a.com/de/1"), (6, "http://com/fr/"), (7, "http://notcom/fr/"),
    (8, None), (9, "no scheme"), (10, ""), (11, "http://x.net/p?ref=1"), (12, "http://x.net/p"), (12, "http://x.net/p"),
    (13, "a://b://c/d"), (14, "http://b.com?x=/fr/"), (15, "http:///only/path"), (None, "http://x.net/" + "y" * 50_000),
]


@pytest.mark.parametrize("most", [urls.MOST_BITS, 32])
def test_verdicts(spark, monkeypatch, most):
    monkeypatch.setattr(urls, "MOST_BITS", most)
    frame = spark.createDataFrame([(*p, "clash", True) for p in PAGES], "page_id long, url string, _known string, w boolean")
    listed = spark.createDataFrame([("x.net//p",), ("unseen//",), (None,)], "key string")
    found = urls.judge(frame, listed, RULES).collect()
    got = {r.page_id: (r.host, r.path[:9], r.rule, r.verdict) for r in found}
    assert len(found) == len(PAGES)
    assert got == {
        1: ("www.example.org", "/es/x", "example.org/es/", "block"),
        2: ("example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "", None, "allow"),
        4: ("a.com", "/fr/1", "com/fr/", "allow"),
        5: ("a.com", "/de/1", "com/de/", "block"),
        6: ("com", "/fr/", "com/fr/", "allow"),
        7: ("notcom", "/fr/", None, "allow"),
        8: ("", "", None, "allow"), 9: ("", "", None, "allow"), 10: ("", "", None, "allow"),
        11: ("x.net", "/p", None, "block"), 12: ("x.net", "/p", None, "block"),
        13: ("b:", "//c/d", None, "allow"), 14: ("b.com", "", None, "allow"),
        15: ("", "/only/pat", None, "allow"), None: ("x.net", "/yyyyyyyy", None, "allow"),
    }


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 2)  # many false positives, so many levels
    universe = spark.range(3000).selectExpr("concat('k', id) AS key", "id")
    listed = universe.where("id % 3 = 0").select("key")
    cascade = urls.Cascade(listed, universe.select("key"))
    assert len(cascade.levels) > 3
    assert cascade.mark(universe).where("is_listed <> (id % 3 = 0)").count() == 0


def test_many_listed_keys_are_sliced_without_a_join(spark, monkeypatch):
    monkeypatch.setattr(urls, "MOST_BITS", 4096)
    monkeypatch.setattr(urls, "BITS_PER_KEY", 4)
    universe = spark.range(6000).selectExpr("concat('k', id % 4500) AS key", "id")
    listed = spark.range(6000).where("id % 3 = 0").selectExpr("concat('k', id) AS key")
    levels = []
    build = urls.build

    def watched(keys, level, bits):
        levels.append(bits)
        return build(keys, level, bits)

    monkeypatch.setattr(urls, "build", watched)
    found = urls.marked(universe, listed)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert levels and max(levels) <= 4096
    assert found.count() == 6000
    assert found.where("is_listed <> (id % 4500 % 3 = 0)").count() == 0


def test_rules_of_equal_length(spark):
    rules = [("net", "/abc", "allow"), ("x.net", "/a", "block"), ("org", "/a", "allow"), ("org", "/a", "block")]
    pages = spark.createDataFrame([(1, "http://x.net/abc"), (2, "http://org/ab"), (3, "http://y.net/abc")], "page_id long, url string")
    found = urls.judge(pages, spark.createDataFrame([], "key string"), rules).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in found} == {
        1: ("x.net/a", "block"), 2: ("org/a", "block"), 3: ("net/abc", "allow")
    }


def test_empty_tables(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    keys = spark.createDataFrame([], "key string")
    assert urls.judge(none, keys, RULES).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert urls.judge(some, keys, RULES).first().verdict == "allow"


# --- decontamination ------------------------------------------------------------------------

ITEM = "one two three four five six seven eight nine ten eleven"
ITEMS = [(1, ITEM), (1, ITEM), (2, "short Item"), (3, None), (4, "... !"), (None, "lonely"), (12, ITEM.upper())]
DOCS = [
    (1, "start. One, two three four five six seven eight nine TEN eleven end"),
    (2, "two three four five six seven eight nine ten"),
    (3, "a short\nitem; and short item"), (4, None), (5, ""), (6, "a lonely word"), (7, "élan short-item ñ"),
    (8, "x " * 60_000 + "short item"), (8, "short item"), (None, "short item"),
]


@pytest.mark.parametrize("most", [decontaminate.BROADCAST_WINDOWS, 20])
def test_leaks(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_WINDOWS", most)
    docs = spark.createDataFrame([(*d, "clash", 1) for d in DOCS], "doc_id long, text string, item_ids string, _text int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.find_leaks(docs.select("doc_id", "text"), items).collect()
    assert len(found) == len(DOCS)
    got = {(r.doc_id, r.n_words): (r.n_hit, list(r.item_ids)) for r in found}
    assert got == {
        (1, 13): (11, ["1", "12"]), (2, 9): (0, []), (3, 6): (4, ["2"]), (4, 0): (0, []), (5, 0): (0, []),
        (6, 3): (1, []), (7, 4): (2, ["2"]), (8, 60_002): (2, ["2"]), (8, 2): (2, ["2"]), (None, 2): (2, ["2"]),
    }
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [2, 4, 5]
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(docs, items).collect() if r.doc_id in (1, 2, 3, 7)}
    assert cut == {1: "start.  end", 2: DOCS[1][1], 3: "a ; and ", 7: "élan  ñ"}


def test_no_documents_or_items(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, items).first().n_words == 2
    assert decontaminate.find_leaks(docs.limit(0), items).count() == 0
