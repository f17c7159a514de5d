"""Ranked search against scoring every document, and the parts of the hybrid evaluation."""

import math
import random
import re

import numpy as np
import pytest

from strata.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(rows, items, k=20):
    """(item_id, rank, doc_id, score) by scoring every document."""
    full = [(i, terms(t)) for i, t in rows if terms(t)]
    n, total = len(full), sum(len(t) for _, t in full)
    out = []
    for item, text in items:
        scores = []
        for doc, own in full:
            m, score = 100 - 25 + 25 * len(own) * n // total, 0
            for term in terms(text):
                tf = own.count(term)
                df = sum(term in o for _, o in full)
                if tf:
                    score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        for rank, (score, null, doc) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if null else doc, -score))
    return sorted(out, key=repr)


def sample(seed, documents=120):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Éa", "中文", "x9", "The"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = [(i, draw.choice([" ", ". ", "\n"]).join(draw.choices(words, weights, k=draw.randint(0, 40)))) for i in range(documents)]
    return rows + rows[:5], [(i, " ".join(draw.choices(words, k=draw.randint(1, 12)))) for i in range(12)]


@pytest.mark.parametrize(("window", "short", "shard"), [(1024, 8, 2**24), (4, 3, 900), (7, 10**9, 300)])
def test_equals_scoring_every_document(spark, documents, awkward, monkeypatch, window, short, shard):
    monkeypatch.setattr(ranked_search, "WINDOW", window)
    monkeypatch.setattr(ranked_search, "SHORT_SHARE", short)
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", shard)
    rows, items = sample(window)
    rows += [(1000 + i if i is not None else None, t) for i, t in awkward]
    items += [(100, None), (101, ""), (102, "?!"), (103, "unheard"), (104, "Jumps OVER the lazy dog the the"), (105, "the the the")]
    found = ranked_search.top_documents(documents(rows), spark.createDataFrame(items, "item_id long, text string"), 5)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == ranked(rows, items, 5)


def test_items_in_blocks_and_on_two_rows(spark, documents, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", 40)
    rows, items = sample(3)
    found = ranked_search.top_documents(documents(rows), spark.createDataFrame([*items, items[0]], "item_id long, text string"), 3)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(ranked(rows, [*items, items[0]], 3), key=repr)


def test_nothing(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert ranked_search.top_documents(documents([]), items).count() == 0
    assert ranked_search.top_documents(documents([(1, None), (2, ""), (3, "?")]), items).count() == 0
    assert ranked_search.top_documents(documents([(1, "a")]), items.where("false")).count() == 0


def test_other_columns_and_column_names_of_its_own(spark):
    docs = spark.createDataFrame([(1, "alpha beta", 7, 8, "x"), (2, "beta", 9, 9, "y")], "doc_id long, text string, score long, item long, terms string")
    items = spark.createDataFrame([(5, "alpha", 1)], "item_id long, text string, rank long")
    assert [(r.item_id, r.rank, r.doc_id) for r in ranked_search.top_documents(docs, items).collect()] == [(5, 1, 1)]


def test_windows_below_the_threshold_are_skipped():
    docs = 64 * ranked_search.WINDOW
    rare = (np.array([5, 9]), np.array([500, 400]))
    often = (np.arange(docs), np.full(docs, 3))
    other = (np.arange(0, docs, 2), np.full(docs // 2, 2))
    best = ranked_search.Best(2)
    looked = ranked_search.search_shard([rare, often, other], docs, best, np.arange(docs), np.zeros(docs, bool))
    assert looked == 1
    assert best.doc.tolist() == [5, 9] and best.score.tolist() == [503, 403]


def test_short_lists_become_one():
    lists = [(np.array([1, 4]), np.array([10, 10])), (np.array([4, 7]), np.array([5, 5])), (np.arange(5000), np.ones(5000, np.int64))]
    first, second = ranked_search.split_lists(lists, 600)
    assert first[0].tolist() == [1, 4, 7] and first[1].tolist() == [10, 15, 5]
    assert len(second[0]) == 5000


def test_a_long_text(spark, documents):
    text = "word " * 400_000 + "needle"
    found = ranked_search.top_documents(documents([(1, text), (2, "needle word"), (3, "x" * 3_000_000)]), spark.createDataFrame([(0, "needle")], "item_id long, text string"))
    assert [tuple(r) for r in found.orderBy("rank").collect()] == ranked([(1, text), (2, "needle word"), (3, "x" * 3_000_000)], [(0, "needle")])
