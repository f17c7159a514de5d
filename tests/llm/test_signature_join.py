"""Near-duplicates by signatures against all pairs."""

import random

import numpy as np
import pytest

from strata.llm import signature_join
from tests.llm.test_repeats import edited, linked, near_rows


def kept(rows, k, num, den):
    return sorted(((i, n, c, i == c) for i, n, c in linked(rows, k, num, den)), key=repr)


@pytest.mark.parametrize(("k", "num", "den", "block"), [(3, 85, 100, 4096), (5, 80, 100, 3)])
def test_links_equal_all_pairs(documents, awkward, monkeypatch, k, num, den, block):
    monkeypatch.setattr(signature_join, "BLOCK", block)
    rows = near_rows(k) + [(10_000 + i if i is not None else None, t) for i, t in awkward]
    found = [tuple(r) for r in signature_join.near_duplicates(documents(rows), k, num, den).collect()]
    assert sorted(found, key=repr) == kept(rows, k, num, den)


def test_links_that_no_hub_has(spark, documents, monkeypatch):
    """Without star rounds every link comes from the lists' blocks."""
    monkeypatch.setattr(signature_join, "star_pairs", lambda posted, turn: spark.createDataFrame([], "a long, b long"))
    monkeypatch.setattr(signature_join, "BLOCK", 5)
    rows = near_rows(11)
    found = [tuple(r) for r in signature_join.near_duplicates(documents(rows), 3, 85, 100).collect()]
    assert sorted(found, key=repr) == kept(rows, 3, 85, 100)


def test_a_pair_is_left_to_its_first_meeting():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**32, signature_join.COORDINATES, np.uint32)
    signature = np.array([np.where(draw.random(len(base)) < 0.9, base, draw.integers(0, 2**32, len(base), np.uint32)) for _ in range(12)])
    mask = np.array([sum(1 << int(c) for c in draw.permutation(60)[:30]) for _ in range(12)])
    node, label = np.arange(12), np.arange(12) % 5
    everyone = {"node": node, "label": label, "mask": mask, "signature": signature, "is_left": np.ones(12, bool)}
    met = []
    for at in range(signature_join.COORDINATES):
        here = np.flatnonzero((mask >> at & 1 == 1) & (signature[:, at] == base[at]))
        side = {c: v[here] for c, v in everyone.items()}
        met += [tuple(sorted((here[x], here[y]))) for x, y in signature_join.first_meetings(side, side, at, 30).tolist()]
    agree = (signature[:, None] == signature[None]).sum(2)
    common = (signature[:, None] == base) & (signature[None] == base) & ((mask[:, None] & mask[None])[..., None] >> np.arange(64) & 1 == 1)
    want = [(a, b) for a in range(12) for b in range(a + 1, 12) if label[a] != label[b] and agree[a, b] >= 30 and common[a, b].any()]
    assert sorted(met) == want


def test_room_is_never_too_small():
    draw = np.random.default_rng(4)
    base = np.unique(draw.integers(0, 2**48, 900, np.uint64))
    sets = [np.unique(np.concatenate([base[: draw.integers(700, 900)], draw.integers(0, 2**48, draw.integers(0, 200), np.uint64)])) for _ in range(20)]
    side = {"short": [signature_join.short_set(signature_join.stored_set(s)) for s in sets]}
    pairs = np.array([(x, y) for x in range(20) for y in range(x + 1, 20)])
    kept = {tuple(p) for p in signature_join.with_room(side, side, pairs, 85, 100).tolist()}
    for x, y in pairs.tolist():
        overlap = len(np.intersect1d(sets[x], sets[y]))
        assert ((x, y) in kept) >= (100 * overlap >= 85 * (len(sets[x]) + len(sets[y]) - overlap))
    assert 0 < len(kept) < len(pairs)


def test_matches_miss_next_to_nothing():
    assert signature_join.matches_for(85, 100) == 34
    assert signature_join.matches_for(100, 100) == signature_join.COORDINATES


def test_signatures_agree_as_often_as_sets_are_alike():
    draw = np.random.default_rng(2)
    a = np.unique(draw.integers(0, 2**48, 4000, np.uint64))
    b = np.unique(np.concatenate([a[: len(a) * 9 // 10], draw.integers(0, 2**48, 400, np.uint64)]))
    same = np.mean([(np.equal(*signature_join.signatures([a[s::20], b[s::20]]))).mean() for s in range(20)])
    assert same == pytest.approx(np.mean([len(np.intersect1d(a[s::20], b[s::20])) / len(np.union1d(a[s::20], b[s::20])) for s in range(20)]), abs=0.05)


def test_a_large_group_of_near_copies(documents):
    draw = random.Random(5)
    words = [f"w{draw.randrange(4000)}" for _ in range(120)]
    rows = [(i, " ".join(edited(draw, words, i % 3))) for i in range(300)]
    found = {r.doc_id: r.component_id for r in signature_join.near_duplicates(documents(rows), 3, 85, 100).collect()}
    assert found == {i: c for i, _, c in linked(rows, 3, 85, 100)}


def test_nothing(documents):
    assert signature_join.near_duplicates(documents([])).count() == 0
    rows = [(1, None), (2, ""), (None, " "), (3, "one")]
    found = [tuple(r) for r in signature_join.near_duplicates(documents(rows)).collect()]
    assert sorted(found, key=repr) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True), (3, 1, 3, True)], key=repr)


def test_other_columns_and_long_texts(spark):
    rows = [(1, "a b c d " * 300_000, 5, 6, "x"), (2, "a b c d " * 300_000 + "e", 7, 8, "y"), (3, "z" * 2_000_000, 0, 0, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, n long, key string")
    assert sorted(tuple(r) for r in signature_join.near_duplicates(docs, 3, 80, 100).collect()) == [(1, 4, 1, True), (2, 5, 1, False), (3, 1, 3, True)]
