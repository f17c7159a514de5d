"""Source divergences against counting in plain Python."""

import random
import re
from collections import Counter

import pytest

from strata.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
COLUMNS = "text string, lang string, source string"


def audited(rows, least, top):
    docs = [(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), lang or "", s or "") for t, lang, s in rows]
    out = []
    for lang in {d[1] for d in docs}:
        df = Counter(w for t, one, _ in docs if one == lang for w in set(t))
        kept = {w for w, n in df.items() if n >= least}
        counts = {}
        for t, one, s in docs:
            if one == lang:
                counts.setdefault(s, Counter()).update(w for w in t if w in kept)
        whole = sum(counts.values(), Counter())

        def share(c, w, v=len(kept)):
            return 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * v)

        for s, c in counts.items():
            pairs = [(-sum(abs(share(c, w) - share(o, w)) for w in kept), other) for other, o in counts.items() if other != s]
            terms = [(share(whole, w) - share(c, w), w) for w in kept if c[w] and share(c, w) > share(whole, w)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


def sample(seed):
    draw = random.Random(seed)
    words = ["the", "The", "é", "Éa", "\U0001f600", "ﬀ", "z", "Zz", "don't", "x1y", "a_b", *(f"w{chr(97 + i)}" for i in range(20))]
    rows = []
    for _ in range(150):
        lang, source = draw.choice(["en", "de", None, ""]), draw.choice(["s0", "s0", "s0", "s1", "s2", None])
        rows.append((draw.choice([" ", "--", "\n"]).join(draw.choices(words, [1 / (i + 1) for i in range(len(words))], k=draw.randint(0, 30))), lang, source))
    return rows + [(None, "en", "null text"), ("", "fr", "a"), ("?? 12", "fr", "b"), ("alone " * 50, "it", "one"), *rows[:6]]


@pytest.mark.parametrize(("least", "top", "terms", "sources", "cut"), [(3, 4, 4096, 128, 2**24), (2, 50, 3, 2, 50), (1, 3, 1, 1, 1)])
def test_equals_counting(spark, monkeypatch, least, top, terms, sources, cut):
    monkeypatch.setattr(divergence, "SHARD_TERMS", terms)
    monkeypatch.setattr(divergence, "SHARD_SOURCES", sources)
    monkeypatch.setattr(divergence, "SLICE_BYTES", cut)
    rows = sample(least)
    found = divergence.divergences(spark.createDataFrame(rows, COLUMNS).repartition(4), least, top)
    assert sorted(tuple(r) for r in found.collect()) == audited(rows, least, top)


def test_nothing_and_one(spark):
    assert divergence.divergences(spark.createDataFrame([], COLUMNS)).count() == 0
    assert divergence.divergences(spark.createDataFrame([("a a", "en", "s")], COLUMNS), 1).count() == 0


def test_other_columns(spark):
    rows = [("a b b", "en", "s", 1, 2, "x"), ("a", "en", "t", 3, 4, "y")]
    docs = spark.createDataFrame(rows, COLUMNS + ", n long, docs long, term string")
    assert sorted(tuple(r) for r in divergence.divergences(docs, 1).collect()) == audited([r[:3] for r in rows], 1, 50)


def test_long_texts(spark):
    rows = [("Word other " * 200_000, "en", "s"), ("x" * 2_000_000, "en", "t"), ("word", "en", "t")]
    assert sorted(tuple(r) for r in divergence.divergences(spark.createDataFrame(rows, COLUMNS), 1).collect()) == audited(rows, 1, 50)


def test_shares_are_exact():
    import numpy as np

    counts, totals = np.array([5, 8 * 10**13, 123456789]), np.array([7, 9 * 10**13, 987654321987])
    assert divergence.shares(counts, totals).tolist() == [1 + 10**9 * int(c) // int(t) for c, t in zip(counts, totals, strict=True)]
